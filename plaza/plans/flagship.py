"""Flagship report: the most active communities at a glance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaza.functions import text as tx
from plaza.operators import activity, eda, products
from plaza.plans import views


def leading_communities(spark: SparkSession, root: str, k: int = 3, n_keywords: int = 5) -> DataFrame:
    """The ``k`` most active communities with post statistics and keywords."""
    posts = views.posts(spark, root)
    top = eda.top_communities(activity.community_activity(posts, posts, views.AS_OF), k)
    mine = posts.join(top.select("subreddit"), "subreddit", "left_semi")
    terms = products.topk_terms(mine.withColumn("text", tx.clean_text(F.col("content"))), ["subreddit"], "text", n_keywords)
    words = F.transform(F.array_sort(F.collect_list(F.struct("keyword_rank", "keyword"))), lambda e: e["keyword"])
    listed = terms.groupBy("subreddit").agg(F.array_join(words, ", ").alias("keywords"))
    stats = eda.subreddit_eda(mine)
    return top.join(stats, "subreddit").join(listed, "subreddit").select(
        "subreddit", F.round("activity", 6).alias("activity"), "post_count", F.round("avg_score", 6).alias("avg_score"),
        F.round("avg_comments", 6).alias("avg_comments"), "keywords")
