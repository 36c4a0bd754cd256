"""Exploratory statistics, each in a single pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, IDF, Normalizer, StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, functions as F

from plaza.functions.arrays import unnest

# Hash buckets of the term features, length of the term list.
TERM_BUCKETS = 1 << 18
TOP_TERMS = 40


def post_count(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count(F.lit(1)).alias("post_count"))


def posts_by_subreddit(posts: DataFrame) -> DataFrame:
    return posts.groupBy("subreddit").agg(F.count(F.lit(1)).alias("post_count"))


def avg_post_length(posts: DataFrame) -> DataFrame:
    return posts.agg(F.coalesce(F.avg(F.length("content")), F.lit(0.0)).alias("avg_post_length"))


def number_stats(posts: DataFrame, column: str) -> DataFrame:
    """Mean, approximate median and sample deviation; 0 where undefined."""
    return posts.agg(
        F.coalesce(F.avg(column), F.lit(0.0)).alias("avg"),
        F.coalesce(F.percentile_approx(column, 0.5), F.lit(0)).alias("median"),
        F.coalesce(F.stddev_samp(column), F.lit(0.0)).alias("stddev"),
    )


def global_eda(posts: DataFrame) -> DataFrame:
    """Count, length, score and comment figures in one aggregate."""
    def stats(c: str) -> list[Column]:
        return [
            F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{c}_avg"),
            F.coalesce(F.percentile_approx(c, 0.5), F.lit(0)).alias(f"{c}_median"),
            F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(f"{c}_stddev"),
        ]

    return posts.agg(
        F.count(F.lit(1)).alias("post_count"),
        F.coalesce(F.avg(F.length("content")), F.lit(0.0)).alias("avg_post_length"),
        *stats("score"), *stats("num_comments"),
    )


def term_list(column: str, stopwords: Sequence[str] | None = None) -> Column:
    """The counted terms of a text: lower-cased, split on white space, English
    stopwords and empty tokens dropped."""
    stop = list(stopwords or StopWordsRemover.loadDefaultStopWords("english"))
    return F.filter(F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), r"\s"), lambda t: (t != "") & ~t.isin(stop))


def terms(posts: DataFrame, column: str = "content", stopwords: Sequence[str] | None = None) -> DataFrame:
    """One row per counted term."""
    return unnest(posts, [], term_list(column, stopwords), "token")


def top_terms(posts: DataFrame, column: str = "content", k: int = TOP_TERMS) -> DataFrame:
    """The ``k`` most frequent terms of the corpus, ties by term."""
    counts = terms(posts, column).groupBy("token").agg(F.count(F.lit(1)).alias("term_count"))
    return counts.orderBy(F.desc("term_count"), "token").limit(k)


def term_pipeline() -> Pipeline:
    return Pipeline(stages=[
        HashingTF(inputCol="terms", outputCol="tf", numFeatures=TERM_BUCKETS),
        IDF(inputCol="tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="features"),
    ])


def term_features(posts: DataFrame, column: str = "content", model: PipelineModel | None = None) -> DataFrame:
    """The counted ``terms`` of each post, their hashed counts (``tf``) and unit-length TF-IDF
    vectors (``features``)."""
    listed = posts.withColumn("terms", term_list(column))
    model = model or term_pipeline().fit(listed)
    return model.transform(listed).drop("_tfidf")


def eda_inputs(posts: DataFrame) -> DataFrame:
    return posts.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("score", "num_comments")})


def subreddit_eda(posts: DataFrame, by: Sequence[str] = ("subreddit",)) -> DataFrame:
    """Posts, mean score and mean comments per community, nulls as 0."""
    return eda_inputs(posts).groupBy(*by).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.avg("score").alias("avg_score"),
        F.avg("num_comments").alias("avg_comments"),
    )


def top_communities(activity: DataFrame, k: int) -> DataFrame:
    return activity.orderBy(F.desc("activity"), "subreddit").limit(k)


def graph_stats(users: DataFrame, follows: DataFrame) -> DataFrame:
    """Nodes and edges of the follow graph."""
    edges = follows.agg(F.count(F.lit(1)).alias("n_edges"))
    return users.agg(F.countDistinct("user_id").alias("n_nodes")).withColumn("n_edges", edges.scalar())


def out_degree(follows: DataFrame) -> DataFrame:
    return follows.groupBy(F.col("follower_id").alias("user_id")).agg(F.count(F.lit(1)).alias("out_degree"))


def list_users(users: DataFrame) -> DataFrame:
    return users.select("user_id", "username", "personas", "subreddits").orderBy("user_id")

