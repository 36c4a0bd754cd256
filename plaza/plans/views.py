"""Community tables seen in a folder of parquet files.

Posts are events with the text of a document; users, follows, run state and
topics derive from the same files. Every view covers its source tables whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaza.session import use_utc

AS_OF = "2024-01-31 00:00:00"
LAST_RUN = "2024-01-15 00:00:00"
RUN_TS = "2024-02-01 00:00:00"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{root}/{name}.parquet")


def dealt_out(df: DataFrame) -> DataFrame:
    """The test tables may be one small file each, which a single task would read."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def user_name(c: Column) -> Column:
    return F.concat(F.lit("user_"), c.cast("string"))


def post_name(c: Column) -> Column:
    return F.concat(F.lit("p_"), c.cast("string"))


def events(spark: SparkSession, root: str) -> DataFrame:
    return dealt_out(table(spark, root, "events")).withColumn("ts", F.col("ts").cast("timestamp"))


def posts_of(event_rows: DataFrame, root: str, *kept: str) -> DataFrame:
    """Posts of the given events, with the columns ``kept`` of these.

    The texts are joined last and dealt out by their key once: what is joined before is narrow, so no
    text is shuffled with a post."""
    spark = event_rows.sparkSession
    documents, pages = table(spark, root, "documents"), table(spark, root, "pages")
    keyed = event_rows.withColumns({
        "doc_id": F.col("event_id") % row_count(documents), "page_id": F.col("event_id") % row_count(pages)})
    joined = keyed.join(pages.select("page_id", "url"), "page_id").join(
        documents.select("doc_id", "text", "source", "lang").repartition("doc_id"), "doc_id")
    title = F.substring("text", 1, 80)
    selftext = F.concat(F.substr("text", F.lit(81)), F.lit(" "), "url")
    return joined.select(
        post_name(F.col("event_id")).alias("post_id"),
        user_name(F.col("user_id")).alias("author_id"),
        F.col("source").alias("subreddit"),
        title.alias("title"),
        selftext.alias("selftext"),
        F.concat(title, F.lit("\n\n"), selftext).alias("content"),
        F.col("ts").alias("created_at"),
        F.floor("value").cast("int").alias("score"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("num_comments"),
        F.col("lang").alias("flair"),
        "event_id",
        *kept,
    )


def posts(spark: SparkSession, root: str) -> DataFrame:
    return posts_of(events(spark, root), root)


def users(spark: SparkSession, root: str) -> DataFrame:
    """Every event user with two personas and the communities posted in."""
    customers = table(spark, root, "customer")
    first = customers.select(F.col("c_custkey").alias("user_key"), F.col("c_mktsegment").alias("persona_1"))
    second = customers.select((F.col("c_custkey") - 1).alias("user_key"), F.col("c_mktsegment").alias("persona_2"))
    ids = events(spark, root).select(F.col("user_id").alias("user_key")).distinct()
    active = posts(spark, root).select("author_id", "subreddit").distinct()
    listed = active.groupBy("author_id").agg(F.sort_array(F.collect_list("subreddit")).alias("subreddits"))
    return (
        ids.join(first, "user_key").join(second, "user_key")
        .withColumn("user_id", user_name(F.col("user_key")))
        .join(listed.withColumnRenamed("author_id", "user_id"), "user_id")
        .select("user_id", F.col("user_id").alias("username"), F.array("persona_1", "persona_2").alias("personas"), "subreddits")
    )


def messy_users(spark: SparkSession, root: str) -> DataFrame:
    """Users as they sign up: mixed case, blanks and repeats among their
    communities; users of a single persona name none."""
    mixed = F.concat(F.transform("subreddits", F.upper), F.array(F.lit("")), F.col("subreddits"))
    none = F.array().cast("array<string>")
    return users(spark, root).withColumn(
        "subreddits", F.when(F.col("personas")[0] == F.col("personas")[1], none).otherwise(mixed))


def follows(spark: SparkSession, root: str) -> DataFrame:
    rows = events(spark, root).select("event_id", "user_id")
    n = rows.agg(F.countDistinct("user_id")).scalar()
    edges = rows.withColumn("other", (F.col("event_id") * 31 + 7) % n).filter(F.col("user_id") != F.col("other"))
    return edges.select(user_name(F.col("user_id")).alias("follower_id"), user_name(F.col("other")).alias("followed_id")).distinct()


def live_runs(spark: SparkSession, root: str) -> DataFrame:
    """A high-water mark for every (user, community) posted in before it."""
    mark = F.lit(LAST_RUN).cast("timestamp")
    rows = posts(spark, root).filter(F.col("created_at") < mark).select("author_id", "subreddit").distinct()
    return rows.select(
        F.col("author_id").alias("user_id"), F.concat(F.lit("reddit:"), "subreddit").alias("source"), mark.alias("last_run_at"))


def vectors(spark: SparkSession, root: str) -> DataFrame:
    """The vector of every post, with the label of the vector."""
    embeddings = table(spark, root, "embeddings")
    keyed = events(spark, root).withColumn("vec_id", F.col("event_id") % row_count(embeddings))
    return keyed.join(embeddings, "vec_id").select(
        post_name(F.col("event_id")).alias("post_id"), "vec_id", "embedding", "label")


def topics(spark: SparkSession, root: str) -> DataFrame:
    """A topic per vector label and one topic without posts."""
    labels = table(spark, root, "embeddings").select("label").distinct()
    made = labels.select(
        F.col("label").alias("topic_id"), F.concat(F.lit("topic "), F.col("label").cast("string")).alias("topic_title"),
        F.expr("repeat('s', 295 + label)").alias("summary_text"))
    empty = labels.agg(F.max("label")).select(
        F.lit(99).alias("topic_id"), F.lit("empty topic").alias("topic_title"), F.lit(None).cast("string").alias("summary_text"))
    return made.unionByName(empty)


def mapping(spark: SparkSession, root: str) -> DataFrame:
    return vectors(spark, root).select("post_id", F.col("label").alias("topic_id"))


def topic_posts(spark: SparkSession, root: str) -> DataFrame:
    """Posts by community and topic, the topic being the label of their vector, which joins the events before their texts do."""
    labels = vectors(spark, root).select("post_id", F.col("label").alias("topic_index"))
    named = events(spark, root).withColumn("post_id", post_name(F.col("event_id"))).join(labels, "post_id").drop("post_id")
    return posts_of(named, root, "topic_index")
