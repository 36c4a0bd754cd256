"""The whole analysis: budgets, selection, topics, products and result tables,
for all users and communities in one dataflow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plaza import schemas
from plaza.functions import text as tx
from plaza.operators import activity, eda, keys, polarity, products, results, selection, topics
from plaza.session import dealt, materialize, shared_texts
from plaza.sources import readers, writers

GROUP = ["user_id", "subreddit"]
LIST = ["list_id"]
TOPIC = [*LIST, "topic_index"]


@dataclass(frozen=True)
class RunSettings:
    as_of: str
    run_ts: str
    top_n_total: int = 100
    min_per_sub: int = 5
    max_per_sub: int = 40
    threshold: int = topics.SINGLE_TOPIC_LIMIT
    platform: str = "reddit"


def budgets(posts: DataFrame, users: DataFrame, runs: DataFrame, s: RunSettings) -> DataFrame:
    """Budget and high-water mark of every (user, community)."""
    wanted = activity.user_subreddits(users)
    measured = activity.community_activity(posts, wanted, s.as_of)
    split = activity.allocate_budget(
        activity.attach_activity(wanted, measured), s.top_n_total, s.min_per_sub, s.max_per_sub)
    return selection.last_high_water_mark(split, runs, s.platform)


def pick_lists(picked: DataFrame, threshold: int = topics.SINGLE_TOPIC_LIMIT) -> DataFrame:
    """``user_id, subreddit, list_id, post_count, post_ids``: what each user picked in each community, named by its
    content: community, way of finding topics, and posts in order. A list has at most as many posts as
    the user's budget for the community."""
    listed = picked.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.transform(F.array_sort(F.collect_list(F.struct("position", "post_id"))), lambda e: e["post_id"]).alias("post_ids"))
    content = F.concat_ws("\x1f", "subreddit", topics.topic_mode(F.col("post_count"), threshold), F.array_join("post_ids", "\x1f"))
    return listed.select(*GROUP, F.sha2(content, 256).alias("list_id"), "post_count", "post_ids")


def list_posts(lists: DataFrame) -> DataFrame:
    """``list_id, subreddit, position, post_id`` of each list once, however many users have it."""
    once = lists.groupBy(*LIST).agg(F.first("subreddit").alias("subreddit"), F.first("post_ids").alias("post_ids"))
    return once.select(*LIST, "subreddit", F.posexplode("post_ids").alias("position", "post_id"))


def selected_texts(posts: DataFrame, listed: DataFrame) -> DataFrame:
    """The posts of the lists with their readable text. Picks come from two short lists
    per community, so the text of most posts need not be cleaned. What is
    cleaned is written before the join: in one generated stage with it, the
    text would be worked out again for every list that has the post."""
    content = tx.post_content(F.col("content"), F.col("title"), F.col("selftext"))
    wanted = posts.join(materialize(listed.select("post_id").distinct(), "listed-ids"), "post_id", "left_semi")
    body = materialize(wanted.select("post_id", tx.clean_text(content).alias("text"), "score", "num_comments"), "picked-texts")
    return listed.join(dealt(body), "post_id")


def topic_products(texts: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Summary, title, bullets, keywords, samples, metrics and polarity per topic.

    ``texts``: ``list_id, topic_index, mode, position, text``. Small
    groups keep repeated posts, clustered ones count each text once.
    """
    single, clustered = texts.filter("mode = 'single'"), texts.filter("mode = 'cluster'")
    parts = [(single, False), (clustered, True)]
    samples = selection.union_posts(*[topics.sample_posts(p, TOPIC, ["position"], unique=u) for p, u in parts])
    summaries = materialize(products.extractive_summary(texts, TOPIC, ["position"]), "summaries")
    measured = single.select(*TOPIC, "text").unionByName(
        clustered.join(topics.unique_texts(clustered, TOPIC, ["position"]).select(*TOPIC, "position"), [*TOPIC, "position"])
        .select(*TOPIC, "text"))
    listed = products.keyword_list(summaries, TOPIC, "summary", products.TITLE_KEYWORDS)
    out = (
        listed.withColumns({
            "title": products.title_from(F.lit(None).cast("string"), F.col("keywords"), F.col("summary")),
            "bullets": products.topic_bullets(F.col("summary")),
            "keywords": F.slice("keywords", 1, products.KEYWORDS_STORED)})
        .join(products.summary_metrics(measured, summaries, TOPIC), TOPIC)
        .join(dealt(samples), TOPIC, "left")
    )
    if model is not None:
        return polarity.topic_polarity(out, model)
    return out.withColumns({
        "polarity_label": F.lit(None).cast("string"), "polarity_score": F.lit(None).cast("double")})


def topic_struct():
    return F.struct(
        "topic_index", "title", "summary", "sample_posts", "bullets",
        F.struct(F.col("polarity_label").alias("label"), F.col("polarity_score").alias("score")).alias("sentiment"),
        "keywords", F.struct("compression_ratio", "lexical_overlap", "summary_length").alias("metrics"),
        "post_indices",
    ).alias("topic")


def run_analysis(
    posts: DataFrame, users: DataFrame, runs: DataFrame, vectors: DataFrame, s: RunSettings,
    model: PipelineModel | None = None, rules: dict[str, Column] | None = None,
) -> dict[str, DataFrame]:
    """All result tables of one run. ``vectors``: ``post_id, embedding``. Posts that break one of ``rules``
    stay out and are counted per community and reason in ``errors``. Without a ``model`` the
    polarity is null.

    Users who picked the same posts of a community share one list (``lists``), and ``products`` has the topics
    of every distinct list once: the work follows lists, not users. Word rarities are counted over the lists."""
    posts, errors = results.community_errors(posts, rules or {})
    split = materialize(budgets(posts, users, runs, s), "budgets")
    picked = materialize(selection.select_posts(posts, split), "picked")
    source = selection.source_of(F.col("subreddit"), s.platform).alias("source")
    lists = materialize(pick_lists(picked, s.threshold).select("*", source), "lists")

    # Topics and products belong to lists; users come in at the end.
    texts = materialize(selected_texts(posts, list_posts(lists)), "texts")
    placed = materialize(texts.join(topics.assign_topics(texts, vectors, LIST, threshold=s.threshold), [*LIST, "post_id"]), "placed")
    members = placed.groupBy(*TOPIC).agg(F.array_sort(F.collect_list("position")).alias("post_indices"))  # positions of one list
    full = materialize(topic_products(placed, model).join(members, TOPIC), "topics")

    owners = lists.select("user_id", "source", "subreddit", *LIST)
    community = results.community_payload(lists, full.select(*LIST, topic_struct()), s.run_ts)
    outputs = results.output_rows(community.select(
        "user_id", "source", F.struct("user_id", "source", "created_at", "post_count", "result_topics", "post_ids").alias("payload")), s.run_ts)
    stored = results.topic_rows(owners.join(dealt(full.select(*TOPIC, "title", "summary", "sample_posts")), LIST), s.run_ts)
    mapping = results.posts_to_topic_ids(
        owners.join(placed.select(*TOPIC, "post_id"), LIST).select("user_id", "source", "topic_index", "post_id"), stored)
    short = full.groupBy(*LIST).agg(F.array_sort(F.collect_list(F.struct(
        "topic_index", "title", "bullets", "sample_posts",
        F.struct("compression_ratio", "lexical_overlap", "summary_length").alias("metrics"), "post_indices"))).alias("topics"))
    of_list = eda.subreddit_eda(texts, LIST).join(dealt(short), LIST)
    # Everything narrow is joined first. The topics of a list come last, to tasks that hold whole users.
    narrow = split.select(*GROUP, "allocated", source).join(lists.select(*GROUP, *LIST), GROUP, "left").join(
        outputs.select("user_id", "source", "output_id"), ["user_id", "source"], "left").join(
        errors.groupBy("subreddit").agg(F.array_sort(F.collect_list("error")).alias("errors")), "subreddit", "left")
    per_group = shared_texts(materialize(narrow, "narrow"), materialize(of_list, "list-results"), LIST[0], "user_id", "left")
    result = F.struct(
        F.coalesce("post_count", F.lit(0)).alias("post_count"), "allocated", "output_id", "topics", "errors",
        F.struct(F.coalesce("post_count", F.lit(0)).alias("post_count"), "avg_score", "avg_comments").alias("eda"))
    combined = results.run_payload(per_group.select(*GROUP, "allocated", result.alias("result")), s.top_n_total, s.run_ts,
                                   f"{s.platform}:subreddit_analysis")
    totals = results.run_totals(per_group.select("user_id", F.coalesce("post_count", F.lit(0)).alias("post_count")))
    counts = community.select("user_id", "source", "post_count")
    # The user's whole payload is an output of its own, with a run row that has the total.
    whole = results.output_rows(combined.select(
        "user_id", "source", F.struct("user_id", "source", "timestamp", "top_n_total", "allocations", "subreddits").alias("payload")), s.run_ts)
    whole_counts = combined.select("user_id", "source").join(totals.select("user_id", "post_count"), "user_id")
    return {
        "budgets": split, "picked": picked, "lists": lists, "topics": stored, "mapping": mapping,
        "outputs": outputs.unionByName(whole),
        "runs": results.run_rows(outputs, counts).unionByName(results.run_rows(whole, whole_counts)),
        "payload": combined, "totals": totals, "products": full, "errors": errors,
    }


def _append_once(folder: str, name: str, schema: T.StructType, key: str, rows: DataFrame) -> DataFrame:
    """Append the rows whose key is not stored below ``folder`` yet; returns the table. The rows may not be read from it."""
    spark, path = rows.sparkSession, f"{folder}/{name}"
    writers.append_table(spark.createDataFrame([], schema), path)
    fresh = readers.rows_with_schema(rows, schema)
    order = [F.col(f.name) for f in schema if f.name != key and not isinstance(f.dataType, (T.ArrayType, T.MapType))]
    stored = spark.read.schema(schema).parquet(path)
    writers.append_table(keys.new_rows(fresh, stored, key, order), path)
    return spark.read.schema(schema).parquet(path)


def feed_cache(made: dict[str, DataFrame], posts: DataFrame, s: RunSettings) -> DataFrame:
    """The cache row of every user who picked posts: whole records, the topics of the user's lists (a few per
    community) and what was asked for and fetched."""
    topic = F.struct("topic_index", "title", "summary", "bullets", "keywords", F.col("post_indices").cast("array<bigint>").alias("post_indices"))
    found = shared_texts(made["lists"].select(*GROUP, *LIST), made["products"].select(*LIST, topic.alias("topic")), LIST[0], "user_id")
    listed = found.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("subreddit", "topic.topic_index", "topic"))).alias("_t")).select(
        "user_id", F.transform("_t", lambda t: t["topic"]).alias("topic_data"))
    meta = selection.feed_meta(made["budgets"], made["picked"], s.top_n_total)
    told = F.create_map(
        F.lit("requested_total"), F.col("requested_total").cast("string"),
        F.lit("actual_fetched_total"), F.col("actual_fetched_total").cast("string"), F.lit("timestamp"), F.lit(s.run_ts))
    extras = meta.select("user_id", F.lit(None).cast("string").alias("summary"), told.alias("source_meta")).join(listed, "user_id", "left")
    ids = materialize(made["picked"].select("post_id").distinct(), "picked-ids")
    wanted = materialize(posts.join(ids, "post_id", "left_semi").drop("subreddit", "created_at"), "picked-records")
    # Users share the records of leading posts: grouping by user moves no record.
    return results.feed_cache_rows(shared_texts(made["picked"], wanted, "post_id", "user_id"), extras, s.platform, s.run_ts)


def land_feed(made: dict[str, DataFrame], posts: DataFrame, users: DataFrame, folder: str, s: RunSettings) -> dict[str, DataFrame]:
    """Store what a run fetched below ``folder``, each row once: stubs of unknown authors before the posts, the posts any user
    picked, a cache row per user with posts, and a log row per user. Returns the four tables."""
    fetched = posts.join(materialize(made["picked"].select("post_id").distinct(), "picked-ids"), "post_id", "left_semi")
    fetched = materialize(fetched.withColumn("cleaned_content", tx.cleaned_content(F.col("content"))), "fetched")
    known = _append_once(folder, "users", schemas.USERS, "user_id", users)
    stubs = materialize(keys.missing_authors(fetched, known), "stubs")  # told by the table they go to
    out = {"users": _append_once(folder, "users", schemas.USERS, "user_id", stubs)}
    out["posts"] = _append_once(folder, "posts", schemas.POSTS, "post_id", fetched)
    cache = materialize(feed_cache(made, posts, s), "cache")
    out["feed_cache"] = _append_once(folder, "feed_cache", schemas.FEED_CACHE, "cache_id", cache)
    log = results.run_log_rows(users.select("user_id").distinct(), cache, s.platform, s.run_ts)
    out["feed_runs"] = _append_once(folder, "feed_runs", schemas.FEED_RUNS, "run_id", log)
    return out


def store_run(made: dict[str, DataFrame], folder: str, runs: DataFrame, run_folder: str) -> DataFrame:
    """Append topics, mapping and outputs of a run below ``folder``, each row once, and write the next
    version of the run state to ``run_folder``; returns that state. (``land_feed`` stores what the run fetched.)

    Ids depend on business keys only, so a run that is stored again adds nothing.
    """
    spark = runs.sparkSession
    for name, schema, key in (("topics", schemas.TOPICS, "topic_id"), ("mapping", schemas.POST_TOPICS, "mapping_id"), ("outputs", schemas.OUTPUTS, "output_id")):
        _append_once(folder, name, schema, key, made[name])
    fresh = readers.rows_with_schema(made["runs"], schemas.RUNS)
    keys.upsert_latest(readers.rows_with_schema(runs, schemas.RUNS), fresh, ["user_id", "source"], "last_run_at", "output_id").write.parquet(run_folder)
    return spark.read.schema(schemas.RUNS).parquet(run_folder)
