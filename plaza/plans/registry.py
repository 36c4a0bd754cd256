"""Every operator as a query over a folder of parquet tables.

Results are flat (lists joined to text, instants as microseconds) so that any
engine can be compared with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaza import schemas
from plaza.functions import arrays, text as tx, times, vectors as vec
from plaza.operators import (
    activity, eda, graph, keys, polarity, products, ranking, reports, results, selection, similarity, topics,
)
from plaza.plans import run, views
from plaza.session import materialize, new_path, shared_texts
from plaza.sources import readers, writers
from plaza.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOPIC = ["subreddit", "topic_index"]
ORDER = ["created_at", "post_id"]
NEAR = 0.30


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def micros(c: str) -> Column:
    return F.unix_micros(c)


def listed(c: str | Column, sep: str = "|") -> Column:
    return F.array_join(c, sep)


def fixed(c: str | Column, digits: int = 6) -> Column:
    return F.round(c, digits)


def instant(value: str) -> Column:
    return times.as_instant(value)


def readable(posts: DataFrame) -> DataFrame:
    return posts.withColumn("text", tx.clean_text(tx.post_content(F.col("content"), F.col("title"), F.col("selftext"))))


def topic_texts(spark: SparkSession, root: str) -> DataFrame:
    """Posts by (community, topic) with readable text, written once."""
    rows = readable(views.topic_posts(spark, root)).select("post_id", "created_at", *TOPIC, "text")
    return materialize(rows, "topic-posts")


def topic_summaries(spark: SparkSession, root: str, posts: DataFrame | None = None) -> DataFrame:
    posts = posts or topic_texts(spark, root)
    return materialize(products.extractive_summary(posts, TOPIC, ORDER), "summaries")


def budgets(spark: SparkSession, root: str, n: int, users: DataFrame | None = None) -> DataFrame:
    s = run.RunSettings(views.AS_OF, views.RUN_TS, n)
    return run.budgets(views.posts(spark, root), users or views.users(spark, root), views.live_runs(spark, root), s)


def picks(spark: SparkSession, root: str, n: int = 100, since: bool = True) -> DataFrame:
    split = materialize(budgets(spark, root, n), "budgets")  # read twice: for the largest budget, and for the picks
    if not since:
        split = split.drop("since")
    return selection.select_posts(views.posts(spark, root), split)


# ---- scans ---------------------------------------------------------------

def user_fields(users: DataFrame) -> DataFrame:
    return users.select("user_id", "username", listed("personas").alias("personas"), listed("subreddits").alias("subreddits"))


@query
def read_users(spark, root):
    path = new_path(spark, "users")
    writers.write_json(views.users(spark, root), path)
    return user_fields(readers.read_users(spark, path))


@query
def read_follows(spark, root):
    path = new_path(spark, "follows")
    writers.write_json(views.follows(spark, root), path)
    return readers.read_follows(spark, path)


@query
def read_edgelist(spark, root):
    path = new_path(spark, "edges")
    edges = views.follows(spark, root)
    writers.write_edgelist(edges, path)
    # The same edges once more, as other programs write them.
    other = F.concat(F.lit("  "), "follower_id", F.lit("\t \t"), "followed_id", F.lit("  {'weight': 1} # seen"))
    edges.select(other).unionByName(edges.limit(1).select(F.lit("# a comment").alias(edges.select(other).columns[0]))).write.mode("append").text(path)
    return readers.read_edgelist(spark, path)


@query
def read_posts_landed(spark, root):
    path = new_path(spark, "landed")
    lang = F.col("flair")
    landed = views.posts(spark, root).select(
        F.col("event_id").cast("string").alias("id"),
        F.when(lang != "de", F.col("author_id")).alias("author"),
        "subreddit",
        F.when(lang != "fr", F.col("title")).alias("title"),
        F.when(lang != "es", F.col("selftext")).alias("selftext"),
        (micros("created_at") / 1e6).alias("created_utc"),
        "score", "num_comments", lang.alias("link_flair_text"))
    writers.write_json(landed, path)
    made = readers.read_posts_landed(spark, path)
    return made.select("post_id", "author_id", "subreddit", "title", "selftext", "content",
                       micros("created_at").alias("created_us"), "score", "num_comments", "flair")


@query
def scan_table(spark, root):
    views.table(spark, root, "customer").createOrReplaceTempView("plaza_customers")
    return readers.scan_table(spark, "plaza_customers").filter("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")


@query
def rows_with_schema(spark, root):
    return readers.rows_with_schema(views.posts(spark, root), schemas.EDA_ROWS)


@query
def user_subreddits(spark, root):
    return activity.user_subreddits(views.messy_users(spark, root))


@query
def last_high_water_mark(spark, root):
    marked = selection.last_high_water_mark(activity.user_subreddits(views.users(spark, root)), views.live_runs(spark, root))
    return marked.select("user_id", "subreddit", "source", micros("since").alias("since_us"))


# ---- sinks and table maintenance ----------------------------------------

@query
def append_table(spark, root):
    path = new_path(spark, "users")
    users = views.users(spark, root)
    builders = F.array_contains("personas", "BUILDING")
    writers.append_table(users.filter(builders), path)
    writers.append_table(users.filter(~builders), path)
    return user_fields(spark.read.schema(schemas.USERS).parquet(path))


@query
def write_json(spark, root):
    path = new_path(spark, "posts")
    writers.write_json(views.posts(spark, root).drop("event_id"), path)
    back = readers.read_posts(spark, path)
    return back.select("post_id", "author_id", "subreddit", "content", micros("created_at").alias("created_us"), "score", "num_comments")


@query
def write_edgelist(spark, root):
    path = new_path(spark, "edges")
    writers.write_edgelist(views.follows(spark, root), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def insert_if_absent(spark, root):
    posts = views.posts(spark, root).select("post_id", "created_at", "score")
    path = new_path(spark, "posts")
    writers.append_table(posts.filter(F.col("created_at") < instant(views.LAST_RUN)).withColumn("score", F.lit(-1)), path)
    resent = posts.unionByName(posts.withColumn("score", F.col("score") + 1))
    stored = spark.read.schema(posts.schema).parquet(path)
    writers.append_table(keys.new_rows(resent, stored, "post_id", ["created_at", "score"]), path)
    return spark.read.schema(posts.schema).parquet(path).select("post_id", micros("created_at").alias("created_us"), "score")


@query
def ensure_authors(spark, root):
    known = views.users(spark, root).filter(~F.array_contains("personas", "BUILDING"))
    stubs = keys.missing_authors(views.posts(spark, root), known)
    return stubs.select("user_id", "username", F.size("personas").alias("n_personas"), F.size("subreddits").alias("n_subreddits"))


def run_updates(posts: DataFrame) -> DataFrame:
    """A run row for every (author, community) that posted."""
    return posts.groupBy(F.col("author_id").alias("user_id"), selection.source_of(F.col("subreddit")).alias("source")).agg(
        F.max("created_at").alias("last_run_at"), F.count(F.lit(1)).alias("post_count"))


@query
def upsert_latest(spark, root):
    old = views.live_runs(spark, root).withColumn("post_count", F.lit(0).cast("bigint"))
    recent = views.posts(spark, root).filter(F.col("created_at") > instant(views.LAST_RUN))
    merged = keys.upsert_latest(old, run_updates(recent), ["user_id", "source"], "last_run_at", "post_count")
    return merged.select("user_id", "source", micros("last_run_at").alias("last_run_us"), "post_count")


def picked_payloads(spark, root) -> DataFrame:
    rows = picks(spark, root).withColumn("source", selection.source_of(F.col("subreddit")))
    grouped = rows.groupBy("user_id", "source").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.transform(F.array_sort(F.collect_list(F.struct("position", "post_id"))), lambda e: e["post_id"]).alias("post_ids"))
    return grouped.select("user_id", "source", "post_count", F.struct("user_id", "source", "post_count", "post_ids").alias("payload"))


@query
def append_outputs(spark, root):
    path = new_path(spark, "outputs")
    writers.append_table(results.output_rows(picked_payloads(spark, root), views.RUN_TS), path)
    stored = spark.read.schema(schemas.OUTPUTS).parquet(path)
    return stored.select("output_id", "user_id", "source", micros("created_at").alias("created_us"), "payload_json")


def cache_rows(spark, root) -> DataFrame:
    rows = materialize(picks(spark, root), "picks")  # read for the ids, the records and the summary
    extras = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).select(
        "user_id", F.concat(F.col("n").cast("string"), F.lit(" posts")).alias("summary"),
        F.lit(None).cast(schemas.FEED_CACHE["topic_data"].dataType).alias("topic_data"),
        F.create_map(F.lit("requested"), F.lit("100")).alias("source_meta"))
    # Whole records of the picked posts only: few posts lead a community, and the others' texts are not shuffled.
    picked = materialize(rows.select("post_id").distinct(), "picked-ids")
    records = materialize(views.posts(spark, root).join(picked, "post_id", "left_semi").select(
        "post_id", "author_id", "title", "selftext", "content", "score", "num_comments", "flair"), "picked-records")
    # Users share the records of leading posts: grouping by user moves no record.
    return results.feed_cache_rows(shared_texts(rows, records, "post_id", "user_id"), extras, "reddit", views.RUN_TS)


@query
def append_feed_cache(spark, root):
    path = new_path(spark, "cache")
    fresh = materialize(cache_rows(spark, root), "cache-rows")
    writers.append_table(fresh, path)
    stored = spark.read.schema(schemas.FEED_CACHE).parquet(path)
    # A repeated run adds nothing: the cache is unique by (user, platform, time).
    writers.append_table(keys.new_rows(fresh, stored, "cache_id", ["user_id"]), path)
    # Of the stored posts only ids are told, so only these are read and ranked.
    ids = F.transform(F.col("raw_posts.post_id"), lambda i: F.struct(i.alias("post_id")))
    newest = results.last_cache(spark.read.schema(schemas.FEED_CACHE).parquet(path).withColumn("raw_posts", ids))
    return newest.select("cache_id", "user_id", "platform", micros("fetched_at").alias("fetched_us"),
                         F.size("raw_posts").alias("n_posts"), listed(F.transform("raw_posts", lambda p: p["post_id"])).alias("post_ids"),
                         "summary", F.size("topic_data").alias("n_topics"), F.element_at("source_meta", "requested").alias("requested"))


@query
def append_run_log(spark, root):
    path = new_path(spark, "runs")
    every = views.users(spark, root).select("user_id")
    stored = cache_rows(spark, root).filter(F.size("raw_posts") >= 100)
    writers.append_table(results.run_log_rows(every, stored, "reddit", views.RUN_TS), path)
    log = spark.read.schema(schemas.FEED_RUNS).parquet(path)
    return log.select("run_id", "user_id", "platform", "run_status", micros("fetched_at").alias("fetched_us"), "notes")


def stored_topics(spark, root, texts: DataFrame) -> DataFrame:
    made = topics.sample_posts(texts, TOPIC, ORDER).select(
        F.lit("").alias("user_id"), selection.source_of(F.col("subreddit")).alias("source"), "topic_index",
        F.concat(F.lit("topic "), F.col("topic_index").cast("string")).alias("title"), F.lit(None).cast("string").alias("summary"), "sample_posts")
    return results.topic_rows(made, views.RUN_TS)


@query
def persist_topics(spark, root):
    texts = topic_texts(spark, root)
    topics_path, mapping_path = new_path(spark, "topics"), new_path(spark, "mapping")
    writers.append_table(readers.rows_with_schema(stored_topics(spark, root, texts), schemas.TOPICS), topics_path)
    stored = spark.read.schema(schemas.TOPICS).parquet(topics_path)
    assigned = texts.select(F.lit("").alias("user_id"), selection.source_of(F.col("subreddit")).alias("source"), "topic_index", "post_id")
    writers.append_table(results.posts_to_topic_ids(assigned, stored), mapping_path)
    sizes = spark.read.schema(schemas.POST_TOPICS).parquet(mapping_path).groupBy(F.col("topic_ref").alias("topic_id")).agg(F.count(F.lit(1)).alias("n_posts"))
    return results.export_topics(stored).join(sizes, "topic_id").select("topic_id", "user_id", "source", "topic_index", "topic_title", "sample_posts", "n_posts")


@query
def create_reset_tables(spark, root):
    folder = new_path(spark, "tables")
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    writers.create_tables(spark, folder, database)
    views.users(spark, root).write.insertInto(f"{database}.users")
    views.follows(spark, root).write.insertInto(f"{database}.follows")
    loaded = {name: spark.table(f"{database}.{name}") for name in ("users", "follows")}
    before = materialize(counts_of(loaded, "loaded"), "counts")
    writers.truncate_core(spark, folder, database)
    names = [*schemas.CORE_TABLES, *schemas.LIVE_TABLES]
    return before.unionByName(counts_of({n: spark.table(f"{database}.{n}") for n in names}, "reset"))


def counts_of(tables: dict[str, DataFrame], state: str) -> DataFrame:
    return selection.union_posts(*[
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), F.lit(state).alias("state"), "n_rows")
        for n, t in tables.items()])


@query
def enforce_keys(spark, root):
    users, posts = views.users(spark, root), views.posts(spark, root).select("post_id", "author_id", "subreddit")
    some = users.filter(~F.array_contains("personas", "BUILDING"))
    anonymous = posts.withColumn("author_id", F.when(F.col("subreddit") != "src0", F.col("author_id")))
    runs = views.live_runs(spark, root).select("user_id", "source")
    before = {
        "users": some.unionByName(some.withColumn("username", F.lit("again"))),
        "follows": views.follows(spark, root), "posts": anonymous.unionByName(anonymous), "feed_runs": runs}
    after = keys.enforce_keys(before["users"], before["follows"], before["posts"], runs)
    named = keys.violation_report({"feed_runs": runs}, {"feed_runs": after["feed_runs"].filter("user_id IS NOT NULL")})
    named = named.filter("state = 'kept'").withColumn("state", F.lit("with user"))
    return keys.violation_report(before, after).unionByName(named)


# ---- projections, filters, predicates -------------------------------------

@query
def normalize_created_at(spark, root):
    """Times as they are written in the wild, one form per event type."""
    kind = F.col("event_type")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    written = (
        F.when(kind == "view", iso).when(kind == "click", F.concat(iso, F.lit("+02:00")))
        .when(kind == "error", F.lit("yesterday")).when(kind == "signup", F.concat(iso, F.lit("Z")))
        .otherwise(F.lit(None)))
    rows = views.events(spark, root).withColumn("written", written)
    return rows.select("event_id", micros_of(times.to_instant(F.col("written"), views.RUN_TS)).alias("created_us"))


def micros_of(c: Column) -> Column:
    return F.unix_micros(c)


@query
def post_content(spark, root):
    lang = F.col("flair")
    content = F.when(lang == "en", F.col("content")).when(lang == "de", F.lit(""))
    title = F.when(lang != "fr", F.col("title"))
    return views.posts(spark, root).select("post_id", tx.post_content(content, title, F.col("selftext")).alias("content"))


@query
def cleaned_content(spark, root):
    return views.posts(spark, root).select("post_id", tx.cleaned_content(F.col("content")).alias("cleaned_content"))


@query
def clean_text(spark, root):
    return views.posts(spark, root).select("post_id", tx.clean_text(F.col("content")).alias("text"))


@query
def post_ids_default(spark, root):
    rows = views.posts(spark, root).select("subreddit", "created_at", "event_id", F.when(F.col("flair") == "en", F.col("post_id")).alias("given"))
    placed = ranking.positions(rows, ["subreddit"], ["created_at", "event_id"])
    return placed.select("event_id", "subreddit", results.post_ids_default(F.col("given"), F.col("position")).alias("post_id"))


@query
def since_filter(spark, root):
    posts = views.posts(spark, root).select("post_id", "created_at", F.col("author_id").alias("user_id"), "subreddit")
    return selection.since_filter(selection.last_high_water_mark(posts, views.live_runs(spark, root))).select("post_id", "user_id", "source")


@query
def eda_inputs(spark, root):
    rows = views.posts(spark, root).select("post_id", F.when(F.col("flair") == "en", F.col("score")).alias("score"),
                                           F.when(F.col("flair") != "en", F.col("num_comments")).alias("num_comments"))
    return eda.eda_inputs(rows)


@query
def topic_snippet(spark, root):
    return reports.topic_report(views.topics(spark, root), views.mapping(spark, root))


@query
def point_lookup(spark, root):
    return keys.point_lookup(views.posts(spark, root), author_id="user_7").select("post_id", "author_id", "subreddit", "title")


# ---- joins -----------------------------------------------------------------

@query
def topics_left_join_mapping(spark, root):
    return reports.topics_left_join_mapping(views.topics(spark, root), views.mapping(spark, root)).select("topic_id", "topic_title", "post_id")


@query
def anti_existing(spark, root):
    posts = views.posts(spark, root)
    return keys.anti_existing(posts.select("post_id", "score"), posts.filter("score >= 100"), "post_id")


@query
def except_existing(spark, root):
    """All post ids less those of builders."""
    posts = views.posts(spark, root).select("post_id", "author_id")
    builders = views.users(spark, root).filter(F.array_contains("personas", "BUILDING"))
    taken = keys.semi_referential(posts, builders, "author_id", "user_id")
    return keys.anti_existing(posts, taken, "post_id")


@query
def semi_referential(spark, root):
    known = views.users(spark, root).filter(F.array_contains("personas", "BUILDING"))
    return keys.semi_referential(views.follows(spark, root), known, "followed_id", "user_id").select("follower_id", "followed_id")


@query
def posts_to_topic_ids(spark, root):
    rows = views.topic_posts(spark, root).select(
        F.lit("").alias("user_id"), selection.source_of(F.col("subreddit")).alias("source"), "topic_index", "post_id")
    created = instant(views.RUN_TS)
    ids = rows.select("user_id", "source", "topic_index").distinct().select(
        "*", results.business_id("user_id", "source", created.cast("string"), F.col("topic_index").cast("string")).alias("topic_id"),
        created.alias("created_at"))
    return results.posts_to_topic_ids(rows, ids).select("mapping_id", "source", "post_ref", "topic_ref")


@query
def attach_allocations(spark, root):
    split = budgets(spark, root, 100, views.messy_users(spark, root))
    posted = views.posts(spark, root).select(F.col("author_id").alias("user_id"), "subreddit").distinct()
    return activity.attach_allocations(posted, split)


@query
def persona_overlap_pairs(spark, root):
    pairs = graph.persona_overlap_pairs(views.users(spark, root))
    return pairs.select(listed("set_a").alias("set_a"), listed("set_b").alias("set_b"), "weight", "n_pairs")


@query
def similarity_join(spark, root):
    pairs = similarity.similarity_join(views.table(spark, root, "embeddings"), ["label"], "vec_id", "embedding", NEAR)
    return pairs.withColumn("cosine", fixed("cosine"))


# ---- aggregations ------------------------------------------------------------

@query
def post_count(spark, root):
    return eda.post_count(views.posts(spark, root))


@query
def posts_by_subreddit(spark, root):
    return eda.posts_by_subreddit(views.posts(spark, root))


@query
def avg_post_length(spark, root):
    return eda.avg_post_length(views.posts(spark, root)).select(fixed("avg_post_length").alias("avg_post_length"))


def stats(spark, root, column: str) -> DataFrame:
    return eda.number_stats(views.posts(spark, root), column).select(fixed("avg").alias("avg"), "median", fixed("stddev").alias("stddev"))


@query
def score_stats(spark, root):
    return stats(spark, root, "score")


@query
def comment_stats(spark, root):
    return stats(spark, root, "num_comments")


@query
def global_eda(spark, root):
    made = eda.global_eda(views.posts(spark, root))
    return made.select(*[c if c == "post_count" or c.endswith("median") else fixed(c).alias(c) for c in made.columns])


@query
def top_terms(spark, root):
    return eda.top_terms(readable(views.posts(spark, root)), "text")


@query
def global_top_terms(spark, root):
    return eda.top_terms(readable(documents(spark, root).select(
        F.lit(None).cast("string").alias("content"), F.lit("").alias("title"), F.col("text").alias("selftext"))), "text")


@query
def term_features(spark, root):
    rows = materialize(readable(views.posts(spark, root)).select("post_id", "text"), "texts")
    made = eda.term_features(rows, "text")
    # Hash functions differ between engines; the number of counted terms and the unit length do not.
    norm = F.udf(lambda v: float(v.norm(2)), "double")  # as an array a vector would have all 2^18 places
    return made.select("post_id", fixed(norm("features")).alias("norm"), F.size("terms").cast("long").alias("n_terms"))


@query
def subreddit_eda(spark, root):
    return eda.subreddit_eda(views.posts(spark, root)).withColumns({c: fixed(c) for c in ("avg_score", "avg_comments")})


@query
def community_activity(spark, root):
    wanted = activity.user_subreddits(views.messy_users(spark, root))
    return activity.community_activity(views.posts(spark, root), wanted, views.AS_OF).withColumn("activity", fixed("activity"))


@query
def topic_post_counts(spark, root):
    return reports.topic_post_counts(views.topics(spark, root), views.mapping(spark, root)).select("topic_id", "topic_title", "post_count")


@query
def topic_members(spark, root):
    rows = views.topic_posts(spark, root).select(*TOPIC, *ORDER)
    return topics.topic_members(rows, TOPIC, ORDER).select(*TOPIC, "post_id", "member_position")


@query
def run_totals(spark, root):
    counted = picks(spark, root).groupBy("user_id", "subreddit").agg(F.count(F.lit(1)).alias("post_count"))
    return results.run_totals(counted)


@query
def feed_meta(spark, root):
    split = materialize(budgets(spark, root, 100), "budgets")
    meta = selection.feed_meta(split, selection.select_posts(views.posts(spark, root), split))
    whole = lambda v, scale: F.round(v * scale).cast("bigint").cast("string")
    pairs = lambda m, scale=1: F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), whole(e["value"], scale)))
    return meta.select("user_id", "requested_total", "actual_fetched_total",
                       listed(pairs("allocations")).alias("allocations"), listed(pairs("activity_map", 1000)).alias("activity_map"))


@query
def graph_stats(spark, root):
    return eda.graph_stats(views.users(spark, root), views.follows(spark, root))


@query
def out_degree(spark, root):
    return eda.out_degree(views.follows(spark, root))


# ---- ranking, limits, sets -----------------------------------------------------

@query
def latest_per_key(spark, root):
    rows = views.posts(spark, root).select("author_id", "subreddit", "post_id", "created_at")
    return keys.latest_per_key(rows, ["author_id", "subreddit"], "created_at", "post_id").select("author_id", "subreddit", "post_id")


@query
def rank_in_community(spark, root):
    rows = views.posts(spark, root).select("subreddit", *ORDER)
    return ranking.positions(rows, ["subreddit"], ORDER).select("subreddit", "post_id", "position")


def allocation(spark, root, n: int) -> DataFrame:
    return budgets(spark, root, n).select("user_id", "pos", "subreddit", "allocated")


@query
def allocate_budget(spark, root):
    return allocation(spark, root, 100)


@query
def allocate_budget_fill(spark, root):
    return allocation(spark, root, 500)


@query
def allocate_budget_clamped(spark, root):
    return allocation(spark, root, 700)


@query
def allocate_budget_saturated(spark, root):
    return allocation(spark, root, 900)


@query
def first_occurrence(spark, root):
    rows = readable(views.posts(spark, root)).select("subreddit", *ORDER, F.sha2(tx.dedupe_key(F.col("text")), 256).alias("key"))
    return keys.first_occurrence(rows, ["subreddit"], F.col("key"), ORDER).select("subreddit", "post_id")


@query
def list_users(spark, root):
    return user_fields(eda.list_users(views.users(spark, root)))


@query
def flat_feed(spark, root):
    return selection.flat_feed(picks(spark, root, 50, since=False), 50).select("user_id", "feed_rank", "post_id")


@query
def select_posts(spark, root):
    return picks(spark, root).select("user_id", "subreddit", "position", "post_id")


@query
def select_posts_first_run(spark, root):
    return picks(spark, root, 700, since=False).select("user_id", "subreddit", "position", "post_id")


@query
def union_posts(spark, root):
    """All posts of two platforms as one frame: English posts as one, the others as the other."""
    rows = views.posts(spark, root).select("subreddit", "post_id", "score", "flair")
    here, there = rows.filter("flair = 'en'"), rows.filter("flair <> 'en'").select("score", "flair", "post_id", "subreddit")
    return selection.union_posts(here.withColumn("branch", F.lit("one")), there.withColumn("branch", F.lit("other"))).drop("flair")


@query
def distinct_ordered(spark, root):
    return topics.unique_texts(topic_texts(spark, root), TOPIC, ORDER).select(*TOPIC, "post_id", "n_chars")


@query
def token_intersection(spark, root):
    rows = views.posts(spark, root)
    titles, bodies = (rows.select("subreddit", F.col(c).alias("text")) for c in ("title", "selftext"))
    return products.token_intersection(titles, bodies, ["subreddit"], "text", tx.clean_text)


@query
def sample_posts(spark, root):
    made = topics.sample_posts(topic_texts(spark, root), TOPIC, ORDER)
    return made.select(*TOPIC, F.size("sample_posts").alias("n_samples"), listed("sample_posts", results.SAMPLE_JOINER).alias("sample_posts"))


@query
def topk_terms_per_topic(spark, root):
    return products.topk_terms(topic_texts(spark, root), TOPIC, "text")


# ---- scalar functions -------------------------------------------------------------

@query
def scalar_text(spark, root):
    c = tx.clean_text(F.col("text"))
    word = F.col("title_words")
    rows = documents(spark, root).select("doc_id", c.alias("clean"), "source").withColumn(
        "title_words", F.concat(F.lit("fine-tuning "), F.lower("clean"), F.lit(" 3d")))
    return rows.select(
        "doc_id", F.lower("clean").alias("lowered"), F.upper("source").alias("uppered"),
        tx.capitalize_first(F.lower("clean")).alias("capitalized"), tx.title_case(word).alias("titled"),
        F.length("clean").alias("n_chars"), tx.ascii_only(F.col("clean")).alias("ascii"),
        F.startswith("source", F.lit("src1")).alias("is_src1"), F.regexp_replace("source", "^src", "").alias("number"),
        F.size(tx.words(F.col("clean"))).alias("n_words"), tx.as_sentence(F.col("clean")).alias("sentence"))


@query
def scalar_time(spark, root):
    as_of = instant(views.AS_OF)
    seconds = micros("ts") / 1e6
    return views.events(spark, root).select(
        "event_id", micros_of(times.epoch_to_instant(seconds)).alias("back_us"),
        fixed(times.age_days(F.col("ts"), as_of)).alias("age_days"), fixed(times.recency(F.col("ts"), as_of)).alias("recency"))


@query
def scalar_math(spark, root):
    e = F.col("embedding")
    first = F.get(e, F.lit(0)).cast("double")
    return views.table(spark, root, "embeddings").select(
        "vec_id", F.bround(F.col("vec_id") / 2).cast("bigint").alias("half_even"),
        F.greatest(F.lit(0.1), F.least(F.lit(0.5), fixed(first, 4))).alias("clamped"),
        fixed(vec.norm(e)).alias("norm"), fixed(vec.dot(e, F.reverse(e))).alias("dot"))


@query
def scalar_array(spark, root):
    return views.messy_users(spark, root).select(
        "user_id", F.size(F.array_distinct("subreddits")).alias("n_distinct"),
        listed(F.array_intersect("subreddits", F.array(F.lit("src1"), F.lit("src2")))).alias("shared"),
        F.arrays_overlap("personas", F.array(F.lit("BUILDING"), F.lit("MACHINERY"))).alias("overlaps"),
        listed(F.slice("subreddits", 1, 3)).alias("first_three"), F.array_contains("subreddits", "src3").alias("in_src3"))


@query
def scalar_map_json(spark, root):
    """JSON to a typed value and back; a lookup with a default; nulls replaced."""
    props = F.from_json("props", "k int")
    pair = F.map_from_entries(F.array(F.struct("event_type", F.col("p.k"))))
    return views.events(spark, root).withColumn("p", props).select(
        "event_id", F.to_json("p").alias("props_json"), F.col("p.k").alias("k"),
        arrays.map_get(pair, F.lit("view"), F.lit(-1)).alias("views"),
        F.coalesce(F.nullif("event_type", F.lit("error")), F.lit("none")).alias("kind"),
        F.size(arrays.or_empty(F.from_json(F.lit(None).cast("string"), "array<int>"))).alias("n_missing"))


# ---- text, features, topics ----------------------------------------------------

@query
def embed_posts(spark, root):
    embeddings = views.table(spark, root, "embeddings")
    keyed = views.posts(spark, root).select("post_id", (F.col("event_id") % views.row_count(embeddings)).alias("vec_id"))
    return topics.embed_posts(keyed, embeddings, "vec_id").select("post_id", "vec_id", F.size("embedding").alias("dims"), fixed(vec.norm(F.col("embedding"))).alias("norm"))


@query
def num_topics(spark, root):
    return topics.topic_plan(views.posts(spark, root), ["author_id"]).select("author_id", "n_posts", "num_topics")


@query
def topic_mode(spark, root):
    return topics.topic_plan(views.posts(spark, root), ["subreddit", "flair", "num_comments"]).select("subreddit", "flair", "num_comments", "num_topics", "mode")


@query
def kmeans_topics(spark, root):
    rows = views.posts(spark, root).select("post_id", "subreddit").join(views.vectors(spark, root).select("post_id", "embedding"), "post_id")
    made = topics.kmeans_topics(rows, ["subreddit"])
    # What any engine can tell of it: all posts placed, as many topics as planned, and how
    # many posts are nearer to the mean of another topic than to their own.
    own = made.join(rows, ["subreddit", "post_id"])
    means = own.groupBy("subreddit", "topic_index").agg(vector_to_array(Summarizer.mean(array_to_vector("embedding"))).alias("centroid"))
    again = topics.assign_nearest_centroid(own.withColumnRenamed("topic_index", "topic"), means, ["subreddit"])
    return again.groupBy("subreddit").agg(
        F.count(F.lit(1)).alias("n_posts"), F.countDistinct("topic").alias("n_topics"),
        F.sum((F.col("topic") != F.col("topic_index")).cast("long")).alias("n_misplaced"))


@query
def assign_nearest_centroid(spark, root):
    mean = vector_to_array(Summarizer.mean(array_to_vector("embedding")))
    centroids = views.table(spark, root, "embeddings").groupBy(F.col("label").alias("topic_index")).agg(mean.alias("centroid"))
    return topics.assign_nearest_centroid(views.vectors(spark, root), centroids).select("post_id", "topic_index")


@query
def topic_text(spark, root):
    return topics.topic_text(topic_texts(spark, root), TOPIC, ORDER)


@query
def topic_text_single(spark, root):
    rows = readable(views.posts(spark, root)).select("subreddit", *ORDER, "text")
    return topics.topic_text(rows, ["subreddit"], ORDER, unique=False)


def documents(spark, root) -> DataFrame:
    return views.dealt_out(views.table(spark, root, "documents"))


def clean_documents(spark, root) -> DataFrame:
    return documents(spark, root).select("doc_id", tx.clean_text(F.col("text")).alias("topic_text"))


@query
def chunk_text(spark, root):
    return products.chunk_text(clean_documents(spark, root))


@query
def split_sentences(spark, root):
    return products.sentences(clean_documents(spark, root))


@query
def dedupe_exact(spark, root):
    rows = products.sentences(clean_documents(spark, root))
    return products.dedupe_exact(rows, ["doc_id"], "sentence", ["sentence_index"]).select("doc_id", "sentence_index", "sentence")


@query
def dedupe_similar(spark, root):
    kept = similarity.dedupe_similar(views.table(spark, root, "embeddings"), ["label"], ["vec_id"], "vec_id", "embedding", NEAR)
    return kept.select("label", "vec_id")


@query
def extractive_summary(spark, root):
    return topic_summaries(spark, root)


@query
def keywords(spark, root):
    return products.keywords(clean_documents(spark, root), ["doc_id"], "topic_text").select("doc_id", "keyword", "n", "keyword_rank")


@query
def topic_title(spark, root):
    return products.topic_title(topic_summaries(spark, root), TOPIC)


@query
def topic_title_given(spark, root):
    """Titles proposed by the source system: the first words of each document."""
    rows = clean_documents(spark, root).withColumn("given", F.array_join(F.slice(tx.words(F.col("topic_text")), 1, F.pmod("doc_id", F.lit(10)).cast("int")), " "))
    return products.topic_title(rows.withColumnRenamed("topic_text", "summary"), ["doc_id"], candidate="given")


@query
def topic_bullets(spark, root):
    made = topic_summaries(spark, root).select(*TOPIC, products.topic_bullets(F.col("summary")).alias("b"))
    return made.select(*TOPIC, F.posexplode("b").alias("bullet_index", "bullet"))


@query
def bullet_clean(spark, root):
    """Document lines as a marked bullet list, cleaned again."""
    marked = F.concat(F.lit("- "), F.regexp_replace("text", "\n", "\n*  Bullets: "))
    rows = documents(spark, root).select("doc_id", marked.alias("text"))
    return products.bullet_clean(rows, "text")


@query
def summary_metrics(spark, root):
    texts = topic_texts(spark, root)
    return products.summary_metrics(texts, topic_summaries(spark, root, texts), TOPIC)


@query
def topic_polarity(spark, root):
    rows = clean_documents(spark, root).withColumnRenamed("topic_text", "text")
    labelled = rows.join(views.table(spark, root, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    made = polarity.topic_polarity(topic_summaries(spark, root), polarity.fit_polarity(labelled))
    label, score = F.col("polarity_label"), F.col("polarity_score")
    return made.select(*TOPIC, (label.isin(polarity.POSITIVE, polarity.NEGATIVE) & score.between(0.5, 1.0)).alias("scored"))


def run_topics(spark, root, n: int) -> DataFrame:
    """Every topic of every (user, community) of a run with a budget of ``n``; communities without posts have one row."""
    posts = materialize(views.posts(spark, root), "posts")
    s = run.RunSettings(views.AS_OF, views.RUN_TS, n)
    made = run.run_analysis(posts, views.users(spark, root), views.live_runs(spark, root),
                            views.vectors(spark, root).select("post_id", "embedding"), s)
    flat = made["payload"].select("user_id", "source", "top_n_total", "allocations", F.explode("subreddits").alias("subreddit", "result"))
    return flat.select(
        "user_id", "source", "top_n_total", "subreddit", F.element_at("allocations", F.col("subreddit")).alias("allocated"), "result",
        F.explode_outer("result.topics").alias("topic"))


@query
def run_payload(spark, root):
    topic = F.col("topic")
    return run_topics(spark, root, 100).select(
        "user_id", "source", "top_n_total", "subreddit", "allocated", "result.post_count",
        F.coalesce(F.size("result.topics"), F.lit(0)).alias("n_topics"), topic["topic_index"].alias("topic_index"),
        topic["title"].alias("title"), listed(topic["bullets"]).alias("bullets"),
        F.coalesce(F.size(topic["post_indices"]), F.lit(0)).alias("n_placed"), fixed("result.eda.avg_score").alias("avg_score"))


@query
def run_payload_clustered(spark, root):
    """A budget large enough to be clustered. Which topic a post falls into no other engine can tell, but how many
    topics there are, that every post is in one of them, and what each topic comes with."""
    topic = F.col("topic")
    placed = F.flatten(F.transform("result.topics", lambda t: t["post_indices"]))
    complete = (F.length(topic["title"]) > 0) & F.size(topic["sample_posts"]).between(1, 3) & (
        topic["metrics"]["summary_length"] > 0)
    return run_topics(spark, root, 700).select(
        "user_id", "subreddit", "allocated", "result.post_count", F.coalesce(F.size("result.topics"), F.lit(0)).alias("n_topics"),
        topic["topic_index"].alias("topic_index"), F.size(F.array_distinct(placed)).cast("long").alias("n_placed"),
        complete.alias("complete"), fixed("result.eda.avg_score").alias("avg_score"))


@query
def land_feed(spark, root):
    """What a run stores of its feed, twice, as after a failure: tables, rows and what each row comes with."""
    posts = materialize(views.posts(spark, root).drop("event_id"), "posts")
    s = run.RunSettings(views.AS_OF, views.RUN_TS)
    users = views.users(spark, root)
    made = run.run_analysis(posts, users, views.live_runs(spark, root), views.vectors(spark, root).select("post_id", "embedding"), s)
    folder = new_path(spark, "landed-feed")
    subscribers = users.filter(~F.array_contains("personas", "BUILDING"))
    for _ in range(2):
        tables = run.land_feed(made, posts, subscribers, folder, s)
    rows = {
        "users": (F.col("user_id"), F.size("personas")), "posts": (F.col("post_id"), F.col("score")),
        "feed_cache": (F.col("user_id"), F.size("raw_posts")), "feed_runs": (F.col("user_id"), (F.col("run_status") == "success").cast("int"))}
    return selection.union_posts(*[
        tables[name].select(F.lit(name).alias("table_name"), key.alias("key"), value.cast("long").alias("value")) for name, (key, value) in rows.items()])


@query
def community_errors(spark, root):
    rules = {"score out of range": F.col("score") >= 300, "no comments": F.col("num_comments") == 0}
    valid, errors = results.community_errors(views.posts(spark, root), rules)
    kept = valid.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_posts")).withColumn("error", F.lit(None).cast("string"))
    return errors.unionByName(kept.select(*errors.columns))


# ---- streams ---------------------------------------------------------------------

def event_stream(spark, root) -> DataFrame:
    schema = views.table(spark, root, "events").schema
    # A pattern, so that the table may be one file or a folder of files.
    return streams.stream_files(spark, f"{root}/event[s].parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))


def resent(stream: DataFrame) -> DataFrame:
    """Every row twice, as after a retry at the source; of some the copy has a later time."""
    again = F.when(F.col("event_type") == "error", F.col("ts") + F.expr("INTERVAL 3 DAYS")).otherwise(F.col("ts"))
    return stream.withColumn("ts", F.explode(F.array(F.col("ts"), again)))


@query
def stream_ingest_posts(spark, root):
    posts_path, users_path, state = (new_path(spark, n) for n in ("posts", "users", "ingest"))
    schema = readers.rows_with_schema(views.posts(spark, root), schemas.POSTS).schema
    known = views.users(spark, root).filter(~F.array_contains("personas", "BUILDING"))
    writers.append_table(known, users_path)
    streams.append_by_day(readers.rows_with_schema(views.posts(spark, root), schemas.POSTS).filter("score >= 100"), posts_path, "created_at")

    def to_posts(batch: DataFrame) -> DataFrame:
        made = views.posts_of(batch, root).withColumn("cleaned_content", tx.cleaned_content(F.col("content")))
        return readers.rows_with_schema(made, schemas.POSTS)

    streams.stream_ingest_posts(resent(event_stream(spark, root)), to_posts, posts_path, users_path, state, schema, schemas.USERS,
                                head=(views.post_name(F.col("event_id")), F.col("ts")))
    stored = spark.read.schema(schema).parquet(posts_path)
    users = spark.read.schema(schemas.USERS).parquet(users_path)
    joined = stored.join(users.select(F.col("user_id").alias("author_id"), F.size("personas").alias("n_personas")), "author_id")
    return joined.select("post_id", "author_id", "subreddit", "score", "n_personas")


@query
def stream_dedupe(spark, root):
    path, state = new_path(spark, "deduped"), new_path(spark, "dedupe-state")
    rows = resent(event_stream(spark, root)).select("event_id", "user_id", "event_type", "ts")
    streams.stream_dedupe(rows, path, state, ["event_id"], "ts")
    return spark.read.parquet(path).select("event_id", "user_id", "event_type")


@query
def stream_run_state(spark, root):
    rows = event_stream(spark, root).select(
        views.user_name(F.col("user_id")).alias("user_id"), F.concat(F.lit("reddit:"), "event_type").alias("source"),
        F.col("ts").alias("last_run_at"), F.col("event_id").cast("string").alias("output_id"))
    made = streams.stream_run_state(rows, new_path(spark, "state"), new_path(spark, "state-log"), ["user_id", "source"], "last_run_at", "output_id")
    return made.select("user_id", "source", micros("last_run_at").alias("last_run_us"), "output_id")


@query
def stream_activity(spark, root):
    path, state = new_path(spark, "activity"), new_path(spark, "activity-state")
    rows = event_stream(spark, root).select(
        F.col("event_type").alias("subreddit"), F.col("ts").alias("created_at"), F.floor("value").cast("int").alias("score"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("num_comments"))
    streams.stream_activity(rows, path, state)
    return streams.activity_windows(spark, path).select("subreddit", micros("window_start").alias("window_us"), "n_posts", "score_sum", "comment_sum")
