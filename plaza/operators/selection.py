"""Which posts a run takes: budget, high-water mark, top-up, feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plaza.functions import times
from plaza.functions.arrays import unnest
from plaza.operators.keys import top_per_key
from plaza.session import materialize

_PICK = "array<struct<post_id:string,created_at:timestamp>>"
# Picks that one task spreads out, at most (a user's are together).
PICKS_AT_ONCE = 500_000


def source_of(subreddit: Column, platform: str = "reddit") -> Column:
    return F.concat(F.lit(f"{platform}:"), subreddit)


def last_high_water_mark(subscriptions: DataFrame, runs: DataFrame, platform: str = "reddit") -> DataFrame:
    """``since`` of every (user, community): the time of its last run, or null."""
    marks = runs.select("user_id", "source", F.col("last_run_at").alias("since"))
    return subscriptions.withColumn("source", source_of(F.col("subreddit"), platform)).join(marks, ["user_id", "source"], "left")


def since_filter(posts: DataFrame, since: str = "since") -> DataFrame:
    return posts.filter(times.newer_than(F.col("created_at"), F.col(since)))


def _head(posts: DataFrame, order: list[Column], k: int, name: str) -> DataFrame:
    """The first ``k`` posts of every community as one array of at most ``k``."""
    slim = posts.select("subreddit", "post_id", "created_at", "score")
    ranked = top_per_key(slim, ["subreddit"], order, k=k, rank="rank")
    entry = F.struct("rank", "post_id", "created_at")
    listed = ranked.groupBy("subreddit").agg(F.array_sort(F.collect_list(entry)).alias(name))
    return listed.withColumn(name, F.transform(name, lambda e: F.struct(e["post_id"], e["created_at"])))


def select_posts(posts: DataFrame, budgets: DataFrame) -> DataFrame:
    """Posts for every (user, community) budget of ``allocated`` posts.

    The best ``allocated`` by score that are newer than ``since`` come first;
    when they fall short, that many of the newest are looked at and those newer
    than ``since`` and not yet taken are added. Both limits apply before the
    time filter.

    The two candidate lists are built once per community and hold as many ids as
    the largest budget asks for, so a user row needs one equi-join and row-local
    array work, whatever the community's size.

    ``budgets``: ``user_id, subreddit, allocated`` and optionally ``since``; a written table, as it is
    read twice.
    Returns ids with their ``position`` in the pick; join posts for content.
    """
    if "since" not in budgets.columns:
        budgets = budgets.withColumn("since", F.lit(None).cast("timestamp"))
    newest = [F.col("created_at").desc_nulls_last(), F.col("post_id")]
    best = [F.col("score").desc_nulls_last(), *newest]
    largest, picks = (n or 0 for n in budgets.agg(F.max("allocated"), F.sum("allocated")).first())
    heads = materialize(_head(posts, best, largest, "top").join(_head(posts, newest, largest, "new"), "subreddit"), "heads")
    wanted = budgets.select("user_id", "subreddit", "allocated", "since").filter(F.col("allocated") > 0)
    # A file of budgets is small and brings many picks, so tasks are dealt by picks: a task's share does not grow with the users.
    sc = budgets.sparkSession.sparkContext
    wanted = wanted.repartition(max(sc.defaultParallelism, -(-picks // PICKS_AT_ONCE)), "user_id")
    paired = wanted.join(heads, "subreddit")

    def fresh(e: Column) -> Column:
        return times.newer_than(e["created_at"], F.col("since"))

    picked = paired.withColumn("first", F.filter(F.slice("top", 1, F.col("allocated")), fresh))
    short = F.greatest(F.lit(0), F.col("allocated") - F.size("first"))
    extra = F.filter(
        F.slice("new", F.lit(1), short),
        lambda e: fresh(e) & ~F.exists("first", lambda t: t["post_id"] == e["post_id"]),
    )
    taken = F.slice(F.concat("first", extra), 1, F.col("allocated"))
    rows = unnest(picked, ["user_id", "subreddit", "allocated"], taken, "post", "position")
    return rows.select("user_id", "subreddit", "allocated", "position", "post.post_id", "post.created_at")


def flat_feed(selected: DataFrame, limit: int = 50) -> DataFrame:
    """All selected posts of a user, newest first, at most ``limit``."""
    order = [F.col("created_at").desc_nulls_last(), F.col("post_id")]
    return top_per_key(selected, ["user_id"], order, k=limit, rank="feed_rank")


def feed_meta(allocations: DataFrame, selected: DataFrame, top_n_total: int = 100) -> DataFrame:
    """Per user: requested and fetched totals, budget and activity per community."""
    fetched = selected.groupBy("user_id").agg(F.count(F.lit(1)).alias("actual_fetched_total"))
    entries = F.array_sort(F.collect_list(F.struct("pos", "subreddit", "allocated", "activity")))
    listed = allocations.groupBy("user_id").agg(entries.alias("e"))

    def as_map(field: str) -> Column:
        return F.map_from_entries(F.transform("e", lambda x: F.struct(x["subreddit"], x[field])))

    return listed.join(fetched, "user_id", "left").select(
        "user_id",
        F.lit(top_n_total).alias("requested_total"),
        F.coalesce("actual_fetched_total", F.lit(0)).alias("actual_fetched_total"),
        as_map("allocated").alias("allocations"),
        as_map("activity").alias("activity_map"),
    )


def union_posts(*branches: DataFrame) -> DataFrame:
    """Selected posts of several platforms or branches as one frame."""
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch)
    return out

