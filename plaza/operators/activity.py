"""How active each community is, and how a user's post budget is split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plaza.functions import times
from plaza.functions.arrays import let, unnest
from plaza.operators.keys import top_per_key

# Weights of score, comments and recency; floors; the activity of a
# community without posts; communities of a user who names none.
SCORE_WEIGHT, COMMENT_WEIGHT, RECENCY_WEIGHT = 0.5, 0.3, 0.2
RECENCY_SCALE = 100.0
ACTIVITY_FLOOR = 0.1
NO_POSTS_ACTIVITY = 1.0
SHARE_FLOOR = 0.0001
DEFAULT_SUBREDDITS = ["technology", "machinelearning", "datascience"]


def user_subreddits(users: DataFrame) -> DataFrame:
    """One row per user and community, in the user's order: blanks dropped,
    lower-cased, repeats dropped, defaults where nothing is left."""
    named = F.filter(F.coalesce("subreddits", F.array().cast("array<string>")), lambda s: s.isNotNull() & (s != ""))
    listed = F.array_distinct(F.transform(named, F.lower))
    default = F.array(*[F.lit(s) for s in DEFAULT_SUBREDDITS])
    chosen = F.when(F.size(listed) == 0, default).otherwise(listed)
    return unnest(users, ["user_id"], chosen, "subreddit", "pos")


def community_activity(posts: DataFrame, communities: DataFrame, as_of: str | Column, sample: int = 12) -> DataFrame:
    """Activity of every row of ``communities`` (column ``subreddit``) from its
    newest ``sample`` posts."""
    order = [F.col("created_at").desc_nulls_last(), F.col("post_id")]
    slim = posts.select("subreddit", "post_id", "created_at", "score", "num_comments")
    newest = top_per_key(slim, ["subreddit"], order, k=sample)

    def positive(c: str) -> Column:
        return F.greatest(F.lit(0), F.coalesce(F.col(c), F.lit(0)))

    fresh = F.avg(times.recency(F.col("created_at"), times.as_instant(as_of)))
    mixed = (
        SCORE_WEIGHT * F.avg(positive("score"))
        + COMMENT_WEIGHT * F.avg(positive("num_comments"))
        + RECENCY_WEIGHT * (fresh * RECENCY_SCALE)
    )
    measured = newest.groupBy("subreddit").agg(F.greatest(F.lit(ACTIVITY_FLOOR), mixed).alias("activity"))
    return communities.select("subreddit").distinct().join(measured, "subreddit", "left").select(
        "subreddit", F.coalesce("activity", F.lit(NO_POSTS_ACTIVITY)).alias("activity"))


def attach_activity(subscriptions: DataFrame, activity: DataFrame) -> DataFrame:
    return subscriptions.join(activity, "subreddit", "left").select(
        "user_id", "pos", "subreddit", F.coalesce("activity", F.lit(NO_POSTS_ACTIVITY)).alias("activity"))


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def _trim(shares: Column, base: Column, excess: Column, low: int) -> Column:
    """Take ``excess`` posts away, from the smallest share upwards, never below
    ``low``. A community gives up what those before it could not cover."""
    zipped = F.zip_with(shares, base, lambda share, b: F.struct(share.alias("share"), b.alias("base")))
    entries = F.array_sort(F.transform(zipped, lambda e, i: F.struct(e["share"].alias("share"), i.alias("pos"), e["base"].alias("base"))))

    def step(state: Column, e: Column) -> Column:
        take = F.greatest(F.lit(0), F.least(e["base"] - low, state["left"]))
        done = F.struct(e["pos"].alias("pos"), (e["base"] - take).alias("n"))
        return F.struct((state["left"] - take).alias("left"), F.concat(state["out"], F.array(done)).alias("out"))

    empty = F.array().cast("array<struct<pos:int,n:bigint>>")
    walked = F.aggregate(entries, F.struct(excess.alias("left"), empty.alias("out")), step)
    return F.transform(F.array_sort(walked["out"]), lambda e: e["n"])


def _fill(base: Column, missing: Column, high: int) -> Column:
    """Hand out ``missing`` posts one at a time, round robin over the communities
    still below ``high``. The turn counter runs on while the circle shrinks, so
    the next community after a full one depends on both.

    Each step of the fold is one stretch in which the circle stays the same:
    either it ends with a community filled up or the posts run out. A user
    with n communities therefore needs at most n steps, whatever the budget.
    """
    zero = F.lit(0).cast("bigint")

    def serve(alloc: Column, turn: Column, left: Column, circle: Column) -> Column:
        m = F.size(circle).cast("bigint")
        # Turns to wait until a member is served, and until it is full.
        waits = F.transform(circle, lambda _, j: F.pmod(j.cast("bigint") - F.pmod(turn, m), m))

        def with_waits(waits: Column) -> Column:
            full = F.zip_with(circle, waits, lambda i, w: w + (high - F.get(alloc, i) - 1) * m + 1)

            def with_turns(turns: Column) -> Column:
                gains = F.transform(waits, lambda w: F.when(turns > w, F.floor((turns - 1 - w) / m) + 1).otherwise(zero).cast("bigint"))
                return let(F.map_from_arrays(circle, gains), lambda gained: F.struct(
                    F.transform(alloc, lambda a, i: a + F.coalesce(F.element_at(gained, i), zero)).alias("alloc"),
                    (turn + turns).alias("turn"), (left - turns).alias("left")))

            return let(F.least(left, F.array_min(full)), with_turns)

        return let(waits, with_waits)

    def step(state: Column, _: Column) -> Column:
        spots = F.sequence(F.lit(0), F.size(state["alloc"]) - 1)
        circle = F.filter(spots, lambda i: F.get(state["alloc"], i) < high)
        return let(circle, lambda c: F.when(
            (state["left"] > 0) & (F.size(c) > 0), serve(state["alloc"], state["turn"], state["left"], c)).otherwise(state))

    start = F.struct(base.alias("alloc"), F.lit(0).cast("bigint").alias("turn"), missing.alias("left"))
    return F.aggregate(F.sequence(F.lit(1), F.size(base)), start, step)["alloc"]


def allocate_budget(subscriptions: DataFrame, top_n_total: int = 100, min_per_sub: int = 5, max_per_sub: int = 40) -> DataFrame:
    """Split ``top_n_total`` posts over each user's communities by activity.

    Input: ``user_id, pos, subreddit, activity``. Shares are rounded half-even
    and clamped to the bounds; a surplus is trimmed from the least active, a
    remainder handed out round robin. One shuffle by user; a user's list is as
    long as the subscription array it came from, and the arithmetic is
    row-local.
    """
    entry = F.struct("pos", "subreddit", "activity")
    per_user = subscriptions.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("subs"))
    shares = per_user.withColumn("raw", F.transform("subs", lambda s: F.greatest(F.lit(SHARE_FLOOR), s["activity"])))
    total = shares.withColumn("sum", F.aggregate("raw", F.lit(0.0), lambda acc, x: acc + x))
    low, high = F.lit(min_per_sub).cast("bigint"), F.lit(max_per_sub).cast("bigint")
    rounded = total.withColumn("base", F.transform("raw", lambda r: F.least(
        high, F.greatest(low, F.bround(r / F.col("sum") * top_n_total).cast("bigint")))))
    gap = rounded.withColumn("gap", F.lit(top_n_total).cast("bigint") - _sum(F.col("base")))
    split = (
        F.when(F.col("gap") < 0, _trim(F.col("raw"), F.col("base"), -F.col("gap"), min_per_sub))
        .when(F.col("gap") > 0, _fill(F.col("base"), F.col("gap"), max_per_sub))
        .otherwise(F.col("base"))
    )
    out = gap.withColumn("split", split)
    paired = F.zip_with("subs", "split", lambda s, n: F.struct(s.alias("sub"), n.alias("n")))
    return unnest(out, ["user_id"], paired, "e").select(
        "user_id", "e.sub.pos", "e.sub.subreddit", "e.sub.activity", F.col("e.n").cast("int").alias("allocated"))


def attach_allocations(communities: DataFrame, allocations: DataFrame) -> DataFrame:
    """Budget per (user, community), 0 where none was given."""
    return communities.join(
        allocations.select("user_id", "subreddit", "allocated"), ["user_id", "subreddit"], "left"
    ).withColumn("allocated", F.coalesce("allocated", F.lit(0)))
