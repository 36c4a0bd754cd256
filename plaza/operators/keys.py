"""Keys: first or latest row per key, idempotent inserts, upserts, integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from plaza.functions.arrays import unnest
from plaza.session import materialize


def top_per_key(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows per key.

    A constant bound on ``row_number`` lets every map task keep only its own
    first ``k`` rows per key before the shuffle, so a hot key stays small. The
    order has to be total for a repeatable answer.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def latest_per_key(df: DataFrame, by: Sequence[str], ts: str, tie: str) -> DataFrame:
    return top_per_key(df, by, [F.col(ts).desc_nulls_last(), F.col(tie).desc()])


def first_occurrence(df: DataFrame, by: Sequence[str], key: Column, order: Sequence[Column | str]) -> DataFrame:
    """First row of each key within its group, rows with an empty key dropped.

    As an unnested array the key is worked out once per row; a filter on it
    would be pushed down and work it out again.
    """
    keyed = unnest(df, ["*"], F.array(key), "_key").filter("_key <> ''")
    return top_per_key(keyed, [*by, "_key"], order).drop("_key")


def anti_existing(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return df.join(existing.select(key), key, "left_anti").select(*df.columns)


def semi_referential(df: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    return df.join(parents.select(F.col(parent_key).alias(key)), key, "left_semi").select(*df.columns)


def point_lookup(df: DataFrame, **equals: object) -> DataFrame:
    for column, value in equals.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


def new_rows(batch: DataFrame, existing: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """The rows of ``batch`` an insert-if-absent adds: unseen keys, first wins. The unseen keys are found and
    written by themselves, so rows that are there already are not shuffled; nor is a batch whose keys are all unseen and
    stand once, which is added as it is."""
    told = materialize(batch.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")), "batch-keys")
    unseen = materialize(anti_existing(told, existing, key).select(F.col(key).alias("_new"), "_rows"), "unseen-keys")
    most, keys = told.agg(F.max("_rows"), F.count(F.lit(1))).first()
    if most == 1 and keys == unseen.count():
        return batch
    unseen = unseen.select("_new")
    return top_per_key(batch.join(unseen, F.col(key).eqNullSafe(F.col("_new")), "left_semi"), [key], order)


def author_stubs(posts: DataFrame) -> DataFrame:
    """A stub user for every author of a post."""
    none = F.array().cast(T.ArrayType(T.StringType()))
    authors = posts.select(F.col("author_id").alias("user_id")).filter(F.col("user_id") != "").distinct()
    return authors.select("user_id", F.col("user_id").alias("username"), none.alias("personas"), none.alias("subreddits"))


def missing_authors(posts: DataFrame, users: DataFrame) -> DataFrame:
    """A stub user for every author of a post who is not a user yet."""
    return anti_existing(author_stubs(posts), users, "user_id")


def upsert_latest(old: DataFrame, new: DataFrame, by: Sequence[str], ts: str, tie: str) -> DataFrame:
    """The next version of a keyed table: a new row replaces the old one."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    order = [F.col("_batch").desc(), F.col(ts).desc_nulls_last(), F.col(tie).desc()]
    return top_per_key(both, by, order).drop("_batch")


def unique_rows(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per primary key: the first by its own values."""
    return top_per_key(df, by, [F.col(c) for c in df.columns if c not in by] or list(by))


def enforce_keys(
    users: DataFrame, follows: DataFrame, posts: DataFrame, feed_runs: DataFrame,
    feed_cache: DataFrame | None = None, topics: DataFrame | None = None, mapping: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Tables that meet primary and foreign keys: duplicates rejected, orphan
    follows and posts dropped, run rows of unknown users kept without a user.
    Posts without an author are valid. Where given: cache rows of unknown users and
    mapping rows of topics that are not there are dropped."""
    users = unique_rows(users, ["user_id"])
    follows = unique_rows(follows, ["follower_id", "followed_id"])
    for end in ("follower_id", "followed_id"):
        follows = semi_referential(follows, users, end, "user_id")
    posts = unique_rows(posts, ["post_id"])
    # Kept apart from the join: null keys would all land in one task.
    authored = semi_referential(posts.filter("author_id IS NOT NULL"), users, "author_id", "user_id")
    posts = authored.unionByName(posts.filter("author_id IS NULL"))
    named = feed_runs.filter("user_id IS NOT NULL")
    known = users.select("user_id", F.col("user_id").alias("_known"))
    named = named.join(known, "user_id", "left").withColumn("user_id", F.col("_known")).drop("_known")
    runs = named.unionByName(feed_runs.filter("user_id IS NULL"))
    out = {"users": users, "follows": follows, "posts": posts, "feed_runs": runs}
    if feed_cache is not None:
        out["feed_cache"] = semi_referential(feed_cache, users, "user_id", "user_id")
    if topics is not None and mapping is not None:
        out["mapping"] = semi_referential(mapping, topics, "topic_ref", "topic_id")
    return out


def violation_report(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Rows in, rows kept, and (for runs) rows without a user, per table."""
    parts = []
    for name, df in before.items():
        for state, frame in (("in", df), ("kept", after[name])):
            parts.append(frame.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.lit(state).alias("state"), "n_rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
