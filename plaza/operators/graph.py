"""The follow graph: how personas overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Weight of a user with a shared persona and of any other user.
OVERLAP_WEIGHT, OTHER_WEIGHT = 5, 1


def _persona_set() -> Column:
    return F.array_sort(F.array_distinct(F.coalesce("personas", F.array().cast("array<string>"))))


def persona_sets(users: DataFrame) -> DataFrame:
    """Users per distinct set of personas. Personas come from a short fixed
    vocabulary and a user has two, so sets are few however many users there are."""
    return users.select(_persona_set().alias("personas")).groupBy("personas").agg(F.count(F.lit(1)).alias("n_users"))


def overlapping_sets(sets: DataFrame) -> DataFrame:
    """Ordered pairs of sets that share a persona, a set with itself included."""
    by_persona = sets.select(F.explode("personas").alias("persona"), "personas", "n_users")
    a = by_persona.select("persona", F.col("personas").alias("set_a"), F.col("n_users").alias("n_a"))
    b = by_persona.select("persona", F.col("personas").alias("set_b"), F.col("n_users").alias("n_b"))
    return a.join(b, "persona").drop("persona").distinct()


def persona_overlap_pairs(users: DataFrame) -> DataFrame:
    """All ordered user pairs (self excluded) with their follow weight, grouped
    by persona set: ``set_a, set_b, weight, n_pairs``.

    Two users weigh the same as any two others of their sets, so the pairs are
    counted, not listed. Pairs without a shared persona are one row per set,
    with a null ``set_b``. ``n_pairs`` adds up to n * (n - 1).
    """
    sets = persona_sets(users)
    close = overlapping_sets(sets)
    itself = F.when(F.col("set_a") == F.col("set_b"), F.col("n_a")).otherwise(0)
    shared = close.select("set_a", "set_b", F.lit(OVERLAP_WEIGHT).alias("weight"), (F.col("n_a") * F.col("n_b") - itself).alias("n_pairs"))
    counted = shared.groupBy("set_a").agg(F.sum("n_pairs").alias("_shared"))
    n = users.agg(F.count(F.lit(1))).scalar()
    rest = sets.withColumnRenamed("personas", "set_a").join(counted, "set_a", "left").select(
        "set_a", F.lit(None).cast("array<string>").alias("set_b"), F.lit(OTHER_WEIGHT).alias("weight"),
        (F.col("n_users") * (n - 1) - F.coalesce("_shared", F.lit(0))).alias("n_pairs"))
    return shared.unionByName(rest).filter("n_pairs > 0")
