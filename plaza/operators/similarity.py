"""Exact cosine similarity over groups of any size."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from plaza.functions import vectors as vec
from plaza.operators.keys import top_per_key
from plaza.session import materialize

# Fixed value: similarity from which posts count as repeats.
SIMILAR_POSTS = 0.84

# A cell with more rows than a block is split into up to PIVOTS cells, at most DEPTH times.
PIVOTS, DEPTH = 16, 12
BLOCK_ROWS = 2048
# Rows per group that are settled before neighbours are looked for.
LEADERS = 1000
# Angles come from rounded cosines, so bounds get this much slack.
ANGLE_SLACK = 1e-6


def _unit(vector: str):
    length = vec.norm(F.col(vector))
    return F.transform(vector, lambda x: F.try_divide(x.cast("double"), length))


def _angle(a, b):
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), vec.dot(a, b))))


def distinct_vectors(df: DataFrame, by: Sequence[str], id: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """One row per distinct vector of a group (lowest id), and copy → that row."""
    reps = df.groupBy(*by, vector).agg(F.min(id).alias("_rep"))
    copies = df.join(reps, [*by, vector]).filter(F.col(id) != F.col("_rep")).select(*by, F.col("_rep").alias("id_a"), F.col(id).alias("id_b"))
    return reps.withColumnRenamed("_rep", id), copies


def _split(rows: DataFrame, by: list[str], id: str, block_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """A tree of cells over the unit vectors ``u`` of each group: the rows with their leaf ``cell``, and the cells of each
    level (``by..., parent, cell, pivot, radius``). A cell is split as long as it has more rows than a block, so
    the depth grows with the group; a cell's radius is the largest angle to its pivot."""
    key = [*by, "cell"]
    open_rows = materialize(rows.select(*by, id, "u", F.lit("").alias("cell")), "cells")
    done, levels = [], []
    for _ in range(DEPTH):
        sizes = open_rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_size")).withColumn("_full", F.col("_size") > block_rows)
        judged = open_rows.join(sizes, key)
        done.append(judged.filter("NOT _full").select(*by, id, "u", "cell"))
        full = materialize(judged.filter("_full").drop("_full"), "full-cells")
        if full.isEmpty():
            return _all(done), levels
        lots = top_per_key(full.withColumn("_lot", F.md5(F.col(id).cast("string"))), key, ["_lot", id], k=PIVOTS, rank="_rank")
        lots = lots.filter(F.col("_rank") <= F.ceil(F.col("_size") / block_rows) + 1)
        pivots = lots.groupBy(*key).agg(F.array_sort(F.collect_list("u")).alias("pivots"))  # at most PIVOTS
        near = F.array_min(F.transform("pivots", lambda p, i: F.struct(_angle(F.col("u"), p).alias("angle"), i.alias("at"))))
        child = F.concat("cell", F.lpad(F.col("near.at").cast("string"), 2, "0"), F.lit("/"))
        placed = materialize(full.join(pivots, key).withColumn("near", near).select(
            *by, id, "u", F.col("cell").alias("parent"), child.alias("cell"), "near.angle", F.get("pivots", F.col("near.at")).alias("pivot")), "cells")
        levels.append(placed.groupBy(*by, "parent", "cell").agg(F.max("angle").alias("radius"), F.min("pivot").alias("pivot")))
        open_rows = placed.select(*by, id, "u", "cell")
    return _all([*done, open_rows]), levels


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _meeting(groups: DataFrame, levels: list[DataFrame], by: list[str], reach: float) -> DataFrame:
    """Pairs of leaves (``by..., cell_a, cell_b``) that may hold a pair of rows within ``reach``: from the roots down, children are
    only looked at where their parents meet. Two cells meet if the angle between their pivots, less both radii, is within reach."""
    none = F.lit(None).cast("array<double>")
    pairs = groups.select(*by, *[c for side in "ab" for c in (
        F.lit("").alias(f"cell_{side}"), none.alias(f"pivot_{side}"), F.lit(math.pi).alias(f"radius_{side}"))])
    for level in levels:
        for side in "ab":
            names = [f"{c}_{side}" for c in ("cell", "pivot", "radius")]
            below = level.select(*by, F.col("parent").alias(names[0]), F.struct(*[F.col(c).alias(n) for c, n in zip(("cell", "pivot", "radius"), names)]).alias("_to"))
            own = F.coalesce("_to", F.struct(*names))
            pairs = pairs.join(below, [*by, names[0]], "left").withColumn("_own", own).drop(*names, "_to").select("*", "_own.*").drop("_own")
        gap = _angle(F.col("pivot_a"), F.col("pivot_b")) - F.col("radius_a") - F.col("radius_b")
        pairs = materialize(pairs.filter("cell_a <= cell_b").filter((F.col("cell_a") == F.col("cell_b")) | (gap <= reach)), "meeting-cells")
    return pairs.select(*by, "cell_a", "cell_b")


def similarity_join(df: DataFrame, by: Sequence[str], id: str, vector: str, threshold: float = SIMILAR_POSTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs within a group with cosine >= ``threshold``: ``by..., id_a, id_b, cosine``.

    Exact, as pairs of representatives and membership: every pair of distinct vectors is
    there once, between the rows of lowest id; a row whose vector an earlier row has is
    there once, as ``(that row, it, 1.0)``, and has all links of that row. (Pairs of copies are
    not listed: a group of n copies would have n * (n - 1) / 2.) Distinct vectors go down a tree of cells whose leaves are bounded in rows;
    two leaves meet only if the angle between their pivots, less both radii, leaves room for a pair (triangle
    inequality), and so do all cells above them. A cell that is still too large at the tree's greatest depth is split by
    hash, so a hot group becomes many block pairs of bounded size, and a task emits only the pairs that pass.
    """
    by = list(by)
    distinct, copies = distinct_vectors(df.filter(vec.norm(F.col(vector)) > 0), by, id, vector)
    rows, levels = _split(distinct.select(*by, id, _unit(vector).alias("u")), by, id, block_rows)
    celled = materialize(rows, "leaves")
    cells = celled.groupBy(*by, "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    meet = _meeting(celled.select(*by).distinct(), levels, by, math.acos(threshold) + ANGLE_SLACK)
    for side in "ab":
        meet = meet.join(cells.select(*by, F.col("cell").alias(f"cell_{side}"), F.col("blocks").alias(f"n_{side}")), [*by, f"cell_{side}"])
    tasks = (
        meet.withColumn("block_a", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)))
        .withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)))
        .filter((F.col("cell_a") < F.col("cell_b")) | (F.col("block_a") <= F.col("block_b")))
        .drop("n_a", "n_b")
    )
    task_key = [*by, "cell_a", "block_a", "cell_b", "block_b"]
    blocked = celled.join(cells.select(*by, "cell", "blocks"), [*by, "cell"]).withColumn(
        "block", F.pmod(F.xxhash64(id), F.col("blocks")).cast("int")).select(*by, "cell", "block", id, "u")

    def side(name: str) -> DataFrame:
        renamed = blocked.withColumnsRenamed({"cell": f"cell_{name}", "block": f"block_{name}"})
        return renamed.join(tasks, [*by, f"cell_{name}", f"block_{name}"]).select(*task_key, F.lit(name).alias("side"), F.col(id).alias("id"), "u")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == "a"], pdf[pdf["side"] == "b"]
        head = pdf.iloc[0]
        if left.empty or right.empty:
            i = j = np.zeros(0, dtype=int)
            sims = np.zeros((0, 0))
        else:
            sims = np.stack(left["u"].to_numpy()) @ np.stack(right["u"].to_numpy()).T
            i, j = np.nonzero(sims >= threshold)
        ida, idb = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
        same_block = head["cell_a"] == head["cell_b"] and head["block_a"] == head["block_b"]
        keep = ida < idb if same_block else np.ones(len(ida), dtype=bool)
        lo, hi = np.where(ida < idb, ida, idb)[keep], np.where(ida < idb, idb, ida)[keep]
        out = pd.DataFrame({"id_a": lo, "id_b": hi, "cosine": sims[i, j][keep]})
        for c in reversed(by):
            out.insert(0, c, head[c])
        return out

    fields = [*[df.schema[c] for c in by], *[T.StructField(n, df.schema[id].dataType) for n in ("id_a", "id_b")],
              T.StructField("cosine", T.DoubleType())]
    pairs = side("a").unionByName(side("b")).groupBy(*task_key).applyInPandas(verify, T.StructType(fields))
    return pairs.unionByName(copies.withColumn("cosine", F.lit(1.0)))


def _greedy(threshold: float):
    """Mark the rows a greedy pass in order keeps, over one bounded batch."""
    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rank")
        units = np.stack(pdf["u"].to_numpy())
        keep = np.zeros(len(pdf), dtype=bool)
        for i in range(len(pdf)):
            keep[i] = not (units[keep] @ units[i] >= threshold).any()
        return pdf.drop(columns="_rank").assign(keep=keep)

    return mark


def _drop_similar(threshold: float):
    """The rows of one bounded piece that resemble none of the kept leaders."""
    def drop(piece: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        if len(piece) and len(kept):
            sims = np.stack(piece["u"].to_numpy()) @ np.stack(kept["u"].to_numpy()).T
            piece = piece[~(sims >= threshold).any(axis=1)]
        return piece.drop(columns="_piece")

    return drop


def _settled(edges: DataFrame, by: list[str]) -> tuple[DataFrame | None, int]:
    """Rows that go, given all pairs of alike rows (``by..., early, late``), and the rounds it took.

    A row stays once all alike rows before it are gone, and goes once one of them stays. Each round settles every
    row that waits for none, so rounds follow the longest chain of rows that wait for each other, not their number.
    """
    gone: list[DataFrame] = []
    edges, rounds = materialize(edges, "alike"), 0
    end = lambda df, name: df.select(*by, F.col(name).alias("_row")).distinct()
    on = lambda df, rows, name, how: df.join(rows.withColumnRenamed("_row", name), [*by, name], how)
    while not edges.isEmpty():
        rounds += 1
        stays = end(edges, "early").join(end(edges, "late"), [*by, "_row"], "left_anti")
        struck = materialize(end(on(edges, stays, "early", "left_semi"), "late"), "struck")
        gone.append(struck)
        edges = materialize(on(on(edges, struck, "early", "left_anti"), struck, "late", "left_anti"), "alike")
    return (_all(gone) if gone else None), rounds


def dedupe_similar(
    df: DataFrame, by: Sequence[str], order: Sequence[str], id: str, vector: str,
    threshold: float = SIMILAR_POSTS, top_k: int | None = None, leaders: int = LEADERS, piece_rows: int = 8192,
) -> DataFrame:
    """Greedy near-duplicate removal per group, in order: a row stays if no row
    kept before it has cosine >= ``threshold``. Returns the rows that stay.

    The first ``leaders`` rows of every group are settled among themselves, and rows that resemble a
    kept leader are struck, in pieces of bounded size; that thins out what is alike in great numbers. Of copies that are left the first
    stays in play. The rest is joined with itself (``similarity_join``) and settled by priority (``_settled``). Rows
    before a settled one are settled, so the outcome equals the sequential pass. A vector without length is like none.
    """
    by, order = list(by), list(order)
    cols = [*by, *[c for c in order if c != id], id]
    slim = df.select(*cols, _unit(vector).alias("u")).withColumn(
        "u", F.transform("u", lambda x: F.coalesce(x, F.lit(0.0))))
    live = materialize(slim, "dedupe-live")
    row = live.schema
    marked_schema = T.StructType([*row.fields, T.StructField("keep", T.BooleanType())])
    front = top_per_key(live, by, order, k=leaders, rank="_rank")
    marked = materialize(front.groupBy(*by).applyInPandas(_greedy(threshold), marked_schema), "dedupe-leaders")
    chosen = marked.filter("keep").drop("keep")
    last = marked.groupBy(*by).agg(F.max(F.struct(*order)).alias("_last"))
    rest = live.join(last, by).filter(F.struct(*order) > F.col("_last")).drop("_last")
    pieces = rest.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / piece_rows).cast("int").alias("_n"))
    cut = rest.join(pieces, by).withColumn("_piece", F.pmod(F.xxhash64(id), F.col("_n")).cast("int")).drop("_n")
    spread = chosen.join(pieces, by).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    left = materialize(cut.groupBy(*by, "_piece").cogroup(spread.groupBy(*by, "_piece")).applyInPandas(_drop_similar(threshold), row), "dedupe-live")
    survivors = chosen.unionByName(_apart(left, by, order, id, threshold))
    if top_k:
        survivors = top_per_key(survivors, by, order, k=top_k)
    return df.join(survivors.select(*by, id), [*by, id], "left_semi")


def _apart(rows: DataFrame, by: list[str], order: list[str], id: str, threshold: float) -> DataFrame:
    """The rows that a greedy pass in order keeps. ``rows`` have unit vectors ``u``."""
    if rows.isEmpty():
        return rows
    length = vec.norm(F.col("u"))
    first = materialize(top_per_key(rows.filter(length > 0), [*by, "u"], order), "first-of-copies")
    place = first.select(*by, F.col(id).alias("_id"), F.struct(*order, F.col(id).alias("_id")).alias("_at"))
    pairs = similarity_join(first, by, id, "u", threshold).select(*by, "id_a", "id_b")
    for name in ("id_a", "id_b"):
        pairs = pairs.join(place.withColumnsRenamed({"_id": name, "_at": f"_{name}"}), [*by, name])
    early = F.when(F.col("_id_a") < F.col("_id_b"), F.col("id_a")).otherwise(F.col("id_b"))
    late = F.when(F.col("_id_a") < F.col("_id_b"), F.col("id_b")).otherwise(F.col("id_a"))
    gone, _ = _settled(pairs.select(*by, early.alias("early"), late.alias("late")), by)
    kept = first if gone is None else first.join(gone.withColumnRenamed("_row", id), [*by, id], "left_anti")
    return kept.select(*rows.columns).unionByName(rows.filter(length == 0))
