"""Connected components of links, and runs of sorted groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plaza.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``node, root`` for every linked node: the smallest node it can reach.

    Union-find by turns of two star steps. In the large-star step every node ties its
    larger neighbours to the smallest one around it, in the small-star step its smaller
    neighbours and itself. Links shrink to stars around the roots in a number of turns
    that grows with the logarithm of the nodes. Links of a node that holds many are only
    joined with one number, its smallest neighbour.
    """
    ordered = lambda a, b: [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    edges = scratch.write(links.select(*ordered("a", "b")).filter("u <> v").distinct(), f"{label}-0")
    turn, last = 0, None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = scratch.write(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), f"{label}-{turn + 1}")
        # Stars do not change any more: as many links, with the same ends.
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(f"{label}-{turn}")
        turn += 1
        if state == last or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = state


def in_runs(keys: Sequence[str], work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame | None]):
    """For ``mapInPandas`` over rows sorted by ``keys``: calls ``work`` with the rows of many
    whole groups and the place where each begins. A group may span batches."""

    def starts_of(frame: pd.DataFrame) -> np.ndarray:
        new = np.ones(len(frame), dtype=bool)
        new[1:] = False
        for key in keys:
            values = frame[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            if not len(frame):
                continue
            starts = starts_of(frame)
            if held and any(held[-1][k].iloc[-1] != frame[k].iloc[0] for k in keys):
                yield from done(pd.concat(held, ignore_index=True))
                held = []
            if len(starts) > 1:
                yield from done(pd.concat([*held, frame.iloc[:starts[-1]]], ignore_index=True))
                held = [frame.iloc[starts[-1]:]]
            else:
                held.append(frame)
        if held:
            yield from done(pd.concat(held, ignore_index=True))

    def done(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        out = work(frame, starts_of(frame))
        if out is not None and len(out):
            yield out

    return run


def forest(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of n items: each is held against those not reached yet.
    ``linked(i, others)`` says which of the others item i is linked with."""
    links, rest, queue = [], np.arange(1, n), [0]
    while queue or len(rest):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
        i = queue.pop()
        if len(rest):
            hit = linked(i, rest)
            links += [(i, int(j)) for j in rest[hit]]
            queue += rest[hit].tolist()
            rest = rest[~hit]
    return links
