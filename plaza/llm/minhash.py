"""Near-duplicate groups by SuperMinHash.

1. Every text becomes its set of word shingles (64-bit numbers), a fingerprint of the set
   and a SuperMinHash signature. Rows of equal sets are one class from here on, standing
   under its smallest ``doc_id``.
2. Banding: classes that agree in all places of a band share a bucket. Within a bucket a
   pair is a candidate if the signatures agree in nearly as many places as the threshold
   asks (six standard deviations are allowed for). A bucket passes on a spanning forest
   of its candidates only; union-find over the forests gives families.
3. Verification: the texts of a family meet, and every pair of it that is not linked
   already through others is compared on full sets. Union-find over the links that hold
   gives the groups.

A bucket or family of more than BLOCK rows is dealt out by pairs of blocks, so no task
holds it whole, and no step emits its pairs. A pair at the threshold is missed with a
probability below 1e-7 (no common band, or signatures that agree too little).

Contract
- A-Z count as a-z; words are runs outside ``[\\x20\\x09-\\x0D]``; shingles have SHINGLE words. A
  shorter text is one shingle; a text without words has the empty set and no links. Null
  text counts as empty.
- Rows that share a ``doc_id`` count as one document with the links of all its rows. A row
  without id is linked with nothing: null ``component_id``, kept.
- An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plaza.llm import shingles
from plaza.llm.common import Scratch, batches_of, whole_text
from plaza.llm.grouping import components, forest, in_runs

PLACES, BAND = 128, 4
BLOCK = 2_000
SLICE_CHARS = 500_000
# The rows of families as bits: at most this many / 8 bytes (32 MiB) go to every task.
BITS, BITS_PER_BUCKET = 1 << 28, 32_768

_PRINT = "doc_id long, n_shingles long, whole binary, signature binary, bands array<long>"


def _prints(size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", SLICE_CHARS):
            sets = shingles.shingle_sets([t.encode("utf-8", "surrogatepass") for t in frame.text], size)
            some = [i for i, s in enumerate(sets) if len(s)]
            signature = shingles.super_minhash([sets[i] for i in some], PLACES).view(np.uint64)
            bands = np.zeros((len(some), PLACES // BAND), dtype=np.uint64)
            for k in range(BAND):
                bands = shingles.mixed(bands + signature[:, k::BAND])
            bands = shingles.mixed(bands + np.arange(PLACES // BAND, dtype=np.uint64)).view(np.int64)
            short = (shingles.mixed(signature) >> np.uint64(56)).astype(np.uint8)
            place = {i: k for k, i in enumerate(some)}
            yield pd.DataFrame({
                "doc_id": frame.doc_id.to_numpy(), "n_shingles": [len(s) for s in sets],
                "whole": [_fingerprint(s) if len(s) else None for s in sets],
                "signature": [short[place[i]].tobytes() if i in place else None for i in range(len(sets))],
                "bands": [bands[place[i]] if i in place else None for i in range(len(sets))]})

    return run


def _fingerprint(s: np.ndarray) -> bytes:
    """128 bits of a set: two sums over its elements."""
    return shingles.mixed(s).sum(dtype=np.uint64).tobytes() + shingles.mixed(s ^ shingles.MIX_2).sum(dtype=np.uint64).tobytes()


def _candidates(least: int):
    """A spanning forest of the pairs in a bucket whose signatures agree in ``least`` places."""

    def work(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        marks = np.frombuffer(b"".join(frame.signature), dtype=np.uint8).reshape(len(frame), -1)
        docs = frame.doc_id.to_numpy()
        sizes = np.diff(np.append(starts, len(frame)))
        two = starts[sizes == 2]
        two = two[(marks[two] == marks[two + 1]).sum(axis=1) >= least]
        a, b = [docs[two]], [docs[two + 1]]
        for lo, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            own = marks[lo:lo + n]
            links = forest(n, lambda i, rest: (own[rest] == own[i]).sum(axis=1) >= least)
            if links:
                x, y = np.array(links).T
                a.append(docs[lo + x])
                b.append(docs[lo + y])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return in_runs(["key", "i", "j"], work)


def _verified(size: int, percent: int):
    """A spanning forest of the links in a family, on full sets."""

    def work(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        docs, a, b = frame.doc_id.to_numpy(), [], []
        for lo, hi in zip(starts, [*starts[1:], len(frame)]):
            if hi - lo > 1:
                sets = shingles.shingle_sets([t.encode("utf-8", "surrogatepass") for t in frame.text.iloc[lo:hi]], size)
                for x, y in forest(hi - lo, _compared(sets, percent)):
                    a.append(docs[lo + x])
                    b.append(docs[lo + y])
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    return in_runs(["root", "i", "j"], work)


def _compared(sets: list[np.ndarray], percent: int):
    sizes = np.array([len(s) for s in sets])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(names), dtype=bool)

    def linked(i: int, rest: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rest), dtype=bool)
        near = np.flatnonzero(100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i]))
        if len(near):
            mark[flat[begin[i]:begin[i + 1]]] = True
            of = rest[near]
            index = np.repeat(begin[of] - np.concatenate([[0], np.cumsum(sizes[of])[:-1]]), sizes[of]) + np.arange(sizes[of].sum())
            common = np.add.reduceat(mark[flat[index]].astype(np.int64), np.concatenate([[0], np.cumsum(sizes[of])[:-1]]))
            mark[flat[begin[i]:begin[i + 1]]] = False
            out[near] = 100 * common >= percent * (sizes[of] + sizes[i] - common)
        return out

    return linked


def _in_blocks(rows: DataFrame, key: str, count: str) -> DataFrame:
    """Rows dealt to the pairs of blocks of their group: all rows of a pair of blocks meet.
    A group of up to BLOCK rows is one block."""
    blocks = F.ceil(F.col(count) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks.cast("long")).cast("int")
    # With two blocks or more the pairs i < j already bring the rows of one block together.
    with_each = F.when(blocks == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), blocks - 1), lambda o: o != F.col("own")))
    spread = rows.withColumn("own", own).withColumn("other", F.explode(with_each))
    spread = spread.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("own", "other", count)
    return spread.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "doc_id")


def _bit(number) -> tuple:
    bit = F.pmod(F.xxhash64(number), F.lit(BITS))
    return F.floor(bit / BITS_PER_BUCKET).cast("int"), bit % BITS_PER_BUCKET


def _perhaps_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` may be among ``ids``, by a bitmap of bounded size."""
    bucket, place = _bit(F.col("doc_id"))
    bitmaps = ids.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bitmap"))
    byte = F.conv(F.hex(F.substr("bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.withColumn("bucket", bucket).join(F.broadcast(bitmaps), "bucket").filter(
        byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) > 0).drop("bucket", "bitmap")


def near_groups(docs: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    named = texts.filter("doc_id IS NOT NULL")
    prints = scratch.write(named.mapInPandas(_prints(size), _PRINT), "prints")
    classes = scratch.write(
        prints.filter("whole IS NOT NULL").groupBy("whole").agg(F.min("doc_id").alias("doc_id")), "classes")

    one_each = prints.filter("whole IS NOT NULL").join(classes, ["whole", "doc_id"], "left_semi").dropDuplicates(["whole", "doc_id"])
    one_each = scratch.write(one_each.select("doc_id", "signature", "bands"), "one-each")
    banded = one_each.select("doc_id", F.explode("bands").alias("key"))
    crowded = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = scratch.write(banded.join(crowded, "key"), "members")
    t = percent / 100
    least = int(np.floor(PLACES * t - 6 * np.sqrt(PLACES * t * (1 - t))))
    met = _in_blocks(members.join(one_each.select("doc_id", "signature"), "doc_id"), "key", "n")
    maybe = met.mapInPandas(_candidates(least), "a long, b long")
    families = scratch.write(components(maybe, scratch, "maybe"), "families")

    sizes = families.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    wanted = families.join(sizes, "root").withColumnRenamed("node", "doc_id")
    whole = _perhaps_in(named, families.select(F.col("node").alias("doc_id"))).join(wanted, "doc_id")
    links = _in_blocks(whole, "root", "n").mapInPandas(_verified(size, percent), "a long, b long")
    groups = scratch.write(components(links, scratch, "links"), "groups")
    scratch.drop("one-each", "members", "families")

    placed = classes.join(groups, classes["doc_id"] == groups["node"], "left").select(
        "whole", F.coalesce("root", "doc_id").alias("component_id"))
    out = prints.select("doc_id", "n_shingles", "whole").join(placed, "whole", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = texts.filter("doc_id IS NULL").mapInPandas(_prints(size), _PRINT).select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
