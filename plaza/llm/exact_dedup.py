"""Exact dedup by an exchange of Golomb-coded fingerprints.

Each partition sorts the distinct fingerprints of its texts and sends them,
compressed, to the owners of their ranges. An owner answers every partition with a
bitmap of the fingerprints that some other partition has too. Only texts whose
fingerprint is marked (or repeated within the partition) are shuffled whole and
compared byte by byte.

Contract
- Text: null counts as empty; each run of ``[\\x20\\x09-\\x0D]`` counts as one blank.
- Of equal texts the row with the smallest ``doc_id`` stays. Rows that repeat a
  ``doc_id`` share its answer. A null ``doc_id`` is no candidate for staying unless
  the group has no other; such a group keeps its rows.
- Empty texts are equal to each other. An empty table gives no rows. Other columns
  of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from plaza.llm import golomb
from plaza.llm.common import SPACE, Scratch, named, pieces_of, unnamed, whole_text

ROWS_PER_OWNER = 250_000
SALTS = 16
# The marked fingerprints as bits: at most BITS / 8 bytes (32 MiB) go to every task.
BITS, BITS_PER_BUCKET = 1 << 28, 32_768

_SENT = "part int, doc_id long, text_sha256 string, fp long, owner int, slot int, again boolean, n int, width int, unary binary, rest binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def _send(owners: int):
    """Rows of a partition with their place in the message to the owner, then the messages."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        kept = [f for f in frames if len(f)]
        if not kept:
            return
        rows = pd.concat(kept, ignore_index=True)
        fp = rows.fp.to_numpy().astype(np.int64).view(np.uint64)
        owner = (fp % np.uint64(owners)).astype(np.int32)
        distinct, place, count = np.unique(fp, return_inverse=True, return_counts=True)
        owner_of = (distinct % np.uint64(owners)).astype(np.int32)
        order = np.lexsort((distinct, owner_of))
        starts = np.searchsorted(owner_of[order], np.arange(owners + 1))
        slot = np.empty(len(distinct), np.int32)
        slot[order] = np.arange(len(distinct)) - starts[owner_of[order]]
        rows["part"], rows["owner"], rows["slot"] = part, owner, slot[place]
        rows["again"] = (count > 1)[place]
        for name in ("n", "width", "unary", "rest"):
            rows[name] = None
        yield rows[[c.split()[0] for c in _SENT.split(", ")]]
        out = []
        for o in range(owners):
            mine = distinct[order[starts[o]:starts[o + 1]]] // np.uint64(owners)
            if len(mine):
                out.append((part, o, len(mine), *golomb.encode(mine, 65 - owners.bit_length())))
        sent = pd.DataFrame(out, columns=["part", "owner", "n", "width", "unary", "rest"])
        for name in ("doc_id", "text_sha256", "fp", "slot", "again"):
            sent[name] = None
        yield sent[[c.split()[0] for c in _SENT.split(", ")]]

    return send


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmap for every partition: which of its fingerprints another one has too."""
    sets = [golomb.decode(m.n, m.width, m.unary, m.rest) for m in messages.itertuples()]
    values, count = np.unique(np.concatenate(sets), return_counts=True)
    shared = values[count > 1]
    return pd.DataFrame({
        "part": messages.part, "owner": messages.owner,
        "bits": [np.packbits(np.isin(s, shared, assume_unique=True)).tobytes() for s in sets]})


def _marked(rows: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
    """The fingerprints of a partition that need a comparison of texts."""
    twice = rows.again.to_numpy(dtype=bool)
    bits = {m.owner: np.unpackbits(np.frombuffer(m.bits, np.uint8)) for m in bitmaps.itertuples()}
    for owner, index in rows.groupby("owner").indices.items():
        twice[index] |= bits[owner][rows.slot.to_numpy()[index]].astype(bool)
    return pd.DataFrame({"fp": rows.fp[twice].unique().astype(np.int64)})


def _bit(fp: Column) -> tuple[Column, Column]:
    """Bucket and place of a fingerprint's bit."""
    bit = F.pmod(fp, F.lit(BITS))
    return F.floor(bit / BITS_PER_BUCKET).cast("int"), bit % BITS_PER_BUCKET


def _suspected(texts: DataFrame, suspects: DataFrame) -> DataFrame:
    """The texts whose fingerprint's bit is set: all suspects, and hardly any other text
    as long as there are far fewer suspects than bits. Its size is bounded by BITS."""
    bucket, place = _bit(F.col("fp"))
    bitmaps = suspects.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bitmap"))
    byte = F.conv(F.hex(F.substr("bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return texts.withColumn("bucket", bucket).join(F.broadcast(bitmaps), "bucket").filter(
        byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) > 0).drop("bucket", "bitmap")


def exact_groups(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(whole_text()).alias("norm"))
    texts = texts.select("doc_id", "norm", F.xxhash64("norm").alias("fp"))
    owners = pieces_of(docs.count(), ROWS_PER_OWNER)
    prints = texts.select(named("doc_id"), F.sha2("norm", 256).alias("text_sha256"), "fp")
    sent = scratch.write(prints.mapInPandas(_send(owners), _SENT), "sent")
    answers = sent.filter("n IS NOT NULL").select("part", "owner", "n", "width", "unary", "rest").groupBy("owner").applyInPandas(
        _answer, "part int, owner int, bits binary")
    rows = sent.filter("n IS NULL").withColumn("doc_id", unnamed("doc_id"))
    marked = rows.select("part", "fp", "owner", "slot", "again").groupBy("part").cogroup(answers.groupBy("part")).applyInPandas(
        _marked, "fp long")
    suspects = scratch.write(marked.distinct(), "suspects")

    # A fingerprint may belong to a third of all rows: it is dealt to several tasks, and
    # each sends on one row per text.
    salt = F.pmod(F.hash("doc_id"), F.lit(SALTS)).alias("salt")
    wanted = suspects.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    whole = _suspected(texts, suspects).select("*", salt).join(wanted.hint("merge"), ["fp", "salt"], "left_semi")
    equal = (
        whole.groupBy("fp", "salt", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        .groupBy("fp", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    )
    # One class per text. Two different texts of one SHA-256 are not known to exist; the
    # job would stop rather than take them for copies.
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts of one SHA-256")).cast("long"))
    classes = scratch.write(
        equal.select(F.sha2("norm", 256).alias("text_sha256"), "keep_id", "n").groupBy("text_sha256").agg(
            F.coalesce(one, F.min("keep_id")).alias("keep_id"), F.sum("n").alias("group_size")).filter("group_size > 1"), "classes")
    scratch.drop("suspects")
    out = rows.select("doc_id", "text_sha256").join(classes, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")
