"""Removal of passages that an earlier document has, by the common-prefix interval tree of a suffix array.

A suffix array over a whole corpus fits no task. Instead:

1. Documents are written in slabs of a few megabytes. In a slab, anchors are chosen: the
   places whose 20-byte hash is the least of some window. Every 50-byte string holds an anchor at
   the same place wherever it stands, so equal strings meet at equal anchors.
2. The sorted anchors of a slab go to the owners of their hashes, Golomb-coded; an owner
   answers with a bitmap of those that another slab has too.
3. Shared anchors go to their owners with up to 30 bytes before and 50 from the anchor on, once per
   slab (under its smallest document; others of the slab that read the same there are settled
   on the spot). The owner sorts them by what follows (a suffix array of the anchors), works out
   common prefixes of neighbours, and finds the tree of common-prefix intervals by a stack scan.
   Each interval holds all occurrences of a string; classes of equal text before the anchor split
   it (an interval whose occurrences differ there is left-diverse, and its string maximal in that
   direction). Occurrences in a class with a smaller document are repeats. All of a node's
   occurrences are seen, not only neighbours.
4. The bytes to remove around each anchor go back to the slabs.

Whole copies of an earlier document take no part in step 3: all their strings stand in it.

Contract
- Texts are UTF-8 bytes; null counts as empty. A byte goes if a LENGTH-byte string of its document
  that covers it also starts in a document of smaller ``doc_id``; strings never cross documents and are
  judged on the input. Rows of the same ``doc_id`` are not smaller than each other. A null id
  counts as larger than all others.
- Texts shorter than LENGTH lose nothing. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plaza.llm import golomb
from plaza.llm.common import Scratch, batches_of, pieces_of, squeezed, unsqueezed, whole_text
from plaza.llm.shingles import mixed

LENGTH, KEY = 50, 20
REACH = LENGTH - KEY            # bytes before an anchor that a string may hold
WIDTH = REACH + LENGTH          # bytes of a context
SLAB_BYTES = 2_000_000
BYTES_PER_OWNER = 8_000_000
FP_BITS = 48
LAST_ID = (1 << 63) - 1

_SLAB = "slab long, doc_ids array<long>, ends array<long>, prints array<binary>, body binary"


def _slabs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, n = TaskContext.get().partitionId(), 0
    for frame in batches_of(frames, "text", SLAB_BYTES):
        raw = [t.encode("utf-8", "surrogatepass") for t in frame.text]
        ids = frame.doc_id.to_numpy()
        yield pd.DataFrame([((part << 32) + n, ids, np.cumsum([len(r) for r in raw]), [hashlib.sha256(r).digest() for r in raw], squeezed(b"".join(raw)))],
                           columns=["slab", "doc_ids", "ends", "prints", "body"])
        n += 1


def anchors(body: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and 48-bit hashes of the anchors of a slab."""
    n = len(body) - KEY + 1
    if len(body) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = lambda at: np.ndarray((n,), dtype="<u8", buffer=body.data, offset=at, strides=(1,))
    h = mixed(mixed(mixed(word(0).astype(np.uint64)) + word(8)) + word(KEY - 8)) >> np.uint64(64 - FP_BITS)
    h += np.uint64(1)
    # No string starts where too few bytes of the document are left.
    starts = np.concatenate([[0], ends[:-1]])
    valid = np.zeros(len(body) + 1, dtype=np.int32)
    long = ends - starts >= LENGTH
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - LENGTH + 1, -1)
    valid = np.cumsum(valid[:n]) > 0
    least = _sliding(h, REACH + 1, np.minimum)
    whole = np.zeros(n, dtype=np.uint64)
    whole[:len(least)] = np.where(valid[:len(least)], least, 0)
    # The greatest of the window minima around a place: the place is an anchor if it equals it.
    padded = np.concatenate([np.zeros(REACH, dtype=np.uint64), whole])
    place = np.flatnonzero(h == _sliding(padded, REACH + 1, np.maximum))
    return place, h[place]


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each window of ``width`` places, by doubling."""
    have = 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def _by_owner(hashes: np.ndarray, owners: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sorted distinct hashes of each owner."""
    distinct = np.unique(hashes)
    owner = (distinct % np.uint64(owners)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(owners + 1))
    for o in range(owners):
        if cuts[o + 1] > cuts[o]:
            yield o, distinct[order[cuts[o]:cuts[o + 1]]]


def _send(owners: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                _, hashes = anchors(np.frombuffer(unsqueezed(row.body), np.uint8), np.asarray(row.ends, dtype=np.int64))
                out = [(row.slab, o, len(own), *golomb.encode(own // np.uint64(owners), FP_BITS + 2 - owners.bit_length()))
                       for o, own in _by_owner(hashes, owners)]
                if out:
                    yield pd.DataFrame(out, columns=["slab", "owner", "n", "width", "unary", "rest"])

    return run


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """Which hashes of each slab another slab has too."""
    sets = [golomb.decode(m.n, m.width, m.unary, m.rest) for m in messages.itertuples()]
    values, count = np.unique(np.concatenate(sets), return_counts=True)
    shared = values[count > 1]
    bits = [np.isin(s, shared, assume_unique=True) for s in sets]
    some = [b.any() for b in bits]
    return pd.DataFrame({"slab": messages.slab, "owner": messages.owner, "bits": [np.packbits(b).tobytes() for b in bits]})[some]


class Contexts:
    """The shared anchors of a slab and their surroundings; the same each time it is made."""

    def __init__(self, body: bytes, doc_ids, ends, bits: dict[int, bytes], copies: set[int], owners: int):
        self.body = np.frombuffer(unsqueezed(body), np.uint8)
        self.doc_ids, self.ends = np.asarray(doc_ids, dtype=np.int64), np.asarray(ends, dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]])
        place, hashes = anchors(self.body, self.ends)
        doc = np.searchsorted(self.ends, place, side="right")
        if copies:
            own = ~np.isin(doc, np.fromiter(copies, dtype=np.int64))
            place, hashes_here, doc = place[own], hashes[own], doc[own]
        else:
            hashes_here = hashes
        shared = [own[np.unpackbits(np.frombuffer(bits[o], np.uint8))[:len(own)].astype(bool)]
                  for o, own in _by_owner(hashes, owners) if o in bits]
        wanted = np.concatenate(shared) if shared else np.zeros(0, np.uint64)
        keep = np.isin(hashes_here, wanted) | _in_two(hashes_here, self.doc_ids[doc])
        self.place, self.doc = place[keep], doc[keep]
        self.owner = (hashes_here[keep] % np.uint64(owners)).astype(np.int64)
        self.left = np.minimum(REACH, self.place - self.starts[self.doc])
        self.right = np.minimum(LENGTH, self.ends[self.doc] - self.place)
        key = self._keys()
        self.unique, self.group = np.unique(key, return_inverse=True)
        self.least = np.full(len(self.unique), LAST_ID)
        np.minimum.at(self.least, self.group, self.doc_ids[self.doc])
        self.owner_of = np.zeros(len(self.unique), dtype=np.int64)
        self.owner_of[self.group] = self.owner

    def _keys(self) -> np.ndarray:
        """What follows, its length, what stands before in reverse, its length: one sortable row each."""
        padded = np.concatenate([np.zeros(REACH, np.uint8), self.body, np.zeros(LENGTH, np.uint8)])
        rows = np.empty((len(self.place), WIDTH + 2), dtype=np.uint8)
        after, before = np.arange(LENGTH), np.arange(1, REACH + 1)
        rows[:, :LENGTH] = np.where(after < self.right[:, None], padded[REACH + self.place[:, None] + after], 0)
        rows[:, LENGTH] = self.right
        rows[:, LENGTH + 1:-1] = np.where(before <= self.left[:, None], padded[REACH + self.place[:, None] - before], 0)
        rows[:, -1] = self.left
        return rows.view(f"V{WIDTH + 2}").ravel()


def _in_two(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a hash stands in two documents of the slab."""
    _, place = np.unique(hashes, return_inverse=True)
    if not len(place):
        return np.zeros(0, dtype=bool)
    low, high = np.full(place.max() + 1, LAST_ID), np.full(place.max() + 1, -LAST_ID)
    np.minimum.at(low, place, doc)
    np.maximum.at(high, place, doc)
    return (low < high)[place]


def _parts(row) -> tuple[dict[int, bytes], set[int]]:
    bits = {int(b["owner"]): b["bits"] for b in row.bits} if row.bits is not None else {}
    return bits, {int(c) for c in row.copies} if row.copies is not None else set()


def _contexts(owners: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                c = Contexts(row.body, row.doc_ids, row.ends, *_parts(row), owners)
                order = np.argsort(c.owner_of, kind="stable")
                cuts = np.searchsorted(c.owner_of[order], np.arange(owners + 1))
                out = []
                for o in range(owners):
                    own = order[cuts[o]:cuts[o + 1]]
                    if len(own):
                        out.append((o, row.slab, len(own), squeezed(c.unique[own].tobytes()), c.least[own].tobytes(), own.astype("<u4").tobytes()))
                if out:
                    yield pd.DataFrame(out, columns=["owner", "slab", "n", "keys", "docs", "ids"])

    return run


def lcp_intervals(lcp: list[int], least: int) -> np.ndarray:
    """All intervals of a suffix array whose members share a prefix of ``least`` or more.

    ``lcp[i]`` belongs to places i - 1 and i. A stack holds the open intervals from short to
    long prefixes; one closes where a shorter common prefix comes. Rows: length of the
    prefix, that of the interval around it (or ``least - 1``), first place, last place.
    """
    out, stack = [], [(least - 1, 0)]
    for i, depth in enumerate([*lcp[1:], least - 1], start=1):
        depth, first = max(depth, least - 1), i - 1
        while depth < stack[-1][0]:
            closed, first = stack.pop()
            out.append((closed, max(depth, stack[-1][0]), first, i - 1))
        if depth > stack[-1][0]:
            stack.append((depth, first))
    return np.array(out, dtype=np.int64).reshape(-1, 4)


def common(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rows of two byte tables."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, limit)


def repeats_around(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For contexts (sorted distinct rows of ``Contexts._keys``) with their smallest document: how
    many bytes before and from the anchor on stand in a smaller document too."""
    n = len(keys)
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    after, r = keys[:, :LENGTH], keys[:, LENGTH].astype(np.int64)
    before, l = keys[:, LENGTH + 1:-1], keys[:, -1].astype(np.int64)
    lcp = np.zeros(n, np.int64)
    lcp[1:] = common(after[1:], after[:-1], np.minimum(r[1:], r[:-1]))
    nodes = lcp_intervals(lcp.tolist(), KEY)
    if not len(nodes):
        return left, right
    # Rank by what stands before the anchor; neighbours there share left_lcp bytes.
    order = np.argsort(np.ascontiguousarray(keys[:, LENGTH + 1:]).view(f"V{REACH + 1}").ravel(), kind="stable")
    left_lcp = np.zeros(n, np.int64)
    left_lcp[1:] = common(before[order[1:]], before[order[:-1]], np.minimum(l[order[1:]], l[order[:-1]]))
    cls = np.empty(n, np.int64)
    for d in range(REACH + 1):
        e = LENGTH - d
        live = nodes[(nodes[:, 0] >= e) & (nodes[:, 1] < e)]
        if not len(live):
            continue
        size = live[:, 3] - live[:, 2] + 1
        node = np.repeat(np.arange(len(live)), size)
        member = np.repeat(live[:, 2] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        whole = (l[member] >= d) & (r[member] >= e)
        node, member = node[whole], member[whole]
        cls[order] = np.cumsum(left_lcp < d)
        _, group = np.unique(node * (n + 1) + cls[member], return_inverse=True)
        if not len(group):
            continue
        least = np.full(group.max() + 1, LAST_ID)
        np.minimum.at(least, group, docs[member])
        hit = member[least[group] < docs[member]]
        left[hit], right[hit] = np.maximum(left[hit], d), np.maximum(right[hit], e)
    return left, right


def _owner(rows: pd.DataFrame) -> pd.DataFrame:
    keys = np.frombuffer(b"".join(map(unsqueezed, rows["keys"])), dtype=f"V{WIDTH + 2}")
    docs = np.frombuffer(b"".join(rows.docs), dtype="<i8")
    ids = np.frombuffer(b"".join(rows.ids), dtype="<u4")
    slab = np.repeat(rows.slab.to_numpy(), rows.n.to_numpy())
    unique, group = np.unique(keys, return_inverse=True)
    least = np.full(len(unique), LAST_ID)
    np.minimum.at(least, group, docs)
    table = unique.view(np.uint8).reshape(len(unique), WIDTH + 2)
    left, right = repeats_around(table, least)
    # The same context in a smaller document: every string in it is a repeat.
    first = least[group] == docs
    full_left, full_right = table[group, -1].astype(np.int64), table[group, LENGTH].astype(np.int64)
    fits = full_left + full_right >= LENGTH
    left = np.where(first, left[group], np.where(fits, full_left, 0))
    right = np.where(first, right[group], np.where(fits, full_right, 0))
    some = right > 0
    slab, ids, left, right = slab[some], ids[some], left[some], right[some]
    order = np.argsort(slab, kind="stable")
    out = []
    for index in np.split(order, np.flatnonzero(np.diff(slab[order])) + 1):
        if len(index):
            out.append((slab[index[0]], ids[index].tobytes(), left[index].astype(np.uint8).tobytes(), right[index].astype(np.uint8).tobytes()))
    return pd.DataFrame(out, columns=["slab", "ids", "before", "after"])


def _removed(owners: int, keep_text: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                bits, copies = _parts(row)
                c = Contexts(row.body, row.doc_ids, row.ends, bits, copies, owners)
                before, after = np.zeros(len(c.unique), np.int64), np.zeros(len(c.unique), np.int64)
                for found in row.found if row.found is not None else []:
                    ids = np.frombuffer(found["ids"], "<u4")
                    before[ids] = np.frombuffer(found["before"], np.uint8)
                    after[ids] = np.frombuffer(found["after"], np.uint8)
                before, after = before[c.group], after[c.group]
                later = c.doc_ids[c.doc] > c.least[c.group]
                fits = later & (c.left + c.right >= LENGTH)
                before, after = np.where(later, np.where(fits, c.left, 0), before), np.where(later, np.where(fits, c.right, 0), after)
                edge = np.zeros(len(c.body) + 1, dtype=np.int64)
                np.add.at(edge, c.place - before, 1)
                np.add.at(edge, c.place + after, -1)
                gone = np.cumsum(edge[:-1]) > 0
                for k in copies:
                    if c.ends[k] - c.starts[k] >= LENGTH:
                        gone[c.starts[k]:c.ends[k]] = True
                out = []
                for k, (lo, hi) in enumerate(zip(c.starts, c.ends)):
                    mask = gone[lo:hi]
                    kept = c.body[lo:hi][~mask].tobytes()
                    spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                    out.append((c.doc_ids[k], hi - lo, int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def without_repeats(docs: DataFrame, scratch: Scratch, keep_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), whole_text().alias("text"))
    slabs = scratch.write(texts.mapInPandas(_slabs, _SLAB), "slabs")
    total = slabs.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    owners = pieces_of(total, BYTES_PER_OWNER)

    sent = slabs.select("slab", "ends", "body").mapInPandas(_send(owners), "slab long, owner int, n int, width int, unary binary, rest binary")
    bits = scratch.write(sent.groupBy("owner").applyInPandas(_answer, "slab long, owner int, bits binary"), "bits")
    scratch.free()

    # Whole copies, by their digest: under a smaller document than their own.
    placed = slabs.select("slab", F.posexplode(F.arrays_zip("doc_ids", "prints")).alias("at", "d")).select(
        "slab", "at", F.col("d.doc_ids").alias("doc_id"), F.col("d.prints").alias("print"))
    firsts = placed.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = placed.join(firsts, "print").filter("doc_id > first").groupBy("slab").agg(F.collect_list("at").alias("copies"))
    marks = scratch.write(
        bits.groupBy("slab").agg(F.collect_list(F.struct("owner", "bits")).alias("bits")).join(copies, "slab", "full"), "marks")

    scratch.drop("bits")
    marked = slabs.drop("prints").join(marks.hint("merge"), "slab", "left")
    contexts = marked.mapInPandas(_contexts(owners), "owner int, slab long, n long, keys binary, docs binary, ids binary")
    found = scratch.write(contexts.groupBy("owner").applyInPandas(_owner, "slab long, ids binary, before binary, after binary"), "found")
    scratch.free()

    answers = found.groupBy("slab").agg(F.collect_list(F.struct("ids", "before", "after")).alias("found"))
    both = marks.join(answers, "slab", "left")
    out = slabs.drop("prints").join(both.hint("merge"), "slab", "left").mapInPandas(
        _removed(owners, keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")))
