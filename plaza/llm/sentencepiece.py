"""N-best segmentation of texts into the pieces of a SentencePiece model, and back.

A segmentation is a path through the lattice of pieces; its score is the sum of its pieces'
scores. Forward Viterbi gives the best score up to each place. Searching backward from the
end by A*, with those forward scores as the (exact) estimate of what is still to come, meets
the segmentations in order of their scores.

No piece reaches over the start of a run of blanks or a line end, so the lattice of a text
is a chain of small ones. Equal units are worked out once per slice of texts: forward and
backward scores for all of them together, and the gap between the best and the second-best
path of each (the best path over an edge that the best path does not take). The N best paths
of a text differ from its best path only in the N - 1 units of the smallest gaps; only
those are searched by A*.

Contract
- Texts are segmented whole: a blank is put before, blanks become U+2581 (which therefore
  decodes to a blank). A character that is in no piece costs ten less than the least score and
  is written as the pieces of its UTF-8 bytes. Null counts as empty; an empty text is its one
  leading blank.
- Of paths of equal score the one with the longest last piece comes first, and so on back.
- Rows are taken one by one, repeated rows and null ids alike. An empty table gives no rows.
  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plaza.llm.common import batches_of, named, small_batches, unnamed, whole_text
from plaza.llm.shingles import mixed, powers

BLANK = "▁"
UNKNOWN_COST = 10.0
SLICE_CHARS = 3_000_000
LONG_UNIT = 48
UNITS_AT_ONCE = 50_000
_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 1 << 64)

ENCODED = "doc_id long, ids array<int>, best_score double, nbest_scores array<double>, nbest_ids array<array<int>>"


class _Path:
    """Pieces taken from the end of a unit: the last one's length, and the path before it.

    Of two paths the one with the longer piece where they first differ is less. Each keeps a
    second link further back, so that this place is found in steps of the logarithm of the length.
    """

    __slots__ = ("before", "far", "size", "length")

    def __init__(self, before: _Path | None, length: int):
        self.before, self.length = before, length
        if before is None:
            self.far, self.size = None, 0
        else:
            jump = before.far
            even = jump is not None and jump.far is not None and before.size - jump.size == jump.size - jump.far.size
            self.far, self.size = jump.far if even else before, before.size + 1

    def _cut(self, size: int) -> _Path:
        path = self
        while path.size > size:
            path = path.far if path.far.size >= size else path.before
        return path

    def __lt__(self, other: _Path) -> bool:
        a, b = self._cut(other.size), other._cut(self.size)
        if a is b:
            return self.size < other.size
        while a.before is not b.before:
            a, b = (a.far, b.far) if a.far is not b.far else (a.before, b.before)
        return a.length > b.length

    def lengths(self) -> list[int]:
        """From the start of the unit on."""
        out, path = [], self
        while path.before is not None:
            out.append(path.length)
            path = path.before
        return out


class Pieces:
    """The normal pieces of a model file with their scores, and its byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.ids = {self.text[i]: i for i in range(n) if not special(i)}
        self.score = np.array([model.get_score(i) for i in range(n)])
        self.byte = {int(self.text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.byte) < 256:
            raise ValueError("the model has no pieces for single bytes")
        self.longest = max(map(len, self.ids))
        self.unknown = min(self.score[i] for i in self.ids.values()) - UNKNOWN_COST
        self.cuts_lines = not any("\n" in p for p in self.ids if len(p) > 1)
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece reaches over a blank; texts cannot be cut there")
        values = [b"" for _ in range(n)]
        for p, i in self.ids.items():
            values[i] = p.replace(BLANK, " ").encode()
        for b, i in self.byte.items():
            values[i] = bytes([b])
        self.sizes = np.array([len(v) for v in values], dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])
        self.pool = np.frombuffer(b"".join(values), dtype=np.uint8)
        names = list(self.ids)
        hashes = np.array([int(self._hashes(np.array([[ord(c) for c in p]], dtype=np.uint64), 0, len(p))[0]) for p in names], dtype=np.uint64)
        order = np.argsort(hashes)
        self.keys, self.key_ids = hashes[order], np.array([self.ids[p] for p in names], dtype=np.int32)[order]
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces of one hash")
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.keys >> np.uint64(44)] = True

    @staticmethod
    def sums(points: np.ndarray) -> np.ndarray:
        out = np.zeros((points.shape[0], points.shape[1] + 1), dtype=np.uint64)
        np.cumsum(mixed(points + np.uint64(1)) * powers(_BASE, points.shape[1]), axis=1, out=out[:, 1:])
        return out

    def _hashes(self, points: np.ndarray, lo: int, hi: int) -> np.ndarray:
        return self.between(self.sums(points), lo, hi)

    @staticmethod
    def between(sums: np.ndarray, lo: int, hi: int) -> np.ndarray:
        return mixed((sums[:, hi] - sums[:, lo]) * powers(_BACK, lo + 1)[lo])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of pieces by hash, -1 where there is none."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        some = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.keys, hashes[some]), len(self.keys) - 1)
        out[some] = np.where(self.keys[at] == hashes[some], self.key_ids[at], -1)
        return out

    def edges(self, unit: str, end: int) -> Iterator[tuple[int, int, float]]:
        """Length, id (-1: unknown character) and score of the pieces that end at a place."""
        for k in range(1, min(self.longest, end) + 1):
            i = self.ids.get(unit[end - k:end], -1)
            if i >= 0:
                yield k, i, float(self.score[i])
            elif k == 1:
                yield 1, -1, self.unknown

    def written(self, unit: str, lengths: list[int]) -> list[int]:
        """Ids of a segmentation, given by the lengths of its pieces."""
        out, at = [], 0
        for k in lengths:
            i = self.ids.get(unit[at:at + k])
            out += [i] if i is not None else [self.byte[b] for b in unit[at:at + k].encode("utf-8", "surrogatepass")]
            at += k
        return out

    def n_best(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a unit: score and lengths of the pieces."""
        forward = [0.0]
        for end in range(1, len(unit) + 1):
            forward.append(max(forward[end - k] + s for k, _, s in self.edges(unit, end)))
        # What is done from the end, and the most that can still come before it.
        heap: list[tuple] = [(-forward[-1], _Path(None, 0), len(unit), 0.0)]
        out = []
        while heap and len(out) < n:
            _, taken, at, done = heapq.heappop(heap)
            if not at:
                out.append((done, taken.lengths()))
                continue
            for k, _, s in self.edges(unit, at):
                heapq.heappush(heap, (-(done + s + forward[at - k]), _Path(taken, k), at - k, done + s))
        return out

    def viterbi(self, units: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Ids of the best segmentation of each unit, its score, and its gap to the second best."""
        ids: list = [None] * len(units)
        best, gap = np.zeros(len(units)), np.full(len(units), np.inf)
        by_length: dict[int, list[int]] = {}
        for i, u in enumerate(units):
            by_length.setdefault(len(u), []).append(i)
        for length, members in by_length.items():
            if length == 0:
                for i in members:
                    ids[i] = np.zeros(0, dtype=np.int32)
            elif length > LONG_UNIT:
                for i in members:
                    two = self.n_best(units[i], 2)
                    ids[i] = np.array(self.written(units[i], two[0][1]), dtype=np.int32)
                    best[i] = two[0][0]
                    gap[i] = two[0][0] - two[1][0] if len(two) > 1 else np.inf
            else:
                step = max(1, UNITS_AT_ONCE * 8 // length)
                for at in range(0, len(members), step):
                    own = members[at:at + step]
                    found, best[own], gap[own] = self._same_length([units[i] for i in own], length)
                    for i, f in zip(own, found):
                        ids[i] = f
        return ids, best, gap

    def _same_length(self, units: list[str], length: int):
        n = len(units)
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(n, length).astype(np.uint64)
        sums = self.sums(points)
        piece = {}
        score = {}
        for end in range(1, length + 1):
            for k in range(1, min(self.longest, end) + 1):
                found = self.find(self.between(sums, end - k, end))
                s = np.where(found >= 0, self.score[found], self.unknown if k == 1 else -np.inf)
                piece[end, k], score[end, k] = found, s
        forward, backward = np.full((length + 1, n), -np.inf), np.full((length + 1, n), -np.inf)
        taken = np.zeros((length + 1, n), dtype=np.int64)
        forward[0] = backward[length] = 0
        for end in range(1, length + 1):
            for k in range(1, min(self.longest, end) + 1):
                through = forward[end - k] + score[end, k]
                better = through >= forward[end]
                forward[end] = np.where(better, through, forward[end])
                taken[end] = np.where(better & (through > -np.inf), k, taken[end])
        for end in range(length, 0, -1):
            for k in range(1, min(self.longest, end) + 1):
                backward[end - k] = np.maximum(backward[end - k], backward[end] + score[end, k])
        # Walk back all best paths together.
        at, rows = np.full(n, length), np.arange(n)
        on_path = np.zeros((length + 1, n), dtype=np.int64)
        steps = []
        while len(rows):
            k = taken[at[rows], rows]
            on_path[at[rows], rows] = k
            steps.append((rows, at[rows], k))
            at[rows] -= k
            rows = rows[at[rows] > 0]
        second = np.full(n, -np.inf)
        for (end, k), s in score.items():
            second = np.maximum(second, np.where(on_path[end] == k, -np.inf, forward[end - k] + s + backward[end]))
        unit, end, k = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((end, unit))
        unit, end, k = unit[order], end[order], k[order]
        chosen = np.full(len(unit), -1, dtype=np.int32)
        for pair in set(zip(end.tolist(), k.tolist())):
            here = (end == pair[0]) & (k == pair[1])
            chosen[here] = piece[pair][unit[here]]
        cuts = np.searchsorted(unit, np.arange(n + 1))
        ids = [chosen[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for i in np.unique(unit[chosen < 0]):
            ids[i] = np.array(self.written(units[i], k[cuts[i]:cuts[i + 1]].tolist()), dtype=np.int32)
        return ids, forward[length], forward[length] - second

    def units(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, list[str]]:
        """Units of all texts as codes, where each text begins, and the distinct units."""
        joined = set("".join(texts))
        mark = next(chr(c) for c in range(0xF0000, 0x10FFFE) if chr(c) not in joined)
        cut = []
        for t in texts:
            t = BLANK + t.replace(" ", BLANK)
            t = re.sub(f"(?<!{BLANK}){BLANK}", mark + BLANK, t) if BLANK * 2 in t else t.replace(BLANK, mark + BLANK)
            cut.append(t.replace("\n", f"{mark}\n{mark}") if self.cuts_lines else t)
        lists = pc.split_pattern(pa.array([c.encode("utf-8", "surrogatepass") for c in cut], pa.large_binary()), mark.encode())
        words = lists.values.dictionary_encode()
        return words.indices.to_numpy(), lists.offsets.to_numpy(), [b.decode("utf-8", "surrogatepass") for b in words.dictionary.to_pylist()]

    def encode(self, texts: list[str], n: int) -> Iterator[tuple[np.ndarray, float, list[float], list[list[int]]]]:
        """For each text: ids and score of the best segmentation; scores of the n best; and, per
        further one, its ids."""
        codes, at, units = self.units(texts)
        ids, best, gap = self.viterbi(units)
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        base = np.concatenate([[0], np.cumsum(sizes)])
        pool = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        known: dict[str, list] = {}
        for lo, hi in zip(at[:-1], at[1:]):
            own = codes[lo:hi]
            of = sizes[own]
            ends = np.cumsum(of)
            flat = pool[np.repeat(base[own] - (ends - of), of) + np.arange(ends[-1])]
            total = float(best[own].sum())
            near = np.lexsort((np.arange(len(own)), gap[own]))[:n - 1] if len(own) < n else _least(gap[own], n - 1)
            lists = []
            for j in near:
                u = units[own[j]]
                if u not in known:
                    known[u] = self.n_best(u, n)
                lists.append([(p[0] - best[own[j]], int(j), p[1]) for p in known[u]])
            ranked = sorted(itertools.product(*lists), key=lambda c: -sum(p[0] for p in c))[:n] if lists else [()]
            yield flat, total, [total + sum(p[0] for p in c) for c in ranked], [self._with(flat, ends, of, own, units, c) for c in ranked[1:]]

    def _with(self, flat, ends, of, own, units, changes) -> list[int]:
        out = flat.tolist()
        for _, j, lengths in sorted(changes, key=lambda c: -c[1]):
            out[ends[j] - of[j]:ends[j]] = self.written(units[own[j]], lengths)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a segmentation, in UTF-8, without the leading blank."""
        size = self.sizes[ids]
        ends = np.cumsum(size)
        raw = self.pool[np.repeat(self.begins[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        return raw[1:] if raw[:1] == b" " else raw


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Places of the n least values, earlier places first among equal ones."""
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    limit = np.partition(values, n - 1)[n - 1]
    some = np.flatnonzero(values <= limit)
    return some[np.lexsort((some, values[some]))][:n]


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(docs: DataFrame, path: str, n: int) -> DataFrame:
    """Ids and score of the best segmentation of every text, and the n best scores and segmentations."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = pieces(path)
        for frame in batches_of(frames, "text", SLICE_CHARS):
            out = [(doc, ids, total, scores, [ids.tolist(), *more]) for doc, (ids, total, scores, more) in
                   zip(frame.doc_id.tolist(), own.encode(frame.text.tolist(), n))]
            yield pd.DataFrame(out, columns=["doc_id", "ids", "best_score", "nbest_scores", "nbest_ids"])

    return _texts(docs).mapInPandas(run, ENCODED).withColumn("doc_id", unnamed("doc_id"))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, ids``. Bytes that are no UTF-8 become U+FFFD."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = pieces(path)
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame.doc_id, "text": [
                own.decode(np.asarray(i, dtype=np.int64)).decode("utf-8", "replace") for i in frame.ids]})

    return rows.select(named("doc_id"), "ids").mapInPandas(run, "doc_id long, text string").withColumn("doc_id", unnamed("doc_id"))


def digest(docs: DataFrame, path: str, n: int) -> DataFrame:
    """Pieces, checksum and scores of every text, and whether decoding gives the text again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = pieces(path)
        for frame in batches_of(frames, "text", SLICE_CHARS):
            out = []
            texts = frame.text.tolist()
            for doc, text, (ids, total, scores, _) in zip(frame.doc_id.tolist(), texts, own.encode(texts, n)):
                back = own.decode(ids) == text.replace(BLANK, " ").encode("utf-8", "surrogatepass")
                out.append((doc, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, scores, back))
            yield pd.DataFrame(out, columns=["doc_id", "n_pieces", "ids_crc32", "best_score", "nbest_scores", "round_trip"])

    made = _texts(docs).mapInPandas(
        run, "doc_id long, n_pieces long, ids_crc32 long, best_score double, nbest_scores array<double>, round_trip boolean")
    return made.withColumn("doc_id", unnamed("doc_id"))


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(named("doc_id"), whole_text().alias("text"))
