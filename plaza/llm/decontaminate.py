"""Benchmark decontamination by a generalised suffix automaton.

The words of the benchmark's items make one suffix automaton. Documents stream through it word
by word; the automaton keeps the longest run of words that ends here and stands in some item. Where
that run is at least ``window`` words long (the length limit), or holds a whole shorter item (the
coverage limit), the words of the window are hit. Words that no item has lead to the root, so only
runs of known words are walked, and only those that could hold a window.

Size: a part of the benchmark of at most some ``WORDS_PER_PART`` words is broadcast at a time (items longer
than ``PIECE_WORDS`` are cut into pieces that share ``window`` - 1 words, so that no window is lost);
how many words a part holds is counted before it is collected. A benchmark of several parts takes one pass
over the documents for each, and spans are put together by document afterwards.

Contract
- Words: ``A-Z`` lower-cased, then maximal runs of characters outside ASCII, digits and letters. A
  null or empty text has no words. A window is ``window`` consecutive words of an item, or all words of a shorter one.
- Every row gives a row. Rows that repeat a ``doc_id``, or have none, are judged one by one. An item without id hits words,
  but is neither named nor counted; items of one id count once. Without items, or with empty ones, nothing is hit.
- A very long text is walked in slices of ``SLICE`` bytes, and the automaton's state goes on from one to the next: the result
  is that of the whole text. Only ``doc_id`` and ``text`` of documents and ``item_id`` and ``text`` of items are read by ``hits``; ``cleaned`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plaza.llm.common import NO_ID, Scratch, named, pieces_of, unnamed, whole_text

WORDS_PER_PART, PIECE_WORDS = 1 << 18, 4096
SLICE = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before lower-casing
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

_HITS = "row long, doc_id long, n_words long, longest int, spans array<array<long>>, items array<long>"
_DIGEST = "row long, doc_id long, n_words long, n_hit long, longest int, spans array<array<long>>, n_items long, items_sha256 string"


class SuffixAutomaton:
    """All runs of words of the items, with the windows that count."""

    def __init__(self, items: list[tuple[int, list[bytes], bool]], window: int):
        """``items``: id, words, and whether these words are a piece of a longer item."""
        self.window, self.vocabulary = window, {}
        self.steps, self.link, self.length = [{}], [-1], [0]
        coded = []
        for name, words, piece in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if codes:
                coded.append((name, codes, piece))
                last = 0
                for code in codes:
                    last = self._extended(last, code)
        self.size = max(1, len(self.vocabulary))
        self.step = {state * self.size + code: to for state, row in enumerate(self.steps) for code, to in row.items()}
        del self.steps
        self._name_windows(coded)

    def _extended(self, last: int, code: int) -> int:
        """The state of an item's words read so far and one more."""
        steps, link, length = self.steps, self.link, self.length
        known = steps[last].get(code)
        if known is not None and length[known] == length[last] + 1:
            return known
        fresh = None
        if known is None:
            fresh = len(steps)
            steps.append({})
            link.append(0)
            length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in steps[at]:
            steps[at][code] = fresh
            at = link[at]
        if at < 0:
            return fresh
        to = steps[at][code]
        if length[to] != length[at] + 1:
            copy = len(steps)
            steps.append(dict(steps[to]))
            link.append(link[to])
            length.append(length[at] + 1)
            while at >= 0 and steps[at].get(code) == to:
                steps[at][code] = copy
                at = link[at]
            link[to] = copy
            to = copy
        if fresh is None:
            return to
        link[fresh] = to
        return fresh

    def _name_windows(self, coded: list[tuple[int, list[int], bool]]) -> None:
        """The state of each window with the items that have it."""
        window, link, length = self.window, self.link, self.length
        found: dict[int, set[int]] = {}
        short: set[int] = set()
        for name, codes, piece in coded:
            state = 0
            for n, code in enumerate(codes, 1):
                state = self.step[state * self.size + code]  # a state of an item's first n words is at least n long
                if n >= window:
                    found.setdefault(self._window_of(state), set()).add(name)
            if len(codes) < window and not piece:
                found.setdefault(state, set()).add(name)
                short.add(state)
        self.items = {state: sorted(names - {NO_ID}) for state, names in found.items()}
        # The nearest state at or above each whose words are a whole short item.
        self.short = [-1] * len(link)
        for state in sorted(range(1, len(link)), key=length.__getitem__):
            self.short[state] = state if state in short else self.short[link[state]]
        self.least = min([window if not short else min(length[s] for s in short), window])

    def _window_of(self, state: int) -> int:
        """The state of the last ``window`` words of a run of at least as many."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state


class Reader:
    """Streams one document through the automaton."""

    def __init__(self, automaton: SuffixAutomaton):
        self.automaton, self.state, self.match, self.longest = automaton, 0, 0, 0
        self.words, self.spans, self.found = 0, [], set()

    def read(self, text: bytes) -> Reader:
        text, at = text.translate(_BYTES), 0
        while at < len(text):
            end = text.find(b" ", at + SLICE)
            end = len(text) if end < 0 else end
            self._take(text[at:end].split())
            at = end
        return self

    def _take(self, words: list[bytes]) -> None:
        a, n = self.automaton, len(words)
        codes = np.fromiter(map(a.vocabulary.get, words, repeat(-1)), np.int64, n)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], codes >= 0, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        # A run at the edge of a slice may go on beyond it.
        use = (ends - starts >= a.least) | (starts == 0) | (ends == n)
        for lo, hi in zip(starts[use].tolist(), ends[use].tolist()):
            if lo:
                self.state = self.match = 0
            self._walk(codes[lo:hi].tolist(), self.words + lo)
        if n and codes[-1] < 0:
            self.state = self.match = 0
        self.words += n

    def _walk(self, codes: list[int], place: int) -> None:
        a = self.automaton
        step, size, link, length, short, window = a.step.get, a.size, a.link, a.length, a.short, a.window
        state, match, longest = self.state, self.match, self.longest
        for place, code in enumerate(codes, place + 1):
            to = step(state * size + code)
            while to is None and state:
                state = link[state]
                match = length[state]
                to = step(state * size + code)
            if to is None:
                match = 0
                continue
            state, match = to, match + 1
            if match > longest:
                longest = match
            if match >= window:
                self._hit(a._window_of(state), place, window)
            whole = short[state if match == length[state] else link[state]]
            while whole > 0:
                self._hit(whole, place, length[whole])
                whole = short[link[whole]]
        self.state, self.match, self.longest = state, match, longest

    def _hit(self, window: int, end: int, size: int) -> None:
        self.found.add(window)
        start, spans = end - size, self.spans
        while spans and start <= spans[-1][1]:
            start, end = min(start, spans[-1][0]), max(end, spans[-1][1])
            spans.pop()
        spans.append([start, end])

    def names(self) -> list[int]:
        return sorted({name for state in self.found for name in self.automaton.items[state]})


def _item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """``item_id, piece, words`` of at most PIECE_WORDS words; ``piece`` says that the item has more words."""
    text = F.translate(whole_text(), UPPER, LOWER)
    words = F.filter(F.split(text, GAP, -1), lambda w: w != "")
    rows = benchmark.select(named("item_id"), words.alias("words")).filter("size(words) > 0").distinct()
    stride = PIECE_WORDS - window + 1
    starts = F.when(F.size("words") <= PIECE_WORDS, F.array(F.lit(1))).otherwise(
        F.sequence(F.lit(1), F.size("words") - window + 1, F.lit(stride)))
    return rows.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", (F.size("words") > PIECE_WORDS).alias("piece"), "start", F.slice("words", F.col("start"), F.lit(PIECE_WORDS)).alias("words"))


def _parts(pieces: DataFrame) -> tuple[DataFrame, int]:
    """Pieces dealt into parts, none of which has more than twice WORDS_PER_PART words."""
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    n = pieces_of(total, WORDS_PER_PART, 1)
    while True:
        dealt = pieces.withColumn("part", F.pmod(F.xxhash64("item_id", "start", "words"), F.lit(n)).cast("int"))
        most = dealt.groupBy("part").agg(F.sum(F.size("words")).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= max(2 * WORDS_PER_PART, PIECE_WORDS):
            return dealt, n
        n *= 2


def _scan(automaton):
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = automaton.value
        for frame in frames:
            out = []
            for row, doc, text in zip(frame.row.tolist(), frame.doc_id.tolist(), frame.text):
                r = Reader(held).read(bytes(text))
                out.append((row, doc, r.words, r.longest, r.spans, r.names()))
            yield pd.DataFrame(out, columns=["row", "doc_id", "n_words", "longest", "spans", "items"])

    return scan


def _united(spans: list[list[list[int]]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted([int(s), int(e)] for part in spans for s, e in part):
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return out


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The parts of each document put together."""
    for frame in frames:
        out = []
        for row, doc, words, longest, spans, items in zip(
                frame.row.tolist(), frame.doc_id.tolist(), frame.n_words.tolist(), frame.longest.tolist(), frame.spans, frame["items"]):
            spans, names = _united(spans), sorted({str(i) for part in items for i in part})
            out.append((row, doc, words, sum(e - s for s, e in spans), longest, spans, len(names),
                        hashlib.sha256(",".join(names).encode()).hexdigest()))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _DIGEST.split(", ")])


def _found(texts: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int) -> DataFrame:
    """What was found in each row of ``texts`` (row, doc_id, text)."""
    spark = texts.sparkSession
    dealt, n = _parts(scratch.write(_item_pieces(benchmark, window), "pieces"))
    texts = texts.select("row", named("doc_id"), whole_text().cast("binary").alias("text"))
    if n > 1:
        texts = scratch.write(texts, "texts")
    found = None
    for part in range(n):
        # At most twice WORDS_PER_PART words.
        items = [(r["item_id"], [w.encode() for w in r["words"]], r["piece"]) for r in dealt.filter(F.col("part") == part).collect()]
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(items, window))
        scanned = texts.mapInPandas(_scan(automaton), _HITS)
        if n > 1:
            scanned = scratch.write(scanned if part == 0 else scanned.filter("longest > 0"), f"hits-{part}")
            automaton.destroy()
        found = scanned if found is None else found.unionByName(scanned)
    if n == 1:
        united = found.withColumns({"spans": F.array("spans"), "items": F.array("items")})
    else:  # one row per part of the benchmark at most
        united = found.groupBy("row", "doc_id").agg(
            F.max("n_words").alias("n_words"), F.max("longest").alias("longest"),
            F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    return united.mapInPandas(_digest, _DIGEST)


def hits(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, longest, spans, n_items, items_sha256, contaminated`` of every row: ``spans`` are the
    hit words (first, end), ``longest`` the longest run of words that an item (or a piece of it) has too."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _found(texts, benchmark, scratch, window).drop("row").withColumns(
        {"doc_id": unnamed("doc_id"), "contaminated": F.col("n_hit") > 0})


def _without(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for text, spans in zip(frame.text, frame.spans):
            places = [m.span() for m in WORD.finditer(text)]
            kept, at = [], 0
            for start, end in spans:
                kept.append(text[at:places[int(start)][0]])
                at = places[int(end) - 1][1]
            out.append("".join([*kept, text[at:]]))
        yield pd.DataFrame({"row": frame.row, "cleaned": out})


def cleaned(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = 10) -> DataFrame:
    """The documents, all columns, with hit words (and what stands between them) cut out of their texts."""
    held = scratch.write(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "docs")
    texts = held.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").alias("text"))
    found = scratch.write(_found(texts, benchmark, scratch, window).filter("n_hit > 0").select("row", "spans"), "found")
    cut = texts.join(found, "row").select("row", "text", "spans").mapInPandas(_without, "row long, cleaned string")
    joined = held.join(scratch.write(cut, "cut"), "row", "left")
    return joined.select(*[
        (F.coalesce("cleaned", "doc.text") if c == "text" else F.col("doc").getField(c)).alias(c) for c in docs.columns])
