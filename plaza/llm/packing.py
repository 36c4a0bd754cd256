"""Packing of token sequences by swap-based local search.

Documents are tokenized, ended with an end id, and cut into pieces of the sequence
length only where they are longer. The pieces are dealt into groups of bounded size.
In a group best-fit gives a first packing; then the emptiest underfull sequence is
drained: its documents are moved into others, exchanged one for one, or two for one,
whenever that fills the other sequence further (which increases the sum of squared
fills), until it is empty or no exchange is left. The emptiest sequences of each group that are still
underfull, with at most half of its pieces, are dealt into groups of the same bound for another pass, as many as
their pieces need; the others are done. So passes at least halve, whatever can be filled, and none adds a sequence.

Contract
- Null text counts as empty; an empty document is its end id alone. Every row is packed,
  rows that repeat a ``doc_id`` too. Null ids are carried along. An empty table gives no
  rows. Only ``doc_id`` and ``text`` are read.
- Where a document is cut, its first piece is the short one.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plaza.llm.common import Scratch, batches_of, give_back, named, pieces_of, unnamed, whole_text

LENGTH = 1024
END = 2
PIECES_PER_GROUP = 30_000
SLICE_CHARS = 8_000_000
KNOWN_CHUNKS = 600_000
GROUP_NUMBERS = 1 << 40

# The pre-tokenizer's pattern, and characters for which it needs no table
# of a certain Unicode version.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = r"[\x21-\x7e\xc0-ɏ]*"
# Where white space meets white space (or the marker is in the text) a text is not split. (In the words of RE2.)
UNEVEN = r"[ \n][ \n]|[\x00-\x09\x0b-\x1f\x7f-\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}-\x{202f}\x{205f}\x{3000}\x{feff}]"

PIECE = "key long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
PLACED = "key long, doc_id long, piece int, start long, length long, ids_crc32 long, grp long, sequence_id long, offset long, fill long, again boolean"


class Encoder:
    """Ids of texts, by the model of a byte-level tokenizer file.

    A text falls into chunks at single blanks and line ends, where the pre-tokenizer
    always splits. The ids of a chunk are worked out once and kept with those of the others, one after another.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        # A text that holds a token of its own kind, such as the mark of a text's end, is not split.
        own_kind = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(own_kind) or r"(?!)")
        self.split, self.plain = regex.compile(PATTERN), re.compile(PLAIN)
        # Bytes that have no printed form of their own stand for characters from 256 on.
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in set(own)]
        self.printed = {b: 256 + i for i, b in enumerate(other)}
        self.blank, self.line = chr(self.printed[0x20]), chr(self.printed[0x0A])
        # Known chunks, their ids, where these begin and end, and the call that last met each.
        self.known, self.pool = pa.array([], pa.large_string()), np.zeros(0, np.uint32)
        self.ends, self.met, self.calls = np.zeros(1, np.int64), np.zeros(0, np.int64), 0

    def slow(self, text: str) -> bytes:
        return _packed_ids(self.whole.encode(text, add_special_tokens=False).ids)

    def pieces(self, printed: list[str]) -> bytes:
        tokenize = self.model.tokenize
        return _packed_ids([t.id for p in printed for t in tokenize(p)])

    def chunk(self, chunk: str) -> bytes:
        """A chunk begins with the marker (nothing before it), a line end, or stands after a blank."""
        head = chunk[:1]
        bare = head in ("\x00", "\n")
        rest = chunk[1:] if bare else chunk
        if not self.plain.fullmatch(rest):
            return self.slow(rest if head == "\x00" else chunk if bare else " " + chunk)
        before = ([] if head == "\x00" else [self.line]) if bare else []
        lead = "" if bare else self.blank
        # A word, or a word and one mark after it: the pattern's commonest cases.
        if rest.isalpha():
            return self.pieces([*before, lead + self.print(rest)])
        if rest[-1:] in (".", ",") and rest[:-1].isalpha():
            return self.pieces([*before, lead + self.print(rest[:-1]), rest[-1]])
        return self.pieces([*before, *(self.print(p) for p in self.split.findall(rest if bare else " " + rest))])

    def print(self, text: str) -> str:
        if text.isascii():
            return text.replace(" ", self.blank)
        return text.encode().decode("latin-1").translate(self.printed)

    def forget(self) -> None:
        """The half met last stays."""
        kept = np.sort(np.argsort(-self.met, kind="stable")[:KNOWN_CHUNKS // 2])
        sizes = np.diff(self.ends)[kept]
        self.known, self.pool = self.known.take(pa.array(kept)), self.pool[_ranges(self.ends[kept], sizes)]
        self.ends, self.met = np.append(0, np.cumsum(sizes)), self.met[kept]

    def places(self, chunks: pa.Array) -> np.ndarray:
        """Where distinct chunks stand among the known; ids of new ones are worked out."""
        if len(self.known) > KNOWN_CHUNKS:
            self.forget()
        self.calls += 1
        found = pc.index_in(chunks, value_set=self.known)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        new = at < 0
        self.met[at[~new]] = self.calls
        if new.any():
            at[new] = len(self.known) + np.arange(new.sum())
            chunks = chunks.filter(pa.array(new))
            ids = [self.chunk(c) if c else self.slow(" ") for c in chunks.to_pylist()]
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) >> 2
            self.known = pa.concat_arrays([self.known, chunks])
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), np.uint32)])
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
            self.met = np.append(self.met, np.full(len(ids), self.calls))
        return at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text begins."""
        uneven = pc.match_substring_regex(pa.array(texts, pa.large_string()), UNEVEN).to_pylist()
        odd = {i: np.frombuffer(self.slow(t), np.uint32) for i, t in enumerate(texts) if uneven[i] or self.special.search(t)}
        marked = pa.array(["" if i in odd else "\x00" + t.replace("\n", " \n") for i, t in enumerate(texts)], pa.large_string())
        lists = pc.split_pattern(marked, " ")
        offsets, words = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        del marked, lists
        place = self.places(words.dictionary)[words.indices.to_numpy()]
        del words
        of_word = np.diff(self.ends)[place]
        at = np.append(0, np.cumsum(of_word))[offsets]
        flat = self.pool[_ranges(self.ends[place], of_word)]
        if odd:
            parts = [odd.get(i, flat[at[i]:at[i + 1]]) for i in range(len(texts))]
            flat = np.concatenate(parts)
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return flat, at


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one after another."""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(len(places))
    return places


def _packed_ids(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _pieces_of(own: Encoder, frame: pd.DataFrame, key: int) -> pd.DataFrame:
    flat, at = own.encode(frame.text.tolist())
    out = []
    for doc, lo, hi in zip(frame.doc_id.tolist(), at[:-1], at[1:]):
        ids = np.append(flat[lo:hi], np.uint32(END)).astype("<u4")
        first = (len(ids) - 1) % LENGTH + 1
        cuts = [0, *range(first, len(ids) + 1, LENGTH)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            raw = ids[a:b].tobytes()
            out.append((key + len(out), doc, k, a, b - a, zlib.crc32(raw), raw))
    return pd.DataFrame(out, columns=[c.split()[0] for c in PIECE.split(", ")])


def _tokenized(path: str, keep_ids: bool):
    """Of a slice only its pieces outlive it, and what it took goes back before the next: idle workers stay beside later steps."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, key = encoder(path), TaskContext.get().partitionId() << 40
        for frame in batches_of(frames, "text", SLICE_CHARS):
            made = _pieces_of(own, frame, key)
            key += len(made)
            yield made if keep_ids else made.assign(ids=None)
            del frame, made
            give_back()

    return run


def pieces(docs: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """The pieces of every document, with their ids (little-endian unsigned 32 bit) if asked, and a
    number of their own (write the pieces before it is used)."""
    texts = docs.select(named("doc_id"), whole_text().alias("text"))
    return texts.mapInPandas(_tokenized(path, keep_ids), PIECE).withColumn("doc_id", unnamed("doc_id"))


def best_fit(sizes: np.ndarray, length: int = LENGTH) -> list[list[int]]:
    """Best-fit decreasing: each item goes to the fullest sequence that can take it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    open_rooms = 0  # bit r is set if some sequence has room r
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
            bins[at].append(item)
        else:
            room, at = length, len(bins)
            bins.append([item])
        left = room - size
        if left:
            by_room[left].append(at)
            open_rooms |= 1 << left
    return bins


def _exchange(giver: list[int], taker: list[int], sizes: list[int], room: int) -> tuple[int, list[int], list[int]]:
    """What to hand from one sequence to the other, and back, to fill the taker most:
    one document for none (a move), one for one, two for one, one for two."""
    best = (0, [], [])
    for i, x in enumerate(giver):
        a = sizes[x]
        if best[0] < a <= room:
            best = (a, [x], [])
        for y in taker:
            if best[0] < a - sizes[y] <= room:
                best = (a - sizes[y], [x], [y])
        for z in giver[i + 1:]:
            both = a + sizes[z]
            for y in taker:
                if best[0] < both - sizes[y] <= room:
                    best = (both - sizes[y], [x, z], [y])
        for j, y in enumerate(taker):
            for z in taker[j + 1:]:
                if best[0] < a - sizes[y] - sizes[z] <= room:
                    best = (a - sizes[y] - sizes[z], [x], [y, z])
        if best[0] == room:
            break
    return best


def local_search(bins: list[list[int]], sizes: np.ndarray, length: int = LENGTH) -> list[list[int]]:
    """Drain the emptiest sequences into the other underfull ones.

    An exchange takes d > 0 from the emptiest sequence and adds it to a fuller one, so
    the sum of squared fills grows with each; the search ends.
    """
    size = [int(s) for s in sizes]
    fill = [sum(size[x] for x in b) for b in bins]
    under = sorted((b for b in range(len(bins)) if fill[b] < length), key=lambda b: fill[b])
    while len(under) > 1 and sum(length - fill[b] for b in under) >= length:
        victim, others = under[0], under[1:]
        before = fill[victim]
        for other in reversed(others):
            if not bins[victim]:
                break
            gain, give, back = _exchange(bins[victim], bins[other], size, length - fill[other])
            if gain:
                bins[victim] = [x for x in bins[victim] if x not in give] + back
                bins[other] = [x for x in bins[other] if x not in back] + give
                fill[victim] -= gain
                fill[other] += gain
        if fill[victim] == before:
            break  # no exchange is left for the emptiest
        under = sorted((b for b in under if bins[b] and fill[b] < length), key=lambda b: fill[b])
    return [b for b in bins if b]


def _packed(frame: pd.DataFrame) -> pd.DataFrame:
    sizes = frame.length.to_numpy().astype(np.int64)
    bins = local_search(best_fit(sizes), sizes)
    if "sequence_id" in frame:
        before = list(frame.groupby("sequence_id").indices.values())
        if len(bins) > len(before):
            bins = local_search([b.tolist() for b in before], sizes)
    group = int(frame.grp.iloc[0])
    sequence, offset, fill = (np.zeros(len(frame), np.int64) for _ in range(3))
    for number, items in enumerate(bins):
        at = 0
        for x in items:
            sequence[x], offset[x] = number, at
            at += sizes[x]
        fill[items] = at
    again, left = np.zeros(len(frame), bool), len(frame) // 2
    for items in sorted((b for b in bins if fill[b[0]] < LENGTH), key=lambda b: fill[b[0]]):
        left -= len(items)
        if left < 0:
            break
        again[items] = True
    frame["sequence_id"], frame["offset"], frame["fill"], frame["again"] = sequence * GROUP_NUMBERS + group, offset, fill, again
    return frame[[c.split()[0] for c in PLACED.split(", ")]]


def pack(cut: DataFrame, scratch: Scratch, keep_ids: bool = True) -> DataFrame:
    """``cut`` (written pieces) with ``sequence_id``, ``offset`` and the fill of the sequence. Lengths are
    packed; ids join at the end."""
    ids = cut.select("key", "ids")
    cut = cut.drop("ids")
    groups = pieces_of(cut.count(), PIECES_PER_GROUP, 1)
    dealt = F.pmod(F.xxhash64("key"), F.lit(groups))
    packed = scratch.write(cut.withColumns({"grp": dealt, "doc_id": named("doc_id")}).groupBy("grp").applyInPandas(_packed, PLACED), "packed-0")
    done, first, step = [], groups, 0
    while groups > 1:
        done.append(packed.filter(~F.col("again")))
        under = packed.filter("again").drop("offset", "fill", "again")
        # The next pass numbers its groups after those of the passes before. Sequences stay together.
        groups, step = pieces_of(under.count(), PIECES_PER_GROUP, 1), step + 1
        regrouped = F.lit(first) + F.pmod(F.xxhash64("sequence_id", F.lit(step)), F.lit(groups))
        packed = scratch.write(under.withColumn("grp", regrouped).groupBy("grp").applyInPandas(_packed, PLACED), f"packed-{step}")
        first += groups
    out = packed
    for part in done:
        out = out.unionByName(part)
    out = out.drop("grp", "again").withColumn("doc_id", unnamed("doc_id"))
    return (out.join(ids, "key") if keep_ids else out).drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of every sequence in order (at most LENGTH each)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit("").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))


def packed_documents(docs: DataFrame, path: str, scratch: Scratch, keep_ids: bool = True) -> DataFrame:
    return pack(scratch.write(pieces(docs, path, keep_ids), "pieces"), scratch, keep_ids)
