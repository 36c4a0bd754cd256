"""Phrases whose words stand together more often than apart, by level-wise tries.

Words are counted per language and the frequent ones numbered; texts become arrays of these numbers (0: a break
or a rare word, which no frequent phrase can hold). Then length by length:

1. Apriori: only phrases whose front and back (all but the last or first word) are frequent can be. Each task
   counts the ones it sees up to ``least`` and sends them, sorted and packed, to owners; what adds up to
   ``least`` is a candidate. (Sums of capped counts tell whether a phrase is frequent, not how frequent.)
2. Candidates, in order and numbered, are cut into parts of ``PART`` and each part is laid out as a double-array trie:
   a child's slot is its parent's base plus the word, and holds the parent for a check.
3. A trie is broadcast and numpy moves all positions of a chunk of text from level to level at once. The leaves reached are counted
   (``bincount``) and the counts sent, packed like the keys, to owners that sum them over tasks; where a leaf is reached at a place and at the next, a phrase one word longer goes to step 1.

Size: a trie has at most ``PART`` phrases plus one slot for each first word in its range, a part of the vocabulary
``PART_WORDS`` words; larger ones take one pass over the coded texts (or texts) for each part. Scores are worked out in decimals of 38 digits.

Contract
- Texts: null counts as empty, ``A-Z`` are lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are runs of other
  characters than blank and tab. A null ``lang`` is ``und``. Rows are counted one by one, whatever their ids (not read); repeated rows count again.
- Very long texts are read in slices cut between words, which does not part phrases. An empty table gives no rows.
- Ties: equal scores by count, then by the bytes of the phrase; equal cuts by the shorter first part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from plaza.llm.common import Scratch, pieces_of, squeezed, unsqueezed, whole_text
from plaza.llm.shingles import mixed
from plaza.operators.ranking import positions

SLICE, CHUNK = 1 << 20, 1 << 20  # bytes of a text and words at a time
HELD = 1 << 19  # different words counted before they are sent on
KEYS, KEYS_PER_OWNER = 1 << 22, 1 << 21
PART_WORDS, PART = 1 << 19, 1 << 20
WORD_BITS, DIGIT = 31, 11
SALTS = 64

_BREAK = b"."
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x2E if b in b".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if b == 9 else b for b in range(256))


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words and breaks of a text, a slice at a time."""
    text, at = text.translate(_BYTES).replace(_BREAK, b" . "), 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        # Only blanks are left of what split() takes for white space.
        yield text[at:end].split()
        at = end


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, Counter] = {}

    def sent() -> pd.DataFrame:
        rows = [(lang, word.decode(), n) for lang, counts in held.items() for word, n in counts.items() if word != _BREAK]
        held.clear()
        return pd.DataFrame(rows, columns=["lang", "word", "n"])

    for frame in frames:
        for lang, text in zip(frame.lang, frame.text):
            counts = held.setdefault(lang, Counter())
            for some in tokens(bytes(text)):
                counts.update(some)
        if sum(map(len, held.values())) > HELD:
            yield sent()
    yield sent()


# ---- texts as numbers -----------------------------------------------------------

_known: dict[int, dict[str, dict[bytes, int]]] = {}


def _vocabulary(shared) -> dict[str, dict[bytes, int]]:
    """Numbers of words by language, built once per worker."""
    if shared.value["name"] not in _known:
        _known.clear()
        _known[shared.value["name"]] = {
            lang: {w: first + i for i, w in enumerate(words.split(b" "))} for lang, first, words in shared.value["words"]}
    return _known[shared.value["name"]]


def _codes(words: dict[bytes, int], text: bytes) -> Iterator[np.ndarray]:
    for some in tokens(text):
        yield np.fromiter(map(words.get, some, repeat(0)), np.int32, len(some))


def _tight(codes: np.ndarray) -> np.ndarray:
    """Without words that have no numbered neighbour, and with one break at a time."""
    some = codes > 0
    before, after = np.append(False, some[:-1]), np.append(some[1:], False)
    words = some & (before | after)
    return codes[words | ~some & np.append(False, words[:-1])]


def _coded(shared):
    """Chunks of texts as numbers. What an earlier part of the vocabulary numbered comes in ``ids``."""

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, held, size = _vocabulary(shared), [], 0

        def chunk(codes: np.ndarray) -> pd.DataFrame:
            codes = _tight(codes)
            return pd.DataFrame({"n": [len(codes)], "codes": [squeezed(codes.tobytes())]})

        for frame in frames:
            for lang, text, ids in zip(frame.lang, frame.text, frame.ids):
                at = 0
                for codes in _codes(vocabulary.get(lang, {}), bytes(text)):
                    if ids is not None:
                        codes = np.maximum(codes, np.frombuffer(ids, np.int32, len(codes), at))
                        at += codes.nbytes
                    held.append(codes)
                    size += len(codes)
                    if size >= CHUNK:
                        whole = np.concatenate(held)
                        breaks = np.flatnonzero(whole == 0)
                        if len(breaks):
                            yield chunk(whole[:breaks[-1] + 1])
                            held = [whole[breaks[-1] + 1:]]
                        else:
                            held = [whole]
                        size = len(held[0])
                held.append(np.zeros(1, np.int32))
                size += 1
        if size:
            yield chunk(np.concatenate(held))

    return code


def _numbered(shared):
    """Texts with the numbers of the words in this part of the vocabulary, beside those of earlier parts."""

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = _vocabulary(shared)
        for frame in frames:
            out = []
            for lang, text, ids in zip(frame.lang, frame.text, frame.ids):
                codes = np.concatenate([np.zeros(0, np.int32), *_codes(vocabulary.get(lang, {}), bytes(text))])
                out.append((codes if ids is None else np.maximum(codes, np.frombuffer(ids, np.int32))).tobytes())
            yield frame[["lang", "text"]].assign(ids=out)

    return number


def _runs(words: DataFrame) -> list[tuple[str, int, bytes]]:
    """Language, first number and words of each language. Numbers go up by language."""
    got = words.select("lang", "word", "gid").toArrow().sort_by("gid")
    lang = got["lang"].combine_chunks().dictionary_encode()
    codes = lang.indices.to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)] if len(codes) else []
    word, gid = got["word"], got["gid"]
    return [(lang[lo].as_py(), gid[lo].as_py(), " ".join(word.slice(lo, hi - lo).to_pylist()).encode()) for lo, hi in zip(cuts, cuts[1:])]


def _chunks(texts: DataFrame, words: DataFrame, scratch: Scratch) -> DataFrame:
    """``n, codes``: the texts as numbers of the frequent ``words`` (lang, word, gid)."""
    context = texts.sparkSession.sparkContext
    most = words.agg(F.max("gid")).first()[0] or 0
    if most >= 1 << WORD_BITS:
        raise ValueError("more frequent words than their numbers have room for")
    parts = -(-most // PART_WORDS) or 1
    rows = texts.withColumn("ids", F.lit(None).cast("binary"))
    for part in range(parts):
        # At most PART_WORDS words.
        found = words.filter((F.col("gid") > part * PART_WORDS) & (F.col("gid") <= (part + 1) * PART_WORDS))
        shared = context.broadcast({"name": f"{scratch.root}-{part}", "words": _runs(found)})
        if part < parts - 1:
            rows = scratch.write(rows.mapInPandas(_numbered(shared), "lang string, text binary, ids binary"), f"numbered-{part}")
        else:
            coded = scratch.write(rows.mapInPandas(_coded(shared), "n long, codes binary"), "codes")
        shared.destroy()
        if part:
            scratch.drop(f"numbered-{part - 1}")
    return coded


# ---- tries ------------------------------------------------------------------------

class Slots:
    """Which slots of a double array are taken."""

    def __init__(self, size: int):
        self.taken, self.end = np.zeros(size, bool), 1

    def room(self, upto: int) -> None:
        if upto >= len(self.taken):
            self.taken = np.concatenate([self.taken, np.zeros(max(len(self.taken), upto + 1 - len(self.taken)), bool)])

    def take(self, slots: np.ndarray) -> None:
        self.taken[slots] = True
        self.end = max(self.end, int(slots[-1]) + 1)

    def bases(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A base for each node (its children's codes begin at ``starts``): the widest first, single children into what is left."""
        ends = np.append(starts[1:], len(codes))
        degree, out, near = ends - starts, np.zeros(len(starts), np.int64), 1
        for node in np.argsort(-degree, kind="stable"):
            if degree[node] < 2:
                break
            own = codes[starts[node]:ends[node]]
            steps = own - own[0]
            slot, near = self._fit(steps, near)
            out[node] = slot - own[0]
            self.take(slot + steps)
        single = np.flatnonzero(degree == 1)
        if len(single):
            self.room(self.end + len(single))
            free = 1 + np.flatnonzero(~self.taken[1:self.end + len(single) + 1])[:len(single)]
            out[single] = free - codes[starts[single]]
            self.take(free)
        return out

    def _fit(self, steps: np.ndarray, near: int) -> tuple[int, int]:
        """The first slot that leaves room for all children, and where to look next time."""
        at, step = near, 512
        while at < self.end:
            self.room(at + 512 + int(steps[-1]))
            free = at + np.flatnonzero(~self.taken[at:at + 512])[:64]
            if len(free):
                fits = ~self.taken[free[:, None] + steps[None, :]].any(axis=1)
                if fits.any():
                    # What lies before is too full for nodes of this width; single children fill it in the end.
                    return int(free[fits.argmax()]), near if at == near else near + 256
            at, step = at + step, step + step // 8
        self.room(self.end + int(steps[-1]))
        return self.end, near


class Trie:
    """A double array of phrases of one length, and the number of each.

    The first word is one step from the root, later words are taken by digits of ``DIGIT`` bits, so that the children
    of a node lie in a narrow range and nodes pack tightly.
    """

    def __init__(self, low: int, first: int, depth: int, digits: int, base: np.ndarray, check: np.ndarray, leaf: np.ndarray):
        self.low, self.first, self.depth, self.digits = low, first, depth, digits
        self.base, self.check, self.leaf = base, check, leaf

    @classmethod
    def of(cls, columns: list[np.ndarray], first: int) -> Trie:
        """From the words of sorted, distinct phrases; the phrases get the numbers from ``first`` on."""
        words, n = columns[0], len(columns[0])
        digits = max(-(-int(c.max()).bit_length() // DIGIT) for c in columns)
        low, width = int(words[0]), int(words[-1] - words[0]) + 1
        slots = Slots(2 * (width + n) + 2)
        slots.take(np.arange(width + 1))  # the root, and a slot for each first word in the range
        new = np.append(True, words[1:] != words[:-1])
        parent = words - low + 1
        levels = [(parent[new], np.zeros(int(new.sum()), np.int64))]
        bases = [(np.zeros(1, np.int64), np.array([1 - low]))]
        for column in (c >> DIGIT * d & (1 << DIGIT) - 1 for c in columns[1:] for d in reversed(range(digits))):
            fresh = new  # rows that begin another parent
            new = new | np.append(True, column[1:] != column[:-1])
            codes, of = column[new], parent[new]
            starts = np.flatnonzero(fresh[new])
            base = slots.bases(codes, starts)
            bases.append((of[starts], base))
            slot = np.repeat(base, np.diff(np.append(starts, len(codes)))) + codes
            levels.append((slot, of))
            parent = slot[np.cumsum(new) - 1]
        size = slots.end
        base, check, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.zeros(size, np.int32)
        for slot, of in levels:
            check[slot] = of
        for slot, at in bases:
            base[slot] = at
        leaf[parent] = np.arange(n)
        return cls(low, first, len(columns), digits, base, check, leaf)

    def walk(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where a phrase begins, and which one (counted from ``first``). All places move a level at a time."""
        at = np.flatnonzero(codes >= self.low)
        state = codes[at].astype(np.int64) - self.low + 1
        keep = state < len(self.check)
        at, state = at[keep], state[keep]
        keep = self.check[state] == 0
        at, state = at[keep], state[keep]
        for level in range(1, self.depth):
            keep = at + level < len(codes)
            at, state = at[keep], state[keep]
            code = codes[at + level].astype(np.int64)
            keep = (code > 0) & (code < 1 << DIGIT * self.digits)
            at, state, code = at[keep], state[keep], code[keep]
            for d in reversed(range(self.digits)):
                slot = self.base[state] + (code >> DIGIT * d & (1 << DIGIT) - 1)
                keep = (slot >= 0) & (slot < len(self.check))
                keep[keep] = self.check[slot[keep]] == state[keep]
                at, state, code = at[keep], slot[keep], code[keep]
        return at, self.leaf[state]


def _laid_out(depth: int):
    def lay(phrases: pd.DataFrame) -> pd.DataFrame:
        phrases = phrases.sort_values("number")
        first = int(phrases.number.iloc[0])
        trie = Trie.of([phrases[f"w{i}"].to_numpy().astype(np.int64) for i in range(1, depth + 1)], first)
        return pd.DataFrame({
            "part": phrases.part.iloc[:1], "low": [trie.low], "first": [first], "digits": [trie.digits], "n": [len(phrases)],
            "base": [trie.base.tobytes()], "check": [trie.check.tobytes()], "leaf": [trie.leaf.tobytes()]})

    return lay


_SENT = "counted boolean, owner int, size int, keys binary, seen binary"


def _packed(keys: np.ndarray, n: np.ndarray, owners: int, counted: bool) -> pd.DataFrame:
    """Sorted keys and their counts, packed by owner. ``counted``: numbers of phrases with all their places, not keys of longer ones."""
    owner = (mixed(keys.view(np.uint64)) % np.uint64(owners)).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    keys, n, owner = keys[order], n[order].astype(np.int64), owner[order]
    cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    out = [(counted, int(owner[lo]), hi - lo, squeezed(np.diff(keys[lo:hi], prepend=0).tobytes()), squeezed(n[lo:hi].tobytes()))
           for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])]
    return pd.DataFrame(out, columns=[c.split()[0] for c in _SENT.split(", ")])


def _messages(held: list[np.ndarray], owners: int, least: int) -> pd.DataFrame:
    """Distinct keys with their counts up to ``least``, by owner."""
    keys, n = np.unique(np.concatenate(held), return_counts=True)
    return _packed(keys, np.minimum(n, least), owners, False)


def _decoded(packed: bytes) -> np.ndarray:
    return np.frombuffer(unsqueezed(bytes(packed)), np.int32)


def _pairs(owners: int, least: int):
    """Pairs of numbered words."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            for packed in frame.codes:
                codes = _decoded(packed).astype(np.int64)
                both = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
                held.append(codes[both] << WORD_BITS | codes[both + 1])
                size += len(both)
                if size >= KEYS:
                    yield _messages(held, owners, least)
                    held, size = [], 0
        if size:
            yield _messages(held, owners, least)

    return send


def _sums(messages: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of an owner's messages, and what their counts add up to."""
    keys = np.concatenate([np.cumsum(np.frombuffer(unsqueezed(bytes(k)), np.int64)) for k in messages["keys"]])
    seen = np.concatenate([np.frombuffer(unsqueezed(bytes(s)), np.int64) for s in messages.seen])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(seen[order], starts)


def _frequent(least: int):
    def add_up(messages: pd.DataFrame) -> pd.DataFrame:
        keys, total = _sums(messages)
        return pd.DataFrame({"key": keys[total >= least]})

    return add_up


def _totals(messages: pd.DataFrame) -> pd.DataFrame:
    number, n = _sums(messages)
    return pd.DataFrame({"number": number, "n": n})


def _passed(shared, owners: int, least: int, longer: bool):
    """Count the phrases of a trie, and send on those one word longer that it allows."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        n, trie, edges = shared.value
        total = np.zeros(n, np.int64)
        for frame in frames:
            for packed in frame.codes:
                codes = _decoded(packed)
                at, leaf = trie.walk(codes)
                total += np.bincount(leaf, minlength=n)
                if longer and len(at):
                    keys = _longer(codes, at, leaf, trie, edges)
                    held.append(keys)
                    size += len(keys)
                    if size >= KEYS:
                        yield _messages(held, owners, least)
                        held, size = [], 0
        if size:
            yield _messages(held, owners, least)
        some = np.flatnonzero(total)
        yield _packed(some + trie.first, total[some], owners, True)

    return count


def _longer(codes: np.ndarray, at: np.ndarray, leaf: np.ndarray, trie: Trie, edges: tuple) -> np.ndarray:
    """Number of the phrase at each place and the word behind it, where the phrase at the next place may be frequent too."""
    depth, (least, most) = trie.depth, edges
    here = np.zeros(len(codes) + 1, bool)
    here[at] = True
    keep = (at + depth < len(codes))
    at, leaf = at[keep], leaf[keep]
    after = codes[at + depth]
    # Phrases outside the range of this trie are judged by another one: they may be frequent.
    word = codes[at + 1]
    keep = (after > 0) & (here[at + 1] | (word <= least) | (word >= most))
    return (leaf[keep].astype(np.int64) + trie.first) << WORD_BITS | after[keep]


def _candidates(sent: DataFrame, least: int, shorter: DataFrame | None, depth: int, scratch: Scratch) -> DataFrame:
    """``number, part, w1 ... w<depth>`` of the phrases that add up to ``least``, numbered in order."""
    keys = sent.filter("NOT counted").select("owner", "keys", "seen").groupBy("owner").applyInPandas(_frequent(least), "key long")
    keys = positions(keys, [], ["key"], "number").select(
        "number", F.floor(F.col("number") / PART).cast("int").alias("part"),
        F.shiftright("key", WORD_BITS).alias("front"), (F.col("key") % (1 << WORD_BITS)).alias("last"))
    if shorter is None:
        made = keys.select("number", "part", F.col("front").alias("w1"), F.col("last").alias("w2"))
    else:
        fronts = shorter.select(F.col("number").alias("front"), *[f"w{i}" for i in range(1, depth)])
        made = keys.join(fronts, "front").select("number", "part", *[f"w{i}" for i in range(1, depth)], F.col("last").alias(f"w{depth}"))
    return scratch.write(made, f"candidates-{depth}")


def counted_phrases(chunks: DataFrame, scratch: Scratch, least: int, longest: int) -> list[DataFrame]:
    """For each length from two words: ``number, w1, ..., n`` of the phrases that stand ``least`` times or more."""
    context, out, shorter = chunks.sparkSession.sparkContext, [], None
    owners = pieces_of(chunks.agg(F.sum("n")).first()[0] or 0, KEYS_PER_OWNER)
    sent = scratch.write(chunks.select("codes").mapInPandas(_pairs(owners, least), _SENT), "pairs")
    for depth in range(2, longest + 1):
        found = _candidates(sent, least, shorter, depth, scratch)
        tries = scratch.write(found.groupBy("part").applyInPandas(
            _laid_out(depth), "part int, low long, first long, digits int, n long, base binary, check binary, leaf binary"), f"tries-{depth}")
        sent = None
        for part, in sorted(tries.select("part").collect()):
            row = tries.filter(F.col("part") == part).first()
            arrays = [np.frombuffer(row[c], np.int32) for c in ("base", "check", "leaf")]
            edges = found.filter(F.col("part") == part).agg(F.min("w1"), F.max("w1")).first()
            shared = context.broadcast((row["n"], Trie(row["low"], row["first"], depth, row["digits"], *arrays), tuple(edges)))
            some = scratch.write(chunks.select("codes").mapInPandas(_passed(shared, owners, least, depth < longest), _SENT), f"passed-{depth}-{part}")
            shared.destroy()
            sent = some if sent is None else sent.unionByName(some)
        if sent is None:
            break
        counts = sent.filter("counted").select("owner", "keys", "seen").groupBy("owner").applyInPandas(_totals, "number long, n long")
        shorter = scratch.write(found.drop("part").join(counts, "number"), f"phrases-{depth}")
        out.append(shorter)
    return out


# ---- scores -------------------------------------------------------------------------

def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact."""
    big = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (big(a) * big(a)), big(left) * big(right)).cast("long")


def mine(docs: DataFrame, scratch: Scratch, least: int = 10, longest: int = 3, top: int | None = 2000, share: int = 50) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of two to ``longest`` words that stand
    ``least`` times or more, without those of which a longer one covers ``share`` percent."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().cast("binary").alias("text"))
    counts = texts.mapInPandas(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = scratch.write(counts, "counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counts.filter(F.col("n") >= least).withColumn("rare", -F.col("n"))
    words = scratch.write(positions(frequent, [], ["lang", "rare", "word"], "gid", 1).select("lang", "word", "n", "gid"), "words")
    lengths = counted_phrases(_chunks(texts, words, scratch), scratch, least, longest)
    if not lengths:
        return docs.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")

    listed = [p.select(F.array(*[f"w{i}" for i in range(1, depth + 1)]).alias("ws"), F.col("n").alias("f")) for depth, p in enumerate(lengths, 2)]
    found = listed[0]
    for p in listed[1:]:
        found = found.unionByName(p)
    known = words.select(F.array("gid").alias("ws"), F.col("n").alias("f")).unionByName(found)
    cut = F.explode(F.sequence(F.lit(1), F.size("ws") - 1))
    cuts = found.select("ws", F.col("f").alias("a"), cut.alias("k")).select(
        "ws", "a", "k", F.slice("ws", F.lit(1), F.col("k")).alias("front"), F.slice("ws", F.col("k") + 1, F.size("ws") - F.col("k")).alias("back"))
    parts = cuts.join(known.select(F.col("ws").alias("front"), F.col("f").alias("l")), "front").join(
        known.select(F.col("ws").alias("back"), F.col("f").alias("r")), "back")
    lowest = parts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"))).groupBy("ws").agg(
        F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k")).alias("best"))
    if longest > 2:
        size = F.explode(F.sequence(F.lit(2), F.size("ws") - 1)).alias("m")
        inner = found.filter(F.size("ws") > 2).select("ws", "f", size).select(
            "f", F.explode(F.transform(F.sequence(F.lit(1), F.size("ws") - F.col("m") + 1), lambda i: F.slice("ws", i, F.col("m")))).alias("ws"))
        over = inner.groupBy("ws").agg(F.max("f").alias("longer"))
        lowest = lowest.join(over, "ws", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("best.a")))
    rows = lowest.select("ws", "best.*")
    for place in range(longest):
        name = words.select(F.col("gid").alias("at"), F.col("word").alias(f"word{place}"), *(["lang"] if not place else []))
        rows = rows.withColumn("at", F.get("ws", F.lit(place))).join(name, "at", "left").drop("at")
    rows = rows.withColumn("phrase", F.concat_ws(" ", *[f"word{i}" for i in range(longest)])).select("lang", "phrase", "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    if top is not None:  # the best of each share of a language first
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("rank")
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    else:
        rows = positions(rows.withColumns({"x": -F.col("score"), "y": -F.col("a")}), ["lang"], ["x", "y", "phrase"], "rank", 1)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
