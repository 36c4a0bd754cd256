"""Repair of conversations by iterative-deepening A*.

A conversation is brought to the form ``(s?(ua)+)?`` of role initials by the cheapest edits: Keep (0),
Rerole to user or assistant (2), Delete (3), Insert a turn without text (2); a truncated row that stays
costs 1 more, blank and repeated rows must go. What a role may follow is settled by the state (nothing
yet, after system, user or assistant), so an edit leads to one state only.

The search goes depth first through the edits in the order of their initials, D I K R, under a bound on
the cost, and raises the bound to the least cost that went beyond it. Bounds are cut by a lower bound of the cost
still to come: what each row costs at least, and 2 for each of the disjoint pairs of neighbours whose roles cannot
follow one another. A table holds the most that was left to spend when a (row, state) failed; it stays valid from
bound to bound. The first path that is accepted is therefore the cheapest and, of those, the least in ASCII.

Rows are numbered by ``positions`` (a range partitioning, so that a conversation may span tasks); repeats are
found by the first position of each text. ``BLOCK`` rows at a time become a short code, and a block is
searched by itself: conversations of one block, nearly all, in one step. For longer ones each block gives
its cost from each state before it to each state behind it; a chain over these gives what is still to
come behind each block, every block is then searched from each state, and a second chain picks the paths. The
chains stream over a few numbers per block. Texts are joined with the edits at the end, streaming through one task per conversation, as its
hash has to be; no conversation is held whole, only the one string of its edits.

Contract
- Nulls count as one blank in roles and texts. A null ``conv_id`` is a conversation, null turns come first.
  Rows of one turn are taken by role, then by the SHA-256 of their text; equal rows in any order.
- Each row's first fault counts: blank, repeat of an earlier row's role and text, truncated. Empty texts are blank. A role
  whose initial is not s, u or a can be reroled or deleted only. Very long texts are hashed whole.
- Every conversation of ``ids`` gives a row: one without rows gives zeros, no edits and the hash of nothing. An empty table gives
  no rows. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plaza.llm.common import Scratch, named, unnamed
from plaza.operators.ranking import positions

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLOCK = 256
SPACES = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
# The state after a kept role, by state and initial; and after a role that may be chosen.
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
CHOSEN = [USER, USER, ASSISTANT, USER]
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
AT_END = (0, 2 * INSERT, INSERT, 0)  # what is missing behind the last row, by state
GONE = "-"  # in a code: a row that must go; else its initial (x: none of s, u, a), upper case if truncated


def _moves(code: str, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits at row ``i`` in order: initial, cost, row and state after it."""
    row = code[i]
    yield "D", DELETE, i + 1, state
    yield "I", INSERT, i, CHOSEN[state]
    if row != GONE:
        more = TRUNCATED if row.isupper() else 0
        kept = FOLLOWS.get((state, row.lower()))
        if kept is not None:
            yield "K", KEEP + more, i + 1, kept
        yield "R", REROLE + more, i + 1, CHOSEN[state]


class LowerBound:
    """What the rows from one on cost at least, by state before them."""

    def __init__(self, code: str, after: tuple[int, ...]):
        n = len(code)
        self.code, self.after, self.least = code, after, min(after)
        self.base, self.pairs, self.first = [0] * (n + 2), [0] * (n + 2), [n] * (n + 2)
        for i in range(n - 1, -1, -1):
            row = code[i]
            if row == GONE:
                self.base[i], self.pairs[i], self.first[i] = self.base[i + 1] + DELETE, self.pairs[i + 1], self.first[i + 1]
                continue
            more = TRUNCATED if row.isupper() else 0
            own = min(REROLE + more, DELETE) if row in "xX" else more
            k = self.first[i + 1]
            clash = row not in "xX" and k < n and code[k] not in "xX" and (row + code[k]).lower() not in LEGAL
            self.first[i], self.base[i] = i, self.base[i + 1] + own
            self.pairs[i] = max(self.pairs[k], 1 + self.pairs[k + 1]) if clash else self.pairs[k]

    def __call__(self, i: int, state: int) -> int:
        n, f = len(self.code), self.first[i]
        if i == n:
            return self.after[state]
        if f == n:
            one, two = CHOSEN[state], CHOSEN[CHOSEN[state]]
            return self.base[i] + min(self.after[state], INSERT + self.after[one], 2 * INSERT + self.after[two])
        row, pairs = self.code[f].lower(), self.pairs[f]
        if row != "x" and (state, row) not in FOLLOWS:
            pairs = max(pairs, 1 + self.pairs[f + 1])
        return self.base[i] + 2 * pairs + self.least


@lru_cache(1 << 16)
def cheapest(code: str, after: tuple[int, ...] = AT_END, start: int = START) -> tuple[str, int, int]:
    """The edits of a block's rows, the state behind them, and their cost with ``after`` (by that state)."""
    least, n = LowerBound(code, after), len(code)
    failed: dict[tuple[int, int], int] = {}
    bound = least(0, start)
    while True:
        beyond, path = None, []
        stack = [(0, start, 0, _moves(code, 0, start))]
        while stack:
            i, state, spent, moves = stack[-1]
            for edit, cost, to, then in moves:
                total = spent + cost
                reach = max(total + least(to, then), total + failed.get((to, then), -1) + 1)
                if reach > bound:
                    beyond = reach if beyond is None else min(beyond, reach)
                    continue
                path.append(edit)
                if to == n:
                    return "".join(path), then, bound
                stack.append((to, then, total, _moves(code, to, then)))
                break
            else:
                failed[i, state] = max(failed.get((i, state), -1), bound - spent)
                stack.pop()
                if path:
                    path.pop()
        bound = beyond


@lru_cache(1 << 12)
def crossing(code: str) -> tuple[tuple[int, ...], ...]:
    """Cheapest cost from each state before a block to each state behind it (or more than anything can cost)."""
    out, far = [], (len(code) + 4) * (DELETE + REROLE)
    for start in range(4):
        cost = [far] * 4
        cost[start] = 0
        for row in code:
            for _ in range(3):
                for state, then in enumerate(CHOSEN):
                    cost[then] = min(cost[then], cost[state] + INSERT)
            after = [c + DELETE for c in cost]
            if row != GONE:
                more = TRUNCATED if row.isupper() else 0
                for state in range(4):
                    kept = FOLLOWS.get((state, row.lower()))
                    if kept is not None:
                        after[kept] = min(after[kept], cost[state] + KEEP + more)
                    after[CHOSEN[state]] = min(after[CHOSEN[state]], cost[state] + REROLE + more)
            cost = after
        out.append(tuple(min(c, far) for c in cost))
    return tuple(out)


def _short(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of conversations of one block."""
    for frame in frames:
        edits = []
        for code in frame.code:
            audit, state, _ = cheapest(code)
            edits.append(audit + "I" * (AT_END[state] // INSERT))
        yield frame[["conv", "block"]].assign(edits=edits)


def _crossings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.assign(costs=[[c for row in crossing(code) for c in row] for code in frame.code])


def _behind(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From the last block of each conversation to its first: what is still to come behind a block."""
    conv, after = None, AT_END
    for frame in frames:
        out = []
        for c, costs in zip(frame.conv.tolist(), frame.costs):
            if c != conv:
                conv, after = c, AT_END
            out.append(list(after))
            costs = [int(x) for x in costs]
            after = tuple(min(costs[4 * s + t] + after[t] for t in range(4)) for s in range(4))
        yield frame[["conv", "block", "code"]].assign(after=out)


def _from_each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits of a block from each state before it, and the state each ends in."""
    for frame in frames:
        found = []
        for code, after in zip(frame.code, frame.after):
            low = min(int(a) for a in after)
            found.append([cheapest(code, tuple(int(a) - low for a in after), s) for s in range(4)])
        yield frame[["conv", "block"]].assign(
            edits=[[f[0] for f in row] for row in found], ends=[[f[1] for f in row] for row in found], code=frame.code)


def _picked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From the first block on: the edits from the state the block before ended in."""
    conv, state = None, START
    for frame in frames:
        out = []
        for c, edits, ends, last in zip(frame.conv.tolist(), frame.edits, frame.ends, frame["last"]):
            if c != conv:
                conv, state = c, START
            audit, state = edits[state], int(ends[state])
            out.append(audit + "I" * (AT_END[state] // INSERT) if last else audit)
        yield frame[["conv", "block"]].assign(edits=out)


def judged(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, sha, blank, open`` and ``text``: rows with what can be told of each by itself."""
    rows = rows.select(
        named("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    end = F.rtrim("text", F.lit(SPACES))
    return rows.select("conv", "turn", "role", F.sha2("text", 256).alias("sha"), "text",
                       (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("open"))


def _faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv, pos, turn, role, fault``: faults are blank, duplicate, truncated or null."""
    slim = rows.select("conv", "turn", "role", "sha", "blank", "open", F.rand(7).alias("any"))
    placed = scratch.write(positions(slim, ["conv"], ["turn", "role", "sha", "any"], "pos"), "placed")
    first = placed.groupBy("conv", "role", "sha").agg(F.min("pos").alias("pos")).select("conv", "pos", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("open"), "truncated")
    return placed.join(first, ["conv", "pos"], "left").select("conv", "pos", "turn", "role", fault.alias("fault"))


def _edits(faults: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv, block, edits``."""
    initial = F.left("role", F.lit(1))
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(kind)).otherwise(kind)
    block = F.floor(F.col("pos") / BLOCK).cast("long")
    rows = faults.select("conv", block.alias("block"), "pos", code.alias("code")).groupBy("conv", "block").agg(  # at most BLOCK rows
        F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    codes = scratch.write(rows.select("conv", "block", F.array_join("rows.code", "").alias("code")), "codes")
    ends = codes.groupBy("conv").agg(F.max("block").alias("end")).filter("end > 0")
    schema = "conv long, block long, edits string"
    short = codes.join(ends, "conv", "left_anti").select("conv", "block", "code").mapInPandas(_short, schema)
    spans = codes.join(ends, "conv").select("conv", "block", "code", (F.col("block") == F.col("end")).alias("last"))
    costs = spans.select("conv", "block", "code").mapInPandas(_crossings, "conv long, block long, code string, costs array<long>")
    behind = costs.repartition("conv").sortWithinPartitions("conv", F.desc("block")).mapInPandas(
        _behind, "conv long, block long, code string, after array<long>")
    # Dealt out again: the search is the work, and one conversation may have most of the blocks.
    each = behind.repartition("conv", "block").mapInPandas(
        _from_each, "conv long, block long, edits array<string>, ends array<long>, code string").drop("code")
    joined = each.join(spans.select("conv", "block", "last"), ["conv", "block"])
    picked = joined.repartition("conv").sortWithinPartitions("conv", "block").mapInPandas(_picked, schema)
    return scratch.write(short.union(picked), "edits")


class _Walk:
    """The rows of one conversation under its edits, one after another."""

    def __init__(self, conv: int, stats: tuple):
        self.conv, self.stats, self.edits = conv, stats, []
        self.audit, self.at, self.state = None, 0, START
        self.cost = self.illegal = 0
        self.before, self.hash, self.some = None, hashlib.sha256(), False

    def _emit(self, role: str, text: str, edit: str) -> tuple[str, str, str]:
        self.hash.update(f"{'\n' * self.some}{role}:{text}".encode())
        self.some = True
        return role, text, edit

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        if self.audit is None:
            self.audit = "".join(self.edits)
            self.edits = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.cost, self.state = self.at + 1, self.cost + INSERT, CHOSEN[self.state]
            yield self._emit(NAMES[self.state], "", "I")

    def row(self, role: str, text: str, is_open: bool) -> Iterator[tuple[str, str, str]]:
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED if is_open else 0
        if edit == "K":
            self.state = FOLLOWS[self.state, initial]
        else:
            self.cost, self.state = self.cost + REROLE, CHOSEN[self.state]
            role = NAMES[self.state]
        yield self._emit(role, text, edit)

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()

    def digest(self) -> tuple:
        return (self.conv, *self.stats, self.illegal, self.cost, self.audit, self.hash.hexdigest())


_STATS = ["gaps", "blank", "duplicate", "truncated"]
_DIGEST = [*_STATS, "illegal", "cost", "audit", "repaired_sha256"]


def _walked(whole: bool):
    """Heads, edits and rows of conversations in order, to their repaired turns or to a digest of each."""
    names = ["conv", "place", "role", "text", "edit"] if whole else ["conv", *_DIGEST]

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, place = None, 0
        out: list[tuple] = []

        def keep(turns: Iterator[tuple[str, str, str]]) -> None:
            nonlocal place
            for turn in turns:
                if whole:
                    out.append((at.conv, place, *turn))
                place += 1

        def close() -> None:
            if at is not None:
                keep(at.end())
                if not whole:
                    out.append(at.digest())

        for frame in frames:
            columns = [frame[c].tolist() for c in ("conv", "kind", "role", "text", "open", *_STATS)]
            for conv, kind, role, text, is_open, *stats in zip(*columns):
                if kind == 0:
                    close()
                    at, place = _Walk(conv, tuple(int(s) for s in stats)), 0
                elif kind == 1:
                    at.edits.append(text)
                else:
                    keep(at.row(role, text, bool(is_open)))
            yield pd.DataFrame(out, columns=names)
            out.clear()
        close()
        yield pd.DataFrame(out, columns=names)

    return walk


def _laid_out(rows: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """For each conversation its head (0) with counts, its edits by block (1) and its rows (2), in one partition and in order."""
    texts = judged(rows)
    faults = scratch.write(_faults(texts, scratch), "faults")
    edits = _edits(faults, scratch)
    counted = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    stats = faults.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *map(counted, _STATS[1:]))
    none = {c: F.lit(0).cast("long").alias(c) for c in _STATS}
    absent = [F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("open")]
    place = [F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("sha")]
    heads = ids.select(named("conv_id").alias("conv")).distinct().join(stats, "conv", "left").select(
        "conv", F.lit(0).alias("kind"), *place, *absent, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _STATS])
    audits = edits.select("conv", F.lit(1).alias("kind"), F.col("block").alias("turn"), place[1], absent[0], F.col("edits").alias("text"), absent[2], *none.values())
    bodies = texts.select("conv", F.lit(2).alias("kind"), "turn", "sha", "role", "text", "open", *none.values())
    return heads.unionByName(audits).unionByName(bodies).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "sha")


def repairs(rows: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation of ``ids``."""
    schema = ", ".join(["conv long", *[f"{c} {'string' if c in _DIGEST[-2:] else 'long'}" for c in _DIGEST]])
    made = _laid_out(rows, ids, scratch).mapInPandas(_walked(False), schema)
    return made.withColumnRenamed("conv", "conv_id").withColumn("conv_id", unnamed("conv_id"))


def repaired_turns(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, place, role, text, edit``: the turns of the repaired conversations, each with the edit (I, K, R) that made it."""
    made = _laid_out(rows, rows, scratch).mapInPandas(_walked(True), "conv long, place long, role string, text string, edit string")
    return made.withColumnRenamed("conv", "conv_id").withColumn("conv_id", unnamed("conv_id"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of conversations with a fifth of the rows damaged, in ways told by a checksum of (conv_id, turn)."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")), F.lit(20))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), way.alias("way"))
    role = F.when(F.col("way") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("way") == 0, 0).when(F.col("way") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")
