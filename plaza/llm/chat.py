"""Recovery of speakers by a hidden Markov model, and canonical turns.

Rows of a conversation are cut into segments at lines that begin with a speaker marker
(``User:``, ``### Assistant:``, ``<|im_start|>system`` and the like). The hidden states are the
roles. What is seen of a segment: the marker, the role column where it names a role, and
features of its lines (a question at the end, length, number of lines, code or lists).
Transitions, starts and features are counted over all segments whose role is given; markers and the role column are right with fixed probabilities. Viterbi finds the roles.

A conversation may hold most of the rows. Segments are therefore sorted by range into
blocks of bounded size. A block reduces its part of a conversation that goes on in other
blocks to a matrix (the best score from each state before it to each state at its end); the
matrices of a conversation, one per block, give the states at the borders, and the blocks
then walk their parts between fixed states. The border table has at most two rows per
block and may be broadcast.

Contract
- Order is by ``turn``, then place in the row; rows that share a turn come by their text, equal rows
  in any order (they are the same). Null turns come first, null texts count as empty; a null
  ``conv_id`` is a conversation like others. A segment without any text is still a turn.
- Every row gives one turn at least. Ties are settled by a hash of the place. An empty table gives
  no rows; without any known role the counts are even. Only ``conv_id``, ``turn``, ``role`` and
  ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from plaza.llm.common import Scratch, named, pieces_of, unnamed
from plaza.llm.grouping import in_runs
from plaza.llm.shingles import mixed

# Roles, the names they go by, and how often markers and the role column are right.
ROLES = ["system", "user", "assistant", "tool"]
NAMES = {
    "system": 0, "developer": 0, "instructions": 0,
    "user": 1, "human": 1, "customer": 1, "client": 1, "prompter": 1, "person": 1, "question": 1, "q": 1,
    "assistant": 2, "ai": 2, "bot": 2, "chatbot": 2, "gpt": 2, "chatgpt": 2, "model": 2, "agent": 2, "answer": 2, "a": 2,
    "tool": 3, "function": 3, "observation": 3,
}
COLUMN_RIGHT, MARKER_RIGHT = 0.999, 0.98
SCALE_BITS, TIE_BITS = 20, 20
ROWS_PER_BLOCK = 20_000

_LONG_NAMES = "|".join(n for n in NAMES if len(n) > 1)
MARKER = re.compile(
    rf"^[ \t]*(?:<\|im_start\|>[ \t]*(?P<im>{_LONG_NAMES})[ \t]*|<\|(?P<tag>{_LONG_NAMES})\|>[ \t]*"
    rf"|(?:#{{1,4}}[ \t]*|\*\*|\[)?(?P<name>{_LONG_NAMES}|(?-i:[QA]))(?:\*\*|\])?[ \t]*:(?:\*\*)?[ \t]*)", re.I | re.M)
END_MARK = re.compile(r"<\|im_end\|>\s*$")
LISTS = re.compile(r"^\s*(?:[-*•]|\d+[.)])\s|```|[{};]\s*$", re.M)
FEATURES = [2, 10, 4, 2]  # values of: question, length, lines, code or lists

_SEGMENT = "conv_id long, turn long, part int, marker int, given int, seen array<int>, text string"
_PLACED = "block int, run int, conv_id long, turn long, part int, marker int, given int, before int, seen array<int>, text string"


def role_of(name: str | None) -> int:
    return NAMES.get((name or "").strip().lower(), -1)


def line_features(text: str) -> list[int]:
    solid = text.strip()
    return [int(solid.endswith("?")), min(9, len(solid).bit_length()), min(3, solid.count("\n")), int(bool(LISTS.search(text)))]


def segments(role: str | None, text: str) -> list[tuple[int, int, list[int], str]]:
    """Marker, role of the column (-1: none), features and text of each segment of a row."""
    found = list(MARKER.finditer(text))
    given = role_of(role)
    out = []
    head = text[:found[0].start()] if found else text
    if not found or head.strip():
        out.append((-1, given, head))
    for m, following in zip(found, [*found[1:], None]):
        body = text[m.end():following.start() if following else len(text)]
        # The role column speaks for the row's first segment only.
        out.append((role_of(m["im"] or m["tag"] or m["name"]), given if not out else -1, body))
    return [(marker, g, line_features(body), END_MARK.sub("", body).strip()) for marker, g, body in out]


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for conv, turn, role, text in zip(frame.conv_id.tolist(), frame.turn.tolist(), frame.role.tolist(), frame.text.tolist()):
            out += [(conv, turn, k, *s) for k, s in enumerate(segments(role, text or ""))]
        yield pd.DataFrame(out, columns=["conv_id", "turn", "part", "marker", "given", "seen", "text"])


def _known(marker: int, given: int) -> int:
    return given if given >= 0 else marker


def _placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Number the block and the conversations in it; the role before each segment
    (-1: not known, -2: the segment is the first of its conversation in the block)."""
    block, run, last = TaskContext.get().partitionId(), -1, None
    before = -2
    for frame in frames:
        runs, befores = [], []
        for conv, marker, given in zip(frame.conv_id.tolist(), frame.marker.tolist(), frame.given.tolist()):
            if conv != last:
                run, last, before = run + 1, conv, -2
            runs.append(run)
            befores.append(before)
            before = _known(marker, given)
        frame["block"], frame["run"], frame["before"] = block, runs, befores
        yield frame[[c.split()[0] for c in _PLACED.split(", ")]]


def _whole(logs: np.ndarray) -> np.ndarray:
    """Log probabilities as whole numbers, so that sums do not depend on how blocks are cut."""
    return np.rint(logs * 2.0 ** SCALE_BITS).astype(np.int64) << TIE_BITS


class Hmm:
    """Log probabilities from counts (one imagined count each)."""

    def __init__(self, starts: np.ndarray, steps: np.ndarray, features: list[np.ndarray]):
        self.start = _whole(np.log((starts + 1) / (starts + 1).sum()))
        self.step = _whole(np.log((steps + 1) / (steps + 1).sum(axis=1, keepdims=True)))
        self.features = [np.log((f + 1) / (f + 1).sum(axis=1, keepdims=True)) for f in features]

    def emissions(self, marker: np.ndarray, given: np.ndarray, seen: np.ndarray, place: np.ndarray) -> np.ndarray:
        """A row per segment. The lowest bits settle ties by the segment's ``place`` and the role."""
        n = len(marker)
        out = np.zeros((n, len(ROLES)))
        for name, right in ((marker, MARKER_RIGHT), (given, COLUMN_RIGHT)):
            some = np.flatnonzero(name >= 0)
            out[some] += np.log((1 - right) / (len(ROLES) - 1))
            out[some, name[some]] += np.log(right) - np.log((1 - right) / (len(ROLES) - 1))
        for k, table in enumerate(self.features):
            out += table[:, seen[:, k]].T
        tie = mixed(mixed(place.astype(np.int64).view(np.uint64))[:, None] + np.arange(len(ROLES), dtype=np.uint64))
        return _whole(out) + (tie >> np.uint64(64 - TIE_BITS)).astype(np.int64)

    def viterbi(self, emitted: np.ndarray, entry: int = -1, exit: int = -1) -> np.ndarray:
        """Best states; ``entry`` is the state before (-1: the conversation begins here)."""
        n = len(emitted)
        score = emitted[0] + (self.start if entry < 0 else self.step[entry])
        back = np.zeros((n, len(ROLES)), dtype=np.int64)
        for t in range(1, n):
            ways = score[:, None] + self.step
            back[t] = ways.argmax(axis=0)
            score = ways.max(axis=0) + emitted[t]
            score -= score.max()
        out = np.zeros(n, dtype=np.int64)
        out[-1] = exit if exit >= 0 else score.argmax()
        for t in range(n - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out

    def matrix(self, emitted: np.ndarray) -> np.ndarray:
        """Best score from each state before the segments (last row: none, the beginning) to each at their end."""
        best = np.vstack([self.step, self.start[None, :]]) + emitted[0]
        for row in emitted[1:]:
            best = (best[:, :, None] + self.step[None]).max(axis=1) + row
            best -= best.max()
        return best


def _counts(placed: DataFrame) -> Hmm:
    """Counts of all segments with a known role; at most a few hundred numbers reach the driver."""
    known = F.when(F.col("given") >= 0, F.col("given")).otherwise(F.col("marker")).alias("role")
    rows = placed.select("block", "run", "conv_id", "before", "seen", known)
    n_roles = len(ROLES)
    starts, steps = np.zeros(n_roles), np.zeros((n_roles, n_roles))
    features = [np.zeros((n_roles, v)) for v in FEATURES]
    for r in rows.filter("role >= 0 AND before >= 0").groupBy("before", "role").count().collect():
        steps[r["before"], r["role"]] += r["count"]
    seen = rows.filter("role >= 0").select("role", F.posexplode("seen").alias("k", "v"))
    for r in seen.groupBy("role", "k", "v").count().collect():
        features[r["k"]][r["role"], r["v"]] += r["count"]
    # A conversation's first segment in a block starts it, unless the block before ends with it.
    # One row per block: the conversation and role it ends with, set beside the next block.
    last = F.max_by(F.struct("conv_id", known), F.struct("run", "turn", "part", F.xxhash64("text"))).alias("last")
    ends = placed.groupBy("block").agg(last).select(
        F.lead("block").over(Window.orderBy("block")).alias("block"), F.col("last.conv_id").alias("ended"), F.col("last.role").alias("ended_as"))
    firsts = rows.filter("before = -2").select("block", "run", "conv_id", "role").join(ends, "block", "left")
    goes_on = (F.col("run") == 0) & F.coalesce(F.col("ended") == F.col("conv_id"), F.lit(False))
    joined = firsts.filter("role >= 0").withColumn("from", F.when(goes_on, F.col("ended_as")).otherwise(-2))
    for r in joined.groupBy("from", "role").count().collect():
        if r["from"] == -2:
            starts[r["role"]] += r["count"]
        elif r["from"] >= 0:
            steps[r["from"], r["role"]] += r["count"]
    return Hmm(starts, steps, features)


def _arrays(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    seen = np.stack(frame.seen.to_numpy()) if len(frame) else np.zeros((0, len(FEATURES)), np.int64)
    return frame.marker.to_numpy().astype(np.int64), frame.given.to_numpy().astype(np.int64), seen.astype(np.int64), (
        frame.turn.to_numpy().astype(np.int64) * 1024 + frame.part.to_numpy())


def _matrices(model: Hmm):
    def work(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        emitted = model.emissions(*_arrays(frame))
        out = [(int(frame.block.iloc[lo]), int(frame.run.iloc[lo]), frame.conv_id.iloc[lo], model.matrix(emitted[lo:hi]).ravel())
               for lo, hi in zip(starts, [*starts[1:], len(frame)])]
        return pd.DataFrame(out, columns=["block", "run", "conv_id", "best"])

    return in_runs(["block", "run"], work)


def _borders(parts: pd.DataFrame) -> pd.DataFrame:
    """States before and at the end of each part of a conversation, from the matrices of its parts."""
    parts = parts.sort_values("block")
    n = len(ROLES)
    best = [np.asarray(b).reshape(n + 1, n) for b in parts.best]
    score, back = best[0][n], []
    for m in best[1:]:
        ways = score[:, None] + m[:n]
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
        score = score - score.max()
    ends = [int(score.argmax())]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    ends.reverse()
    return pd.DataFrame({"block": parts.block.to_numpy(), "run": parts.run.to_numpy(), "entry": [-1, *ends[:-1]], "exit": ends})


def _rendered(model: Hmm):
    def work(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        emitted = model.emissions(*_arrays(frame))
        states = np.concatenate([
            model.viterbi(emitted[lo:hi], _or_none(frame.entry.iloc[lo]), _or_none(frame.exit.iloc[lo]))
            for lo, hi in zip(starts, [*starts[1:], len(frame)])])
        out = frame[["conv_id", "turn", "part"]].copy()
        out["role"] = [ROLES[s] for s in states]
        out["rendered"] = [canonical(r, t) for r, t in zip(out.role, frame.text)]
        return out

    return in_runs(["block", "run"], work)


def _or_none(value) -> int:
    return -1 if value is None or value != value else int(value)


def canonical(role: str, text: str) -> str:
    """A turn with its marks; marks in the text are broken up."""
    return f"<|{role}|>\n{text.replace('<|', '< |')}\n<|end|>"


def turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, turn, part, role, rendered`` of every turn."""
    rows = conversations.select(named("conv_id"), named("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    cut = scratch.write(rows.mapInPandas(_cut, _SEGMENT), "cut")
    blocks = pieces_of(cut.count(), ROWS_PER_BLOCK, 1)
    # The random number only parts equal rows, which may stand in any order.
    keys = ["conv_id", "turn", "part", F.xxhash64("text"), F.rand(7)]
    ordered = cut.repartitionByRange(blocks, *keys).sortWithinPartitions(*keys[:4])
    placed = scratch.write(ordered.mapInPandas(_placed, _PLACED), "placed")
    model = _counts(placed)

    # Conversations that reach over a border: the first and the last of a block at most.
    span = placed.groupBy("conv_id").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).filter("lo < hi")
    edge = placed.groupBy("block").agg(F.max("run").alias("last"))
    across = placed.select("block", "run", "conv_id").distinct().join(edge, "block").filter("run = 0 OR run = last")
    across = scratch.write(across.join(span.withColumnRenamed("conv_id", "id"), F.col("conv_id") == F.col("id")).select("block", "run"), "across")
    parts = placed.join(F.broadcast(across), ["block", "run"], "left_semi").sortWithinPartitions("block", "run")
    matrices = _in_order(parts).mapInPandas(_matrices(model), "block int, run int, conv_id long, best array<long>")
    borders = scratch.write(matrices.groupBy("conv_id").applyInPandas(_borders, "block int, run int, entry int, exit int"), "borders")
    with_borders = placed.join(F.broadcast(borders), ["block", "run"], "left")
    made = _in_order(with_borders).mapInPandas(_rendered(model), "conv_id long, turn long, part int, role string, rendered string")
    return made.withColumns({"conv_id": unnamed("conv_id"), "turn": unnamed("turn")})


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows of a block together and in order (a block was one file, which may be read in several parts)."""
    return rows.repartition("block").sortWithinPartitions("block", "run", "turn", "part", F.xxhash64("text"))
