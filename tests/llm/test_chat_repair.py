import hashlib
import itertools
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from plaza.llm import chat_repair
from plaza.llm.chat_repair import AT_END, START, cheapest, crossing

BLANKS = " \t\n\x0b\x0c\r"


def least_path(rows):
    """By trying all: cost, edits and repaired turns of (role, text, fault) rows."""
    ways = {"": (0, "", ())}

    def grown(ways):
        """Ways by last initial, after up to three insertions."""
        out = dict(ways)
        for _ in range(3):
            for last, (cost, audit, made) in list(out.items()):
                role = "assistant" if last == "u" else "user"
                way = (cost + 2, audit + "I", (*made, (role, "")))
                if role[0] not in out or way < out[role[0]]:
                    out[role[0]] = way
        return out

    for role, text, fault in rows:
        after = {}

        def reach(last, way):
            if last not in after or way < after[last]:
                after[last] = way

        for last, (cost, audit, made) in grown(ways).items():
            reach(last, (cost + 3, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            more = int(fault == "truncated")
            if (last + role[:1] in ("su", "ua", "au")) if last else role[:1] in ("s", "u"):
                reach(role[:1], (cost + more, audit + "K", (*made, (role, text))))
            new = "assistant" if last == "u" else "user"
            reach(new[0], (cost + 2 + more, audit + "R", (*made, (new, text))))
        ways = after
    ends = [w for last, w in grown(ways).items() if last in ("", "a")]
    return min(ends, key=lambda w: (w[0], w[1]))


def expected(rows):
    """The damaged rows' counts and repair, by conversation."""
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        say = lambda x: " " if x is None else str(x)
        way = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        grouped[conv] += [] if way == 0 else [(turn, "user" if way == 4 else role, {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(way, text))] * (2 if way == 3 else 1)
    out = []
    for conv, turns in grouped.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(t[2].encode()).hexdigest()))
        seen, judged = set(), []
        for turn, role, text in turns:
            body = text.rstrip(BLANKS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        count = lambda f: sum(j[2] == f for j in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, audit, made = least_path(judged) if judged else (0, "", ())
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' AS pos", "1 AS kind", "'y' AS conv", "2 AS block")


ROLES = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}


def as_rows(code):
    return [("user", "", "blank") if c == "-" else (ROLES[c.lower()], "t", "truncated" if c.isupper() else "") for c in code]


@given(st.text("suaxSUAX-", max_size=9).filter(bool))
@settings(max_examples=400, deadline=None)
def test_search_finds_the_least_path(code):
    cost, audit, _ = least_path(as_rows(code))
    edits, state, spent = cheapest(code)
    assert (spent, edits + "I" * (AT_END[state] // 2)) == (cost, audit)


@given(st.lists(st.text("suaxSUAX-", min_size=1, max_size=5), min_size=2, max_size=4))
@settings(max_examples=200, deadline=None)
def test_blocks_make_the_same_path(blocks):
    after = [AT_END]
    for code in reversed(blocks):
        after.append(tuple(min(crossing(code)[s][t] + after[-1][t] for t in range(4)) for s in range(4)))
    state, audit = START, ""
    for code, behind in zip(blocks, after[-2::-1]):
        edits, state, _ = cheapest(code, behind, state)
        audit += edits
    audit += "I" * (AT_END[state] // 2)
    cost, wanted, _ = least_path(as_rows("".join(blocks)))
    assert (after[-1][START], audit) == (cost, wanted)


def made_up(seed, n, longest):
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(draw.randrange(1, longest)):
            role = draw.choice(["user", "assistant"]) if draw.random() < 0.3 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn if draw.random() < 0.95 else None, "system" if turn == 0 and draw.random() < 0.3 else role,
                         draw.choice(["Yes.", "No", "What?", f"Text {turn}.", f"Text {conv}"])))
    return rows


AWKWARD = [
    (None, 1, "user", "Hi."), (None, None, None, None), (1, None, "user", "a."), (1, None, "assistant", "b."), (2, 0, None, "Text."), (3, 0, "", "Text."),
    (4, 0, "User", "Text."), (5, 5, "user", " \n\t"), (6, 1, "user", "same."), (6, 1, "user", "same."), (6, 1, "user", "other."), (7, 0, "system", "Only."),
    (8, 0, "user", "x. " * 50_000), (9, -3, "user", "é? "), (9, 4, "assistant", "ok!\r\n"), (10, 0, "system", "a."), (10, 1, "system", "b."),
    *[(100 + i, 0, "user", "One.") for i in range(40)],  # some of these are dropped whole
]


def test_awkward_rows(spark, scratch):
    made = chat_repair.repairs(chat_repair.damaged(table(spark, AWKWARD)), table(spark, AWKWARD), scratch)
    assert found(made) == expected(AWKWARD)
    assert any(r[7] == "" and r[6] == 0 for r in expected(AWKWARD))


def test_many_conversations(spark, scratch):
    rows = made_up(3, 60, 12)
    made = chat_repair.repairs(chat_repair.damaged(table(spark, rows).repartition(5)), table(spark, rows), scratch)
    assert found(made) == expected(rows)


def test_a_conversation_of_many_blocks(spark, scratch):
    """One conversation with most rows, over many blocks and partitions."""
    rows = made_up(4, 10, 6) + [(99, i, ["user", "assistant", "assistant", "tool"][i * i % 4], f"Text {i % 400}{'.' * (i % 3 > 0)}") for i in range(3000)]
    made = chat_repair.repairs(chat_repair.damaged(table(spark, rows).repartition(6)), table(spark, rows), scratch)
    assert found(made) == expected(rows)


def test_empty_table(spark, scratch):
    assert found(chat_repair.repairs(chat_repair.damaged(table(spark, [])), table(spark, []), scratch)) == []


def test_turns_are_repaired(spark, scratch):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "user", ""), (2, 0, "system", "Be brief."), (2, 1, "user", "Q?")]
    made = chat_repair.repaired_turns(table(spark, rows), scratch).orderBy("conv_id", "place")
    assert [tuple(r) for r in made.collect()] == [
        (1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "Again.", "R"), (2, 0, "system", "Be brief.", "K"), (2, 1, "user", "Q?", "K"), (2, 2, "assistant", "", "I")]
