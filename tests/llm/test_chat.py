import itertools

import numpy as np
import pytest

from plaza.llm import chat
from plaza.llm.queries import op6_chat_formatting


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'a' AS marker", "1 AS block", "2 AS part")


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3], r[4]))


def conversations(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        roles = (["system"] if c % 5 == 0 else []) + ["user", "assistant"] * int(rng.integers(1, 4))
        for t, r in enumerate(roles):
            text = {"system": "You are helpful.", "user": "what is this " * int(rng.integers(1, 3)) + "?", "assistant": "It is a thing. " * int(rng.integers(8, 20))}[r]
            rows.append((c, t, r, text))
    return rows


@pytest.mark.parametrize("text, roles", [
    ("User: hi\nAssistant: hello\nthere", ["user", "assistant"]), ("plain", [None]), ("Q: one?\nA: two", ["user", "assistant"]),
    ("<|im_start|>system\nbe good<|im_end|>\n<|im_start|>user\nhi<|im_end|>", ["system", "user"]), ("### Human: x\n### AI: y", ["user", "assistant"]),
    ("**Bot:** z", ["assistant"]), ("note: no speaker\nanother: line", [None]), ("", [None]), ("a quarter: of it", [None]), ("intro\nUser: x", [None, "user"]),
])
def test_markers(text, roles):
    got = chat.segments(None, text)
    assert [chat.ROLES[m] if m >= 0 else None for m, *_ in got] == roles


def test_text_of_segments():
    assert [s[3] for s in chat.segments("user", "User: hi\nAssistant: hello\nthere<|im_end|>\n")] == ["hi", "hello\nthere"]


def test_viterbi_and_matrices_equal_all_paths():
    rng = np.random.default_rng(2)
    model = chat.Hmm(rng.random(4) * 9, rng.random((4, 4)) * 9, [rng.random((4, v)) * 9 for v in chat.FEATURES])
    emitted = chat._whole(np.log(rng.random((6, 4))))

    def score(path):
        return model.start[path[0]] + emitted[0, path[0]] + sum(model.step[a, b] + emitted[t + 1, b] for t, (a, b) in enumerate(zip(path, path[1:])))

    best = max(itertools.product(range(4), repeat=6), key=score)
    assert tuple(model.viterbi(emitted)) == best
    import pandas as pd
    parts = pd.DataFrame([(b, 0, 1, model.matrix(emitted[lo:hi]).ravel()) for b, (lo, hi) in enumerate([(0, 2), (2, 3), (3, 6)])], columns=["block", "run", "conv_id", "best"])
    border = chat._borders(parts)
    walked = np.concatenate([model.viterbi(emitted[lo:hi], e, x) for (lo, hi), e, x in zip([(0, 2), (2, 3), (3, 6)], border.entry, border.exit)])
    assert tuple(walked) == best


def test_masked_roles_are_recovered(spark, scratch):
    rows = conversations(150)
    masked = [(c, t, r if (7 * c + t) % 4 else None, x) for c, t, r, x in rows]
    got = found(chat.turns(table(spark, masked), scratch))
    right = [g[3] == r for g, (c, t, r, x) in zip(got, rows)]
    assert len(got) == len(rows) and sum(right) > 0.97 * len(right)
    assert got[0][4] == "<|system|>\nYou are helpful.\n<|end|>"


@pytest.mark.parametrize("rows", [conversations(60), [(1, i, ["user", None, "assistant"][i % 3], f"turn {i}?") for i in range(150)]])
def test_blocks_change_nothing(spark, scratch, monkeypatch, rows):
    masked = [(c, t, r if (3 * c + t) % 4 else None, x) for c, t, r, x in rows]
    whole = found(chat.turns(table(spark, masked), scratch))
    monkeypatch.setattr(chat, "ROWS_PER_BLOCK", 13)
    from plaza.llm.common import Scratch
    assert [r[:4] for r in found(chat.turns(table(spark, masked), Scratch(spark, "blocks")))] == [r[:4] for r in whole]


def test_awkward_rows(spark, scratch):
    rows = [(None, None, None, None), (None, 1, "user", "x"), (1, None, "USER ", ""), (1, 2, "nobody", "User: a\nAssistant: b <|user|> c"),
            (1, 2, "nobody", "User: a\nAssistant: b <|user|> c"), (2, 0, "assistant", "long " * 50_000), (3, 0, "tool", "{}")]
    got = found(chat.turns(table(spark, rows), scratch))
    assert len(got) == 9
    assert [r[3] for r in got if r[:2] == (1, 2)] == ["user", "user", "assistant", "assistant"]
    assert [r[4] for r in got if r[:3] == (1, 2, 1)][0] == "<|assistant|>\nb < |user|> c\n<|end|>"


def test_empty_table(spark, scratch):
    assert found(chat.turns(table(spark, []), scratch)) == []


def test_given_roles_of_the_table_stand(spark, sf):
    got = {(r["conv_id"], r["turn"]): r["role"] for r in op6_chat_formatting(spark, sf).collect()}
    want = {(r["conv_id"], r["turn"]): r["role"] for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    assert got == want
