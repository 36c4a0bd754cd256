import hashlib

import numpy as np
import pytest

from plaza.llm import suffix_dedup as sd


def expected(rows):
    first = {}
    for doc, text, *_ in rows:
        raw, rank = (text or "").encode(), sd.LAST_ID if doc is None else doc
        for p in range(len(raw) - sd.LENGTH + 1):
            s = raw[p:p + sd.LENGTH]
            first[s] = min(first.get(s, rank), rank)
    out = []
    for doc, text, *_ in rows:
        raw, rank = (text or "").encode(), sd.LAST_ID if doc is None else doc
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - sd.LENGTH + 1):
            if first[raw[p:p + sd.LENGTH]] < rank:
                gone[p:p + sd.LENGTH] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.drop("kept").collect()), key=str)


def test_awkward_rows(documents, awkward, scratch):
    assert found(sd.without_repeats(documents(awkward), scratch)) == expected(awkward)


def mixed_rows(n, seed):
    """Texts of little variety with shared passages, copies, runs and bytes that are zero."""
    rng = np.random.default_rng(seed)
    words = ["the", "of", "tion", "er", "\x00", "é", "a" * 30, "\n"]
    passages = [" ".join(rng.choice(words, 30)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(words, rng.integers(1, 60)))]
        for _ in range(rng.integers(0, 4)):
            p = passages[rng.integers(len(passages))]
            cut = rng.integers(0, len(p) // 2)
            parts += [p[cut:], " ".join(rng.choice(words, rng.integers(0, 20)))]
        rows.append((int(rng.integers(0, 3 * n)), "".join(parts), "en"))
    rows += [(3 * n + i, rows[i][1], "en") for i in range(10)]
    return list({r[0]: r for r in rows}.values())


@pytest.mark.parametrize("seed", range(2))
def test_mixed_texts_in_many_slabs(documents, scratch, seed):
    rows = mixed_rows(120, seed)
    assert found(sd.without_repeats(documents(rows, extra=False).repartition(9), scratch)) == expected(rows)


def test_empty_table(documents, scratch):
    assert found(sd.without_repeats(documents([]), scratch)) == []


def test_kept_bytes(documents, scratch):
    passage = "This passage of well over fifty bytes stands in two documents, word for word."
    rows = [(5, "Before. " + passage + " After.", "en"), (2, passage, "en")]
    got = {r["doc_id"]: bytes(r["kept"]) for r in sd.without_repeats(documents(rows), scratch).collect()}
    assert got == {2: passage.encode(), 5: b"Before.  After."}


def suffixes(text):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        lcp.append(n)
    return order, lcp


@pytest.mark.parametrize("text", ["banana", "mississippi", "aaaaaa", "abcabcabxabca", "x"])
def test_interval_tree_holds_all_repeats(text):
    """Every substring that occurs twice is, with all its occurrences, one interval cut at its length."""
    order, lcp = suffixes(text)
    nodes = sd.lcp_intervals(lcp, 1)
    got = set()
    for depth, above, lo, hi in nodes.tolist():
        places = frozenset(order[lo:hi + 1])
        got |= {(text[order[lo]:order[lo] + n], places) for n in range(above + 1, depth + 1)}
    want = set()
    for n in range(1, len(text)):
        for s in {text[i:i + n] for i in range(len(text) - n + 1)}:
            places = frozenset(i for i in range(len(text)) if text.startswith(s, i))
            if len(places) > 1:
                want.add((s, places))
    assert got == want


def test_equal_strings_hold_equal_anchors():
    rng = np.random.default_rng(3)
    shared = rng.integers(97, 100, 50, dtype=np.uint8)
    a = np.concatenate([rng.integers(97, 100, 400, dtype=np.uint8), shared, rng.integers(97, 100, 90, dtype=np.uint8)])
    b = np.concatenate([rng.integers(97, 100, 77, dtype=np.uint8), shared, rng.integers(97, 100, 300, dtype=np.uint8)])
    at_a = {p - 400 for p in sd.anchors(a, np.array([len(a)]))[0] if 400 <= p <= 430}
    at_b = {p - 77 for p in sd.anchors(b, np.array([len(b)]))[0] if 77 <= p <= 107}
    assert at_a & at_b
