import re

import numpy as np
import pytest

from plaza.llm import minhash, shingles
from plaza.llm.grouping import components, forest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_set(text, size):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def expected(rows, size, percent):
    sets = {}
    for doc, text, *_ in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(word_set(text, size))
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted(((d, len(word_set(t, size)), None if d is None else find(d), d is None or find(d) == d) for d, t, *_ in rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_awkward_rows(documents, awkward, scratch):
    assert found(minhash.near_groups(documents(awkward), scratch, 3, 85)) == expected(awkward, 3, 85)


def near_rows(n, seed):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(n):
        words = list(base) if i % 3 else [f"v{x}" for x in rng.integers(0, 50, rng.integers(0, 40))]
        for _ in range(rng.integers(0, 9)):
            if words:
                words[rng.integers(len(words))] = f"n{rng.integers(10**6)}"
        rows.append((int(i), " ".join(words).title() if i % 2 else "\t".join(words), "en"))
    return rows


@pytest.mark.parametrize("size, percent, block", [(3, 85, 2000), (5, 80, 2000), (3, 85, 25)])
def test_chains_and_a_large_family(documents, scratch, monkeypatch, size, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows(150, size)
    assert found(minhash.near_groups(documents(rows), scratch, size, percent)) == expected(rows, size, percent)


def test_empty_table(documents, scratch):
    assert found(minhash.near_groups(documents([]), scratch, 3, 85)) == []


def test_shingles_equal_where_words_are_equal():
    texts = ["The quick brown fox", "the\tQUICK  brown\nfox", "the quick brown", "a", "A", "", " ", "b"]
    sets = [s.tolist() for s in shingles.shingle_sets([t.encode() for t in texts], 3)]
    assert sets[0] == sets[1] and len(sets[0]) == 2 and set(sets[2]) < set(sets[0])
    assert sets[3] == sets[4] != sets[7] and sets[5] == sets[6] == []


def test_signatures_estimate_with_less_variance_than_plain_minhash():
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(200):
        both = rng.integers(1, 2**63, 40, dtype=np.uint64)
        a = np.unique(np.concatenate([both, rng.integers(1, 2**63, 10, dtype=np.uint64)]))
        b = np.unique(np.concatenate([both, rng.integers(1, 2**63, 10, dtype=np.uint64)]))
        s = shingles.super_minhash([a, b], 128)
        errors.append((s[0] == s[1]).mean() - 40 / 60)
    assert abs(np.mean(errors)) < 0.01 and np.var(errors) < 0.8 * (2 / 3) * (1 / 3) / 128


def test_every_rank_is_used_once_by_a_lone_element():
    s = shingles.super_minhash([np.array([7], dtype=np.uint64)], 64)[0]
    assert sorted(np.floor(s).astype(int)) == list(range(64))


def test_signature_does_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(1, 2**63, n, dtype=np.uint64)) for n in (1, 3, 50, 700, 2000)]
    together = shingles.super_minhash(sets, 128)
    for s, row in zip(sets, together):
        assert (shingles.super_minhash([s], 128)[0] == row).all()


def test_components(spark, scratch):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(300, 200), (200, 250), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), scratch, "c").collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {200: 200, 250: 200, 300: 200}
    assert got == want


def test_forest_reaches_all():
    links = forest(10, lambda i, rest: (rest - i) % 3 == 0)
    assert len(links) == 7
