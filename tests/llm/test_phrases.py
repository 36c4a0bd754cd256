import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from plaza.llm import phrases
from plaza.llm.phrases import Trie, _tight


def expected(rows, least=10, longest=3, top=2000):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            for m in range(1, longest + 1):
                counts[lang or "und"].update(tuple(ws[i:i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= 50 * a for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        total = sum(n for p, n in f.items() if len(p) == 1)
        out += [(lang, rank, name.decode(), -a, l, r, total, -score) for rank, (score, a, name, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made_up(seed, n=60, words=12):
    draw = random.Random(seed)
    pool = ["New", "york", "City", "of", "the", "É", "漢字", "don't", "x-y", *[f"w{i}" for i in range(words)]]
    body = lambda: "".join(draw.choice(pool) + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"]) for _ in range(draw.randrange(120)))
    return [(i, draw.choice(["", "new york city ", "A b A b "]) * draw.randrange(3) + body(), draw.choice(["en", "en", "de", None])) for i in range(n)]


@given(st.lists(st.tuples(*[st.integers(1, 5000)] * 3), min_size=1, max_size=60), st.lists(st.integers(0, 5000), max_size=40))
@settings(max_examples=200, deadline=None)
def test_trie_finds_phrases_and_nothing_else(rows, other):
    rows = sorted(set(rows))
    trie = Trie.of([np.array(c, dtype=np.int64) for c in zip(*rows)], 0)
    codes = np.array([*other, *[w for r in rows[::2] for w in r], 0], dtype=np.int32)
    want = [(i, rows.index(t)) for i in range(len(codes) - 2) if (t := tuple(codes[i:i + 3].tolist())) in set(rows)]
    at, leaf = trie.walk(codes)
    assert list(zip(at.tolist(), leaf.tolist())) == want


def test_trie_is_tight():
    draw = np.random.default_rng(3)
    pairs = np.unique((draw.zipf(1.3, 100_000) % 30_000 + 1) << 31 | (draw.zipf(1.3, 100_000) % 30_000 + 1))
    trie = Trie.of([pairs >> 31, pairs & (1 << 31) - 1], 0)
    assert len(trie.check) < 3 * len(pairs) + 2 * 30_000


def test_rare_words_part_and_go():
    codes = np.array([0, 1, 0, 2, 3, 0, 0, 4, 5, 6, 0, 7, 0], np.int32)
    assert _tight(codes).tolist() == [2, 3, 0, 4, 5, 6, 0]


def test_awkward_rows(documents, awkward, scratch):
    rows = [*awkward, *made_up(1), (70, "again " * 30_000, "en"), (71, "one two " * 9, "fr"), (72, "One  two\tone two", "fr")]
    assert found(phrases.mine(documents(rows), scratch)) == expected(rows)


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths_and_limits(documents, scratch, longest):
    rows = made_up(2, words=4)
    assert found(phrases.mine(documents(rows), scratch, least=4, longest=longest, top=30)) == expected(rows, 4, longest, 30)
    assert found(phrases.mine(documents(rows), scratch_of(scratch), least=4, longest=longest, top=None)) == expected(rows, 4, longest, None)


def scratch_of(scratch):
    return phrases.Scratch(scratch.spark, "again")


def test_parts_slices_and_flushes(documents, scratch, monkeypatch):
    """Several parts of the vocabulary and of the candidates. (Slices of texts are cut by the driver's own tests below.)"""
    rows = made_up(3, 80)
    monkeypatch.setattr(phrases, "PART_WORDS", 7)
    monkeypatch.setattr(phrases, "PART", 20)
    assert found(phrases.mine(documents(rows).repartition(3), scratch, least=3)) == expected(rows, 3)


def test_counts_are_sent_packed(documents, scratch, monkeypatch):
    """A task sends a few rows, however many phrases it has met: counts are packed by owner."""
    written, write = {}, scratch.write

    def noted(df, name):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(scratch, "write", noted)
    monkeypatch.setattr(phrases, "pieces_of", lambda rows, each, least=16: 2)
    rows = [(i, " ".join(f"a{j} b{j} c{j}" for j in range(200)), "en") for i in range(12)]
    assert found(phrases.mine(documents(rows).repartition(3), scratch)) == expected(rows)
    passed = [df.collect() for name, df in written.items() if name.startswith("passed")]
    assert len(passed) == 2 and all(len(got) <= 4 * 4 for got in passed)
    assert [sum(r["size"] for r in got if r["counted"]) >= 598 for got in passed] == [True, True]


def test_slices_do_not_part_phrases(monkeypatch):
    text = " ".join(f"word{i}," if i % 7 == 0 else f"Word{i}\t" for i in range(500)).encode()
    whole = [t for some in phrases.tokens(text) for t in some]
    monkeypatch.setattr(phrases, "SLICE", 16)
    cut = list(phrases.tokens(text))
    assert len(cut) > 50 and [t for some in cut for t in some] == whole


def test_empty_tables(documents, scratch):
    assert found(phrases.mine(documents([]), scratch)) == []
    assert found(phrases.mine(documents([(1, None, None), (2, "few words", "en")]), scratch_of(scratch))) == []
