import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plaza.llm import langid

WORDS = {"en": "the and of this that with from would there people".split(), "de": "der die und nicht ist eine schön über wird straße".split(),
         "ru": "это что как для они если только уже когда может".split()}


def rows_of(n, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(rng.choice(WORDS[lang], rng.integers(3, 40))), lang) for i in range(n) for lang in [list(WORDS)[i % 3]]]


def judged(docs):
    return langid.predicted(docs, langid.train(docs)).select("row.doc_id", "row.lang", "lang_pred", "score", "accepted").collect()


def test_held_out_rows_are_recognised(documents):
    got = judged(documents(rows_of(300)))
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert held and all(r["lang_pred"] == r["lang"] and r["accepted"] and 0 < r["score"] <= 1 for r in held)


def test_held_out_rows_teach_nothing(documents):
    rows = [r for r in rows_of(200) if r[2] != "ru" or zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert {r["lang_pred"] for r in judged(documents(rows))} == {"en", "de"}


def test_awkward_rows(documents, awkward):
    got = judged(documents(rows_of(90) + [(i and i + 1000, t, None) for i, t, _ in awkward]))
    by_text = {i: t for i, t, _ in awkward}
    for r in got[90:]:
        text = by_text[r["doc_id"] and r["doc_id"] - 1000]
    und = [r for r in got if r["lang_pred"] == "und"]
    assert len(got) == 90 + len(awkward) and all(r["score"] == 0 and not r["accepted"] for r in und)
    assert {r["doc_id"] for r in und} >= {1003, 1004, 1005, 1006, 1013} and 1007 not in {r["doc_id"] for r in und}


def test_nothing_to_learn_from(documents, awkward):
    unlabelled = [(i, t, None) for i, t, _ in awkward]
    assert {(r["lang_pred"], r["score"], r["accepted"]) for r in judged(documents(unlabelled))} == {("und", 0.0, False)}
    assert judged(documents([])) == []


def test_held_out_rule(documents, awkward):
    for r in documents(awkward).select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect():
        assert r["h"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1)


def brute(texts, order):
    """Interpolated Kneser-Ney with dictionaries, for one language: a function of an n-gram."""
    from collections import Counter

    def grams(text):
        codes, starts = langid.symbols([text])
        c = codes.tolist()
        return [tuple([0] * max(0, order - 1 - i) + c[max(0, i - order + 1):i + 1]) for i in range(1, len(c))]

    levels = {order: Counter(g for t in texts for g in grams(t))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    letters = max(2, len({g for g in levels[1]}))

    def p(g):
        if not g:
            return 1 / letters
        own = levels[len(g)]
        once, twice = sum(v == 1 for v in own.values()), sum(v == 2 for v in own.values())
        d = once / (once + 2 * twice) if once and twice else 0.75
        same = [v for h, v in own.items() if h[:-1] == g[:-1]]
        if not same:
            return p(g[1:])
        return max(own[g] - d, 0) / sum(same) + d * len(same) / sum(same) * p(g[1:])

    return p, grams


def test_probabilities_equal_brute_force(documents):
    rows = [(i, t, "en") for i, (_, t, lang) in enumerate(rows_of(60)) if lang == "en"]
    learned = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    model = langid.train(documents(rows))
    p, grams = brute(learned, langid.ORDER)
    for text in ["the people of that zebra", "xyz", "there"]:
        total, size = langid.entropies(model, [text])
        want = -sum(np.log(p(g)) for g in grams(text))
        assert size[0] == len(grams(text)) and total[0, 0] == pytest.approx(want, rel=1e-4)


def test_long_text_in_slices(documents, monkeypatch):

    model = langid.train(documents(rows_of(60)))
    text = " ".join(WORDS["de"] * 3000)
    whole = langid.entropies(model, [text])
    monkeypatch.setattr(langid, "SLICE_CHARS", 10_000)
    (_, total, size), = langid._sums(model, iter([pd.DataFrame({"text": [text]})]))
    assert total == pytest.approx(whole[0], rel=0.01)


def letters_of(seed, rows, size, alphabet=3000):
    rng = np.random.default_rng(seed)
    return ["".join(map(chr, rng.integers(0x4E00, 0x4E00 + alphabet, size))) for _ in range(rows)]


def test_unseen_grams_back_off(documents):
    model = langid.train(documents([(i, t, "zh") for i, t in enumerate(letters_of(1, 300, 1000))]))
    gram, _ = langid.grams_of(*langid.symbols(letters_of(2, 5, 1000)))
    unseen = gram[~np.isin(gram >> np.uint64(16), model.contexts[3])]
    assert len(unseen) > 4000 and (langid.log_probabilities(model, unseen) == langid.log_probabilities(model, unseen, 3)).all()


def test_a_bounded_model_still_sums_to_one(documents, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_GRAMS", 150)
    model = langid.train(documents(rows_of(300)))
    assert max(map(len, model.grams)) <= 150
    for prefix in ["the ", "tha", " qu", "und"]:
        codes = [ord(c) for c in prefix[-3:]]
        context = sum(c << (16 * (3 - k)) for k, c in enumerate(codes))
        grams = np.array([context + int(letter) for letter in model.grams[0]], dtype=np.uint64)
        assert np.exp(langid.log_probabilities(model, grams).astype(float)).sum(axis=0) == pytest.approx(1, rel=1e-3)


def test_foreign_and_garbled_text_is_rejected(documents):
    rng = np.random.default_rng(7)
    odd = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), 300)), "ที่เป็นและในการมีของได้ว่าจะ " * 10, letters_of(8, 1, 200)[0]]
    got = judged(documents(rows_of(300) + [(1000 + i, t, None) for i, t in enumerate(odd)]))
    assert [r["accepted"] for r in got if r["doc_id"] >= 1000] == [False] * 3 and all(r["accepted"] for r in got if r["doc_id"] < 1000)


def test_limits_are_those_of_each_language():

    model = langid.Model(["a", "b"], [], [], [], [], np.zeros(2, np.float32))
    sample = pd.DataFrame({"lang": ["a"] * 50 + ["b"] * 50, "total": [[100.0, 900.0]] * 50 + [[900.0, 300.0]] * 50, "size": 100})
    assert langid.calibrated(model, sample).most_entropy == pytest.approx([1.25, 3.75])


def test_slices_sum_up_to_the_whole(spark):
    """At the slice size as it is: words, white space and runs without any at the borders."""
    docs = spark.createDataFrame([(i, "the quick brown fox " * 5 if i % 2 else "le renard brun et vif " * 5, "en" if i % 2 else "fr") for i in range(60)],
                                 "doc_id long, text string, lang string")
    model = langid.train(docs)
    for text in ("the renard, brun 12 fox " * 60_000, "x" * 1_200_000, ("y" * 499_999 + "  ") * 3, " " * 600_000 + "fox " * 200_000):
        (_, total, size), = langid._sums(model, iter([pd.DataFrame({"text": [text]})]))
        whole, n = langid.entropies(model, [text])
        assert size.tolist() == n.tolist() and np.allclose(total, whole, rtol=1e-9)


def test_letters_above_the_first_plane_stay_apart():
    codes = lambda text: langid.symbols([text])[0].tolist()[1:]
    assert codes("\U00020041") != codes("a") and codes("\U00020041") != codes("A") and codes("\U00020000") != [0]
    assert codes("\U00020000")[0] >= langid.HIGH


def test_calibration_reads_all_rows(spark):
    """Exact limits, to the rarest row, and those of all for a language without a recognised row."""
    rng = np.random.default_rng(3)
    n = 9_000
    truth = rng.integers(0, 2, n)
    total = rng.uniform(40, 60, (n, 3)) + 25.0
    total[np.arange(n), truth] -= 25.0
    size = np.full(n, 10)
    total[7] = [90.0, 900.0, 900.0] if truth[7] == 0 else [900.0, 90.0, 900.0]  # one row of high entropy
    own = langid.Model(["de", "en", "ru"], [], [], [], [], np.zeros(3, np.float32))
    rows = [(int(t), [float(x) for x in v], int(k)) for t, v, k in zip(truth, total, size)]
    made = langid.calibrated_on(own, spark.createDataFrame(rows, "lang int, total array<double>, size long").repartition(5))
    frame = pd.DataFrame({"lang": np.array(["de", "en", "ru"])[truth], "total": list(total), "size": size})
    want = langid.calibrated(langid.Model(["de", "en", "ru"], [], [], [], [], np.zeros(3, np.float32)), frame)
    assert made.temperature == want.temperature
    assert made.least_score == pytest.approx(want.least_score) and made.most_entropy == pytest.approx(want.most_entropy)
