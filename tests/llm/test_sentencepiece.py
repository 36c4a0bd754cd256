import random

import pytest

from plaza.llm import sentencepiece as spm
from plaza.llm.queries import tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return spm.Pieces(PATH)


def all_paths(model, text):
    """Every segmentation of a text: score and lengths, best first, longest last piece first among equals."""
    out = []

    def go(at, score, lengths):
        if at == len(text):
            out.append((score, lengths))
        for k in range(1, min(model.longest, len(text) - at) + 1):
            i = model.ids.get(text[at:at + k])
            if i is not None:
                go(at + k, score + float(model.score[i]), [*lengths, k])
            elif k == 1:
                go(at + 1, score + model.unknown, [*lengths, 1])

    go(0, 0.0, [])
    return sorted(out, key=lambda p: (-p[0], [-k for k in reversed(p[1])]))


def words(seed, n, least=1, most=8):
    rng = random.Random(seed)
    return ["".join(rng.choice("▁theonrs漢") for _ in range(rng.randint(least, most))) for _ in range(n)]


def test_a_star_meets_the_best_paths_in_order(model):
    for unit in ["▁the", "▁▁▁a", "漢a字", "\n", *words(1, 80)]:
        want = all_paths(model, unit)[:5]
        got = model.n_best(unit, 5)
        assert [s for s, _ in got] == [s for s, _ in want] and got[0][1] == want[0][1]
        assert len({tuple(p) for _, p in got}) == len(got)


def test_paths_compare_as_tuples():
    rng = random.Random(5)
    made = [(spm._Path(None, 0), ())]
    for _ in range(400):
        path, taken = rng.choice(made[-20:])
        k = rng.randint(1, 3)
        if (*taken, -k) not in {t for _, t in made}:
            made.append((spm._Path(path, k), (*taken, -k)))
    for _ in range(5000):
        (p, s), (q, t) = rng.choice(made), rng.choice(made)
        assert p.lengths() == [-k for k in reversed(s)] and (p < q) == (s < t)


@pytest.mark.parametrize("letters", ["ABCabcxyz0189+/", "x", "漢字仮名交"])
def test_one_run_of_100_000_characters(model, letters):
    rng = random.Random(6)
    text = "".join(rng.choice(letters) for _ in range(100_000))
    (ids, total, scores, more), = model.encode([text], 3)
    assert model.decode(ids).decode() == text and scores[0] == total and scores == sorted(scores, reverse=True)
    assert len(scores) <= 3 and all(model.decode(__import__("numpy").array(x)).decode() == text and x != ids.tolist() for x in more)


def test_viterbi_and_gaps(model, monkeypatch):
    units = ["", "▁", *words(2, 80)]
    for long_unit in (48, 3):
        monkeypatch.setattr(spm, "LONG_UNIT", long_unit)
        ids, best, gap = model.viterbi(units)
        for u, i, b, g in zip(units, ids, best, gap):
            want = all_paths(model, u)
            assert i.tolist() == model.written(u, want[0][1]) and b == want[0][0]
            assert g == (want[0][0] - want[1][0] if len(want) > 1 else float("inf"))


def test_n_best_of_whole_texts(model):
    texts = [t.replace("▁", " ") for t in words(3, 25, 3, 9)] + ["th the", "on\non", "the the"]
    for text, (ids, total, scores, more) in zip(texts, model.encode(texts, 4)):
        want = all_paths(model, spm.BLANK + text.replace(" ", spm.BLANK))[:4]
        assert scores == [s for s, _ in want] and total == scores[0]
        assert len(more) == len(scores) - 1
        listed = [ids.tolist(), *more]
        assert len({tuple(x) for x in listed}) == len(listed) and all(model.decode(__import__("numpy").array(x)).decode() == text for x in listed)


ODD = ["Hello  world\n ab\tc é 漢字 😀", "", "a", " x ", "\n\n", "  ", "ab the\n\nthe", "\x00\x01", "\U000f0000 private", "x" * 3000, "the " * 5000]


def test_round_trip_on_spark(spark, documents, scratch, awkward):
    import sentencepiece

    plain = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(i and i + 100, t, None) for i, t, _ in awkward]
    coded = spm.encode(documents(rows), PATH, 2)
    got = {(r["doc_id"], r["text"]) for r in spm.decode(coded, PATH).collect()}
    assert got == {(i, (t or "").replace(spm.BLANK, " ")) for i, t, _ in rows}
    for r in coded.filter("doc_id < 8").collect():
        assert plain.decode(list(r["ids"])) == ODD[r["doc_id"]]
    digest = spm.digest(documents(rows), PATH, 2).collect()
    assert len(digest) == len(rows) and all(r["round_trip"] for r in digest)


def test_empty_table(documents):
    assert spm.digest(documents([]), PATH, 3).count() == 0
