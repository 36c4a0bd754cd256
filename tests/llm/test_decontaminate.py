import hashlib
import random
import re


from hypothesis import given, settings, strategies as st

from plaza.llm import decontaminate
from plaza.llm.decontaminate import Reader, SuffixAutomaton

GAP = re.compile(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in GAP.split(lower) if w]


def expected(docs, items, window=10):
    out = []
    for doc, text in docs:
        words, hit, names = words_of(text), set(), set()
        for item, body in items:
            ws = words_of(body)
            k = min(window, len(ws))
            wanted = {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if ws else set()
            for i in range(len(words) - k + 1):
                if k and tuple(words[i:i + k]) in wanted:
                    hit.update(range(i, i + k))
                    if item is not None:
                        names.add(str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS spans", "'y' AS row")


words = st.lists(st.sampled_from("abc"), max_size=14)


@given(st.lists(words, max_size=5), words.map(lambda w: w * 3), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_automaton_equals_brute_force(items, doc, window):
    named = [(i, " ".join(ws)) for i, ws in enumerate(items)]
    automaton = SuffixAutomaton([(i, [w.encode() for w in ws], False) for i, ws in enumerate(items)], window)
    r = Reader(automaton).read(" ".join(doc).encode())
    got = (sum(e - s for s, e in r.spans), [str(n) for n in r.names()])
    (_, n, n_hit, n_items, digest, _), = expected([(0, " ".join(doc))], named, window)
    assert (r.words, got[0], len(got[1])) == (n, n_hit, n_items)
    assert hashlib.sha256(",".join(got[1]).encode()).hexdigest() == digest
    longest = max((j - i for i in range(len(doc)) for j in range(i, len(doc) + 1)
                   if any(doc[i:j] == ws[k:k + j - i] for ws in items for k in range(len(ws)))), default=0)
    # Runs too short for a window are not walked.
    assert r.longest == longest or longest < automaton.least


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short ITEM"), (3, None), (4, " .,! "), (2, "short item"),
         (None, "an item without any id"), (10, "short item"), (5, "漢字 é one"), (6, "same same same same same same same same same same same")]


def test_awkward_rows(spark, documents, awkward, scratch):
    rows = [*awkward, (20, "x ONE two-three four, five six seven eight nine ten y", "en"), (21, "a short,item short item", None),
            (22, "same " * 40, "en"), (23, "an item without any id", "en"), (24, "漢字 É one 漢字 é one", "en"), (24, "漢字 É one 漢字 é one", "en")]
    made = decontaminate.hits(documents(rows), bench(spark, ITEMS), scratch)
    assert found(made) == expected([r[:2] for r in rows], ITEMS)


def test_empty_tables(spark, documents, scratch, awkward):
    assert found(decontaminate.hits(documents([]), bench(spark, ITEMS), scratch)) == []
    made = decontaminate.hits(documents(awkward), bench(spark, []), decontaminate.Scratch(spark, "other"))
    assert found(made) == expected([r[:2] for r in awkward], [])


def test_parts_and_pieces(spark, documents, scratch, monkeypatch):
    """Several parts of the benchmark, long items in pieces."""
    draw = random.Random(5)
    pool = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(draw.choices(pool, k=draw.choice([3, 8, 15, 60, 300])))) for i in range(30)]
    docs = []
    for i in range(40):
        text = draw.choices(pool, k=60)
        body = draw.choice(items)[1].split()
        at = draw.randrange(max(1, len(body) - 20))
        docs.append((i, " ".join([*text[:30], *body[at:at + 25], *text[30:]]), "en"))
    monkeypatch.setattr(decontaminate, "WORDS_PER_PART", 400)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 50)
    made = decontaminate.hits(documents(docs), bench(spark, items), scratch)
    assert found(made) == expected([d[:2] for d in docs], items)


def test_slices_carry_the_state():
    items = [(1, [f"w{i}".encode() for i in range(30)], False)]
    automaton, text = SuffixAutomaton(items, 10), " ".join(f"W{i % 30}" for i in range(3000)).encode()
    whole = Reader(automaton).read(text)
    cut = Reader(automaton)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + 11)
        end = len(text) if end < 0 else end
        cut._take(text[at:end].translate(decontaminate._BYTES).split())
        at = end
    assert (cut.words, cut.spans, cut.longest, cut.found) == (whole.words, whole.spans, whole.longest, whole.found)


def test_hit_words_are_cut_out(spark, documents, scratch):
    rows = [(1, "Before: One two three, four five six seven eight nine TEN. After!", "en"), (2, "clean text", "en"), (3, None, "en")]
    made = decontaminate.cleaned(documents(rows), bench(spark, ITEMS), scratch)
    assert made.columns == documents(rows).columns
    assert {r["doc_id"]: r["text"] for r in made.collect()} == {1: "Before: . After!", 2: "clean text", 3: None}
