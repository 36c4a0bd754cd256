import hashlib
import re

from pyspark.sql import functions as F

from plaza.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return sorted(out)


TEXTS = [
    "write to a.b@c.de, or a@b.c_x@y.z and x@y", "1.2.3.4.5 and 300.1.1.1 and 001.002.003.004", "é😀 4111 1111 1111 1111 and 4111111111111112",
    "+1 (555) 010-1234 and +12 and +49 30 1234567890123456", "", None, "9" * 5000, "1 " * 3000, "a@" * 2000, ".".join(["1"] * 3000),
    "call (555) 010-1234 now; mail me: joe [at] site [dot] org", "5500005555555559 a@b.co +1 (555) 010-1234 10.0.0.1",
    "4111-1111-1111-1111" * 300, "x" * 100_000 + " a@b.cd",
]


def test_base_matches_equal_brute_force(documents, scratch):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], None), (0, TEXTS[0], "en")]
    got = sorted((tuple(r) for r in pii.personal_data(documents(rows), scratch).drop("spans").collect()), key=str)
    want = []
    for i, t, _ in rows:
        spans = base_spans(t)
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        want.append((i, *[sum(s[1] == k for s in spans) for k in range(4)], hashlib.sha256(listed.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_base_spans_stay_and_others_do_not_overlap_them(documents, scratch):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)]
    for r in pii.personal_data(documents(rows), scratch).collect():
        listed = [s.split(":") for s in r["spans"].split(",") if s]
        spans = [(int(a), list(PATTERNS).index(k), int(b), k) for k, a, b in listed]
        base = base_spans(TEXTS[r["doc_id"]])
        assert spans == sorted(spans) and set(base) <= set(spans)
        for a, kind, b, _ in set(spans) - set(base):
            assert not any(k == kind and s < b and a < e for s, k, e, _ in base)


def test_reliabilities_follow_the_agreeing_labelers():
    counts = {(2, (1, 1, 1, 0, 1)): 500, (2, (-1, 0, -1, 0, 1)): 500, (2, (-1, 1, 1, 1, 1)): 3, (2, (-1, -1, -1, -1, -1)): 200}
    learned = pii.reliabilities(counts)
    assert learned[2, (1, 1, 1, 0, 1)] > 0.9 > 0.5 > learned[2, (-1, -1, -1, -1, -1)]


def test_mask(spark, documents, scratch):
    docs = documents([(1, "mail a@b.de or b@c.de, ip 1.2.3.4.", "en"), (2, None, "en"), (3, "nothing", "en"), (4, "", None)])
    out = pii.mask_documents(docs, scratch)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts == {1: "mail [EMAIL] or [EMAIL], ip [IP].", 2: None, 3: "nothing", 4: ""}


def test_empty_table(documents, scratch):
    assert pii.personal_data(documents([]), scratch).count() == 0


def test_running_totals(spark):
    lengths = [(i * 7) % 5 for i in range(1000)]
    df = spark.createDataFrame([(lengths,)], "a array<int>")
    got = df.select(pii.running_totals(F.col("a")).alias("t")).first()["t"]
    assert got == [sum(lengths[:i + 1]) for i in range(1000)]
