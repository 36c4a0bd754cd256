import re

import duckdb
import pytest

from plaza.llm import quality

LINES = "\n".join(["A plain line of prose with several words in it."] * 1)


def counts(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    seen, places = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    for where in seen.values():
        if len(where) > 1:
            for i in where:
                places |= {i, i + 1, i + 2}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places),
            n < 50 or 100 * len(places) > 50 * n)


PROSE = " ".join(f"word{i} of number{i}" for i in range(40)) + "."
TEXTS = [
    "", None, " \n\t", "one two three", "a b c a b c", "a a a a a a", "x y\nx y\n\n x y\nz", PROSE, PROSE + "\n" + PROSE, "é😀 漢字 " * 60,
    "# * $ % & | < >", "a\x0bb\x0cc\rd", " nbsp is no blank", " ".join(["w"] * 30_000), PROSE.replace(" ", "\n"),
]


def test_counts_equal_brute_force(documents):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(None, PROSE, None), (3, TEXTS[3], "en")]
    got = quality.quality(documents(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(i, *counts(t)) for i, t, _ in rows], key=str)


@pytest.mark.parametrize("line, bad", [
    ("Plain prose of a few words.", False), ("Ti.", False), ("", False), ("Home | About | Contact", True), ("*** ### $$$ a", True),
    ("12345 67890", True), ("Released under the MIT License.", True), ("© 2024 Somebody", True), ("El niño come.", False),
    ("A sentence with a < b in it, which is fine.", False),
])
def test_line_rules(spark, line, bad):
    from pyspark.sql import functions as F

    assert spark.range(1).select(quality.bad_line(F.lit(line)).alias("b")).first()["b"] is bad


def test_a_document_that_loses_most_is_rejected(documents):
    menu = "\n".join("Home | About us | Contact and more | Imprint" for _ in range(30))
    rows = [(1, PROSE, "en"), (2, "\n".join(f"{i} Home | About{i} | Contact{i} | More" for i in range(60)), "en"), (3, PROSE + "\n© all rights reserved", "en"), (4, menu, "en")]
    got = {r["doc_id"]: r for r in quality.quality(documents(rows)).collect()}
    assert got[1]["kept"] and not got[2]["kept"] and not got[2]["base_failed"] and got[3]["kept"] and not got[4]["kept"]
    assert got[3]["clean_text"] == PROSE


def test_a_notice_in_a_long_line_takes_nothing(documents):
    text = " ".join(f"word{i} of number{i}" for i in range(500)) + " click here or subscribe © 2024."
    got = quality.quality(documents([(1, text, "en"), (2, PROSE + "\nClick here to log in", "en")])).orderBy("doc_id").collect()
    assert got[0]["kept"] and got[0]["clean_text"] == text and got[1]["clean_text"] == PROSE


def test_long_lines_of_marks(documents):
    rows = [(1, "a | " * 50_000, "en"), (2, "| " * 50_000 + "x" * 100, "en"), (3, "#" * 200_000, "en")]
    assert {r["doc_id"]: r["left_chars"] for r in quality.quality(documents(rows)).select("doc_id", "left_chars").collect()} == {1: 0, 2: 0, 3: 0}


def test_empty_table(documents):
    assert quality.quality(documents([])).count() == 0


def test_twin_judges_long_lines_alike(spark, documents, tmp_path):
    """A notice in a line of 402 words, in one of 150 characters and in one of 151, next to the twin."""
    from plaza.llm.queries import ORACLES, QUERIES
    from tests.compare import difference



    line = lambda n: ("click here " + "ab " * 200).replace(" ", "")[:n - 9] + " click here"
    rows = [(1, " ".join(f"w{i}" for i in range(400)) + " click here", "en"), (2, PROSE + "\n" + line(150), "en"), (3, PROSE + "\n" + line(151), "en"),
            (4, "\n".join([PROSE[:300], line(150), line(151), "Click here"]), "en"), (5, None, None)]
    documents(rows, extra=False).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    _, wrong = difference(spark, con, str(tmp_path), "op5", QUERIES["op5_quality_rules"], ORACLES["op5_quality_rules"])
    assert wrong == ""
