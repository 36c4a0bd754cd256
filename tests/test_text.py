"""Text expressions against plain Python on literal edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from plaza.functions import text as tx
from plaza.operators import products

CASES = [
    "", "   ", "plain words", "see http://a.b/c?d=e now", "www.site.org/x y", "camelCase andMore aBcD",
    "tabs\t\tand  spaces", "one\nline", "two\n\nlines", "café naïve", "wide space", "wide  run",
    "http://x after", "é é é", "trail\n", "emoji 😀 😀 end", "\x1cfs\x1c\x1cfs", "no​break",
]


CLEANED = [
    "", "", "plain words", "see now", "y", "camel Case and More a Bc D",
    "tabs and spaces", "one\nline", "two lines", "caf nave", "widespace", "wide run",
    "after", "", "trail", "emoji   end", "fs fs", "nobreak",
]


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in df.select("i", expression(F.col("t")).alias("o")).orderBy("i").collect()]


def test_clean_text(spark):
    assert apply(spark, CASES, tx.clean_text) == CLEANED
    assert apply(spark, [None], tx.clean_text) == [""]


def test_title_case(spark):
    values = ["fine-tuning", "don't", "3d model", "a b-c_d", "ALL CAPS", ""]
    assert apply(spark, values, tx.title_case) == ["Fine-Tuning", "Don'T", "3D Model", "A B-C_D", "All Caps", ""]


def test_dedupe_key(spark):
    values = [" A  b\tC ", "x  Y", "same"]
    assert apply(spark, values, tx.dedupe_key) == ["a b c", "x y", "same"]


def test_split_sentences(spark):
    values = ["One. Two!  Three? four", "no end", "", "a.b. c", "Wait... what?"]
    expected = [["One.", "Two!", "Three?", "four"], ["no end"], [], ["a.b.", "c"], ["Wait...", "what?"]]
    assert apply(spark, values, tx.split_sentences) == expected


def test_as_sentence_and_length(spark):
    values = ["word", "done.", " ask? ", "x!", "über"]
    made = apply(spark, values, tx.as_sentence)
    assert made == ["Word.", "Done.", "Ask?", "X!", "Über."]
    assert apply(spark, values, tx.sentence_length) == [len(m) for m in made]


def test_chunks_cover_the_text(spark):
    values = ["", "abc", "abcdef", "abcdefg"]
    assert apply(spark, values, lambda c: tx.chunks(c, 3)) == [[], ["abc"], ["abc", "def"], ["abc", "def", "g"]]


def test_keyword_tokens(spark):
    values = ["The fine-tuning of it's -- models_x and AI's AI", "", "to be"]
    expected = [["fine-tuning", "it's", "ai's"], [], []]
    assert apply(spark, values, tx.keyword_tokens) == expected


def test_snippet(spark):
    assert apply(spark, [None, "a" * 300, "a" * 301], tx.snippet) == ["", "a" * 300, "a" * 300 + "..."]


def test_post_content(spark):
    df = spark.createDataFrame([("c", "t", "s"), ("", "t", "s"), (None, None, "s")], "c string, t string, s string")
    made = df.select(tx.post_content(F.col("c"), F.col("t"), F.col("s")).alias("o")).collect()
    assert [r["o"] for r in made] == ["c", "t\n\ns", "\n\ns"]


@pytest.mark.parametrize("given, title", [
    ("Scaling transformers today", "Scaling Transformers Today"),
    ("List of things", "Alpha Beta-Rays"), ("single", "Alpha Beta-Rays"), ("http://x.y/z", "Alpha Beta-Rays"),
])
def test_title_from_candidate(spark, given, title):
    df = spark.createDataFrame([(given, ["alpha", "beta-rays"], "Some text.")], "g string, k array<string>, s string")
    assert df.select(products.title_from(F.col("g"), F.col("k"), F.col("s")).alias("o")).first()["o"] == title


@pytest.mark.parametrize("summary, title", [("Go to big cities. Then stop", "Big Cities"), ("a b.", products.DEFAULT_TITLE), ("", products.DEFAULT_TITLE)])
def test_title_without_keywords(spark, summary, title):
    df = spark.createDataFrame([(summary,)], "s string")
    none = F.array().cast("array<string>")
    assert df.select(products.title_from(F.lit(None).cast("string"), none, F.col("s")).alias("o")).first()["o"] == title


def test_bullets(spark):
    df = spark.createDataFrame([("- One two three. Short. one  TWO three. (Four five six) seven! Last one here? And more words here.",)], "s string")
    assert df.select(products.topic_bullets(F.col("s")).alias("o")).first()["o"] == [
        "One two three.", "Four five six) seven!", "Last one here?"]


def test_near_bullets_are_dropped(spark):
    text = "Alpha beta gamma delta epsilon zeta eta theta. Beta alpha gamma delta epsilon zeta eta theta iota. Something quite different here."
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(products.topic_bullets(F.col("s")).alias("o")).first()["o"] == [
        "Alpha beta gamma delta epsilon zeta eta theta.", "Something quite different here."]


def test_bullet_lines(spark):
    df = spark.createDataFrame([(1, "- first\n\n* Bullets:  second  item\r\n•third\n   ")], "id int, t string")
    made = products.bullet_clean(df, "t").orderBy("line_index").collect()
    assert [(r["line_index"], r["bullet"]) for r in made] == [(0, "first"), (2, "second item"), (3, "third")]


def test_pieces_are_cleaned_as_the_whole_text_is(spark):
    """Links, camel case, wide spaces and separators: the same tokens from the pieces as from the text."""
    parts = ["http://a.b/c", "http", "www.x", "www.", "camelCaseWord", "É", "wide\xa0one", "two\xa0 gaps", "x\x1cy", "é\x1cz", "\x1d", "it's", "don't　A", "A1b", "", "\x85", "café!"]
    draw = random.Random(5)
    rows = [(i, "".join(draw.choice(parts) + draw.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b", "\xa0", ""]) for _ in range(12))) for i in range(400)]
    df = spark.createDataFrame([*rows, (400, None), (401, "")], "i int, t string")
    whole = df.select("i", F.array_sort(F.array_distinct(tx.metric_tokens(tx.clean_text(F.col("t"))))).alias("words"))
    tokens = F.flatten(F.transform(F.coalesce(tx.clean_pieces(F.col("t")), F.array()), lambda p: tx.metric_tokens(tx.clean_text(p))))
    pieces = df.select("i", F.array_sort(F.array_distinct(tokens)).alias("words"))
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, whole.collect()))


def test_token_intersection_cleans_each_distinct_piece_once(spark):
    cleaned = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(piece):
        cleaned.add(1)
        return piece.lower()

    a = spark.createDataFrame([("g", f"Same words http {i % 2}") for i in range(500)], "g string, t string")
    made = products.token_intersection(a, a, ["g"], "t", counted)
    assert sorted(r["token"] for r in made.collect()) == ["0", "1", "http", "same", "words"]
    assert cleaned.value <= 2 * 5
