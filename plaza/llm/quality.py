"""Quality rules: bad lines first, then documents that lose too much.

Each line is held against rules on punctuation, navigation and boilerplate. Lines
that fail are removed; a document is rejected if less than half of its characters
outside white space is left, or if it fails the base rules (too few words, too many
words in repeated three-word windows).

Contract
- Words are runs of characters other than ``[\\x20\\x09-\\x0D]``; null text has none.
- A window of three words counts as repeated if the same three words start at two or
  more places of the text; each word in such a window counts once.
- Empty texts fail the base rules. An empty table gives no rows. Every row is judged
  by itself, so repeated rows and null ids give equal and separate rows. Only
  ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plaza.functions.arrays import let
from plaza.llm.common import SPACE, split_words, whole_text

LEAST_WORDS = 50
REPEATED_PERCENT = 50
WINDOW = 3
LOST_PERCENT = 50

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
# Rules for lines. A line of symbols, brackets and digits rather than letters; a menu of
# short parts between bars; short lines with a notice that stands on many pages. (The possessive signs change no
# match; without them a line of thousands of bars would exhaust the matcher's stack.)
PUNCTUATION_PERCENT = 30
NOTICE_CHARS = 150
MENU = r"^[^|>»·•]{0,30}+(?:[|>»·•][^|>»·•]{0,30}+){2,}+$"
NOTICES = (
    r"(?i)\b(all rights reserved|released under the|licensed under|terms of (use|service)|privacy policy"
    r"|accept (all )?cookies|enable javascript|click here|sign up|log ?in|subscribe|share on)\b|©|lorem ipsum"
)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _solid(text: Column) -> Column:
    return _without(text, " \t\n\x0b\x0c\r")


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text.

    Windows are sorted by hash with their place; equal neighbours give the places of
    repeated windows, and the gaps between those places the words they cover.
    """
    windows = F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    def of_sorted(s: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
        found = F.filter(s, lambda x, j: same(j, j - 1) | same(j, j + 1))
        return let(F.sort_array(F.transform(found, lambda x: x["i"])), covered)

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.coalesce(
            F.least(F.lit(WINDOW), F.get(places, j + 1) - p), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def of_windows(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), of_sorted))

    return F.coalesce(let(windows, of_windows), F.lit(0).cast("long"))


def bad_line(line: Column) -> Column:
    """Whether a line fails a rule. A line without words never does."""
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    solid = F.length(_solid(line))
    symbols = F.length(line) - F.length(_without(line, SYMBOLS + "{}[]=\\/_~^"))
    punctuation = (letters == 0) | (symbols * 100 > solid * PUNCTUATION_PERCENT)
    notice = (solid <= NOTICE_CHARS) & line.rlike(NOTICES)
    return (solid > 0) & (punctuation | line.rlike(MENU) | notice)


def quality(docs: DataFrame) -> DataFrame:
    """Counts, base verdict and verdict of every document, and its cleaned text."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    split = texts.select("doc_id", "text", split_words(F.col("text")).alias("words"), F.split("text", "\n", -1).alias("lines"))
    worded = F.filter("lines", lambda line: F.length(_solid(line)) > 0)
    measured = split.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(_solid(F.col("text"))).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        let(worded, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.array_join(F.filter("lines", lambda line: ~bad_line(line)), "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)
    left = F.length(_solid(F.col("clean_text"))).cast("long")
    return measured.select("*", failed.alias("base_failed"), left.alias("left_chars")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("left_chars") * 100 >= F.col("word_chars") * (100 - LOST_PERCENT)))
