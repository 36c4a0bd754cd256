"""Text column expressions. All are native and row-local."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

# White space as Unicode-aware patterns see it, spelled out because
# Java's \s is ASCII-only.
SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

ASCII_SPACE = r"\t-\r\x1c-\x20"
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WIDE_SPACES = [c for c in SPACE_CHARS if ord(c) > 0x7F]

# The cleaning steps, in the order in which they apply; ``{s}``
# stands for the white space characters.
CLEANING_STEPS = [
    ("http[^{s}]+", " "),
    (r"www\.[^{s}]+", " "),
    ("[a-z](?=[A-Z])", "$0 "),
    ("[{s}]{{2,}}", " "),
    (r"[^\x00-\x7F]+", ""),
]

# Words that never count as keywords.
KEYWORD_STOPWORDS = (
    "the and a an to of for in on is are was were that this with it as by be from "
    "or at its has have will but not they their"
).split()

# Token patterns of keywords (with hyphen) and of metrics (without),
# the sentence boundary, and the openings that mark a title as generic.
KEYWORD_PATTERN = r"\b[a-zA-Z0-9\-']+\b"
METRIC_PATTERN = r"\b[a-zA-Z0-9']+\b"
SENTENCE_BREAK = rf"(?<=[.!?])[{SPACE}]+"
GENERIC_TITLE = r"^(list of|this is|a list of|the list of|bullets|list:)"
LIST_MARKERS = r"^[-•*\s]+"
BULLETS_LABEL = r"(?i)^bullets:"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def by_charset(c: Column, build: Callable[[str], Column]) -> Column:
    """The expression ``build`` makes from a white space class. The whole class is
    several times slower to match than its ASCII part, so it serves only text
    that has such a character: a search for the characters as plain bytes."""
    wide = reduce(lambda found, w: found | F.contains(c, F.lit(w)), WIDE_SPACES, F.lit(False))
    narrow = (F.octet_length(c) == F.length(c)) | ~wide
    return F.when(narrow, build(ASCII_SPACE)).otherwise(build(SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """Readable ASCII text: no links, camelCase split, runs of space collapsed."""
    whole = F.coalesce(c, F.lit(""))

    def replaced(space: str) -> Column:
        return reduce(lambda t, step: F.regexp_replace(t, F.lit(step[0].format(s=space)), F.lit(step[1])), CLEANING_STEPS, whole)

    return strip(by_charset(whole, replaced))


def clean_pieces(c: Column) -> Column:
    """Pieces of a text that ``clean_text`` may clean one by one: together they have the words that the cleaned text has.

    What a cleaning step matches does not reach over white space. The separators 1c to 1f are white space to some patterns
    only, so a text that has one is a single piece.
    """
    whole = reduce(lambda found, w: found | F.contains(c, F.lit(w)), ["\x1c", "\x1d", "\x1e", "\x1f"], F.lit(False))
    return F.when(whole, F.array(c)).otherwise(F.split(c, r"[\t-\r ]+"))


def post_content(content: Column, title: Column, selftext: Column) -> Column:
    """The content, or title and body when it is missing or empty."""
    whole = F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(selftext, F.lit("")))
    return F.coalesce(blank_to_null(content), whole)


def cleaned_content(content: Column) -> Column:
    return F.translate(F.lower(content), "\n", " ")


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def capitalize_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others."""
    parts = F.split(c, r"(?<=[^A-Za-z])(?=[A-Za-z])")
    return F.array_join(F.transform(parts, lambda p: capitalize_first(F.lower(p))), "")


def as_sentence(c: Column) -> Column:
    """Trimmed text that ends in a full stop and starts with a capital."""
    t = strip(c)
    end = F.when(F.right(t, F.lit(1)).isin(".", "!", "?"), F.lit("")).otherwise(F.lit("."))
    return F.concat(F.upper(F.substring(t, 1, 1)), F.substr(t, F.lit(2)), end)


def sentence_length(c: Column) -> Column:
    """Length of ``as_sentence``, without making it."""
    t = strip(c)
    return F.length(t) + F.when(F.right(t, F.lit(1)).isin(".", "!", "?"), F.lit(0)).otherwise(F.lit(1))


def split_sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, SENTENCE_BREAK), strip), lambda s: s != "")


def chunks(c: Column, size: int) -> Column:
    """The whole text cut into pieces of ``size`` characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1)), F.lit(size))
    pieces = F.transform(starts, lambda i: F.substr(c, i, F.lit(size)))
    return F.filter(pieces, lambda p: p != "")


def dedupe_key(c: Column) -> Column:
    return by_charset(c, lambda space: F.regexp_replace(F.lower(strip(c)), f"[{space}]+", " "))


def keyword_tokens(c: Column) -> Column:
    """Keyword candidates in text order, repeats kept."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit(KEYWORD_PATTERN), F.lit(0))
    return F.filter(tokens, lambda t: (F.length(t) > 2) & ~t.isin(KEYWORD_STOPWORDS))


def metric_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(METRIC_PATTERN), F.lit(0))


def words(c: Column) -> Column:
    return F.filter(F.split(c, rf"[{SPACE}]+"), lambda w: w != "")


def collapse_spaces(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"[{SPACE}]{{2,}}", " "))


def distinct_by_key(items: Column) -> Column:
    """First of each group of items equal up to case and white space."""
    keys = F.transform(items, dedupe_key)
    return F.filter(items, lambda s, i: F.array_position(keys, dedupe_key(s)) == i + 1)


def snippet(c: Column, limit: int = 300) -> Column:
    cut = F.concat(F.substring(c, 1, limit), F.lit("..."))
    return F.when(F.length(c) > limit, cut).otherwise(F.coalesce(c, F.lit("")))
