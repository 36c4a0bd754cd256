"""Text products of a topic: summary, keywords, title, bullets, metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from plaza.functions import text as tx
from plaza.functions.arrays import unnest
from plaza.operators.keys import first_occurrence, top_per_key
from plaza.session import if_small, materialize

# Sizes of the products and the texts that stand in for a missing one.
CHUNK_CHARS = 2800
KEYWORDS_STORED = 6
TITLE_KEYWORDS = 8
TITLE_WORDS = 7
BULLETS = 3
BULLET_WORDS = 30
BULLET_MIN_WORDS = 3
NO_CONTENT = "(No meaningful content available.)"
NO_SUMMARY = "(Unable to generate summary.)"
DEFAULT_TITLE = "Topic Summary"

SUMMARY_SENTENCES = 5
# Sentences per topic that are compared with each other in one pass, and how many times more where these do not do.
CANDIDATES, MORE_CANDIDATES = 60, 16
# Cosine of keyword sets, in hundredths, from which sentences and bullets say the same.
SIMILAR_SENTENCES, SIMILAR_BULLETS = 86, 84


def chunk_text(df: DataFrame, text: str = "topic_text", size: int = CHUNK_CHARS) -> DataFrame:
    kept = [c for c in df.columns if c != text]
    return unnest(df, kept, tx.chunks(F.col(text), size), "chunk", "chunk_index")


def sentences(df: DataFrame, text: str = "topic_text") -> DataFrame:
    """One row per sentence with its position in the text."""
    kept = [c for c in df.columns if c != text]
    return unnest(df, kept, tx.split_sentences(F.col(text)), "sentence", "sentence_index")


def dedupe_exact(df: DataFrame, by: Sequence[str], text: str, order: Sequence[str]) -> DataFrame:
    """First row of each text per group, up to case and white space. Texts are
    compared by a digest of 128 bits, so what is ranked stays narrow."""
    filled = df.filter(tx.strip(F.col(text)) != "")
    return first_occurrence(filled, by, F.base64(F.unhex(F.substring(F.sha2(tx.dedupe_key(F.col(text)), 256), 1, 32))), order)


def keywords(df: DataFrame, by: Sequence[str], text: str, k: int = TITLE_KEYWORDS) -> DataFrame:
    """The ``k`` most frequent keywords of each group's text, ties by first use.

    One text per group. Texts are dealt by group before they are cut into words, so neither words
    nor counts are shuffled.
    """
    tokens = unnest(df.select(*by, text).repartition(*by), by, tx.keyword_tokens(F.col(text)), "keyword", "_pos")
    counts = tokens.groupBy(*by, "keyword").agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("_first"))
    return top_per_key(counts, by, [F.col("n").desc(), "_first"], k=k, rank="keyword_rank").drop("_first")


def topk_terms(df: DataFrame, by: Sequence[str], text: str, k: int = TITLE_KEYWORDS) -> DataFrame:
    """The ``k`` most frequent keywords over all texts of a group, ties by word."""
    tokens = unnest(df, by, tx.keyword_tokens(F.col(text)), "keyword")
    counts = tokens.groupBy(*by, "keyword").agg(F.count(F.lit(1)).alias("n"))
    return top_per_key(counts, by, [F.col("n").desc(), "keyword"], k=k, rank="keyword_rank")


def keyword_list(df: DataFrame, by: Sequence[str], text: str, k: int) -> DataFrame:
    ranked = keywords(df, by, text, k)
    listed = F.array_sort(F.collect_list(F.struct("keyword_rank", "keyword")))
    words = ranked.groupBy(*by).agg(F.transform(listed, lambda e: e["keyword"]).alias("keywords"))
    return df.select(*by, text).join(words, list(by), "left").withColumn(
        "keywords", F.coalesce("keywords", F.array().cast("array<string>")))


def near_words(a: Column, b: Column, hundredths: int) -> Column:
    """Whether two sets of words have a cosine of ``hundredths`` / 100 or more; in whole numbers, so
    that a pair at the threshold counts everywhere. Empty sets are near nothing."""
    common = F.size(F.array_intersect(a, b)).cast("long")
    return (common > 0) & (common * common * 10_000 >= F.lit(hundredths * hundredths) * F.size(a) * F.size(b))


def keyword_set(c: Column) -> Column:
    return F.array_distinct(tx.keyword_tokens(c))


def topic_sentences(texts: DataFrame, by: Sequence[str], order: Sequence[str], text: str = "text") -> DataFrame:
    """Every distinct sentence of a topic at its first place: ``by..., order..., sentence_index,
    sentence``. ``texts`` has one row per post; all of them are read whole."""
    by, order = list(by), list(order)
    rows = texts.filter(F.col(text) != "").select(*by, *order, tx.as_sentence(F.col(text)).alias("_whole"))
    return dedupe_exact(sentences(rows, "_whole"), by, "sentence", [*order, "sentence_index"])


def _one_by_one(scored: DataFrame, by: list[str], place: list[str], n: int) -> DataFrame:
    """The ``n`` weightiest sentences of each topic that are apart, one pass per winner, however many near copies there are."""
    best = None
    for _ in range(n):
        rest = scored
        if best is not None:
            taken = best.groupBy(*by).agg(F.collect_list(F.struct("_at", "words")).alias("_taken"))
            free = ~F.exists("_taken", lambda t: (t["_at"] == F.col("_at")) | near_words(t["words"], F.col("words"), SIMILAR_SENTENCES))
            rest = scored.join(taken, by).filter(free).drop("_taken")
        pick = top_per_key(rest, by, [F.col("score").desc(), *place])
        best = materialize(pick if best is None else best.unionByName(pick), "summary-sentences")
    return best


def extractive_summary(texts: DataFrame, by: Sequence[str], order: Sequence[str], text: str = "text", n: int = SUMMARY_SENTENCES) -> DataFrame:
    """The ``n`` weightiest distinct sentences of every topic, in text order.

    All sentences of all posts of a topic are ranked. A sentence weighs the mean over its
    keywords of (sentences of the topic that use it) x (inverse sentence frequency in the
    corpus). Weights are whole numbers, so equal texts rank alike everywhere. Uses are
    counted and joined, so a word that most sentences of a large topic use is not
    gathered in one task; no topic is collected, only its ``n`` winners. Words and topics are
    told apart by 64-bit hashes there.

    The winners are, in order of weight, the sentences that say nearly the same as none taken before (SIMILAR_SENTENCES).
    The CANDIDATES weightiest of each topic settle that in one pass, unless they are so often near copies that fewer
    than ``n`` are apart and lighter sentences are left: such topics take a pass with MORE_CANDIDATES times as many, and
    what is still open then another pass per winner.
    """
    by, order = list(by), list(order)
    place = [*order, "sentence_index"]
    once = topic_sentences(texts, by, order, text)
    rows = materialize(once.withColumns({"words": keyword_set(F.col("sentence")), "_id": F.monotonically_increasing_id()}), "sentences")
    # A row per use of a word is by far the most there is: numbers stand for its sentence, topic and word.
    numbered = rows.select("_id", F.xxhash64(*by).alias("_topic"), F.transform("words", lambda w: F.xxhash64(w)).alias("_words"))
    per_word = unnest(numbered, ["_id", "_topic"], F.col("_words"), "_word")
    uses = materialize(per_word.groupBy("_topic", "_word").agg(F.count(F.lit(1)).alias("tf")), "uses")
    corpus = uses.groupBy("_word").agg(F.sum("tf").alias("df"))  # a sentence is of one topic
    total = rows.agg(F.count(F.lit(1))).scalar()
    rarity = F.round(F.log((total + 1.0) / (F.col("df") + 1.0)) * 1000).cast("bigint")
    weights = uses.join(corpus, "_word").select("_topic", "_word", (F.col("tf") * rarity).alias("weight"))
    scores = materialize(per_word.join(weights, ["_topic", "_word"]).groupBy("_id").agg(
        F.floor(F.sum("weight") / F.count(F.lit(1))).cast("bigint").alias("score")), "scores")
    # Ranked without their words and texts, which follow for the few that lead.
    # A sentence without a place has no weight, and leads no topic that others settle.
    placed = reduce(and_, [F.col(c).isNotNull() for c in (*by, *place)])
    weight = F.when(placed, F.coalesce("score", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    ranked = materialize(rows.select("_id", *by, *place).join(scores, "_id", "left").withColumn("score", weight), "ranked")
    apart = lambda taken, c: (F.size(taken) < n) & ~F.exists(taken, lambda t: near_words(t["words"], c["words"], SIMILAR_SENTENCES))
    best = None
    for most in (CANDIDATES, CANDIDATES * MORE_CANDIDATES):
        lead = materialize(top_per_key(ranked, by, [F.col("score").desc(), *place], k=most + 1, rank="_rank").select("_id", "_rank"), "leading-sentences")
        heads = (rows.filter(placed) if most == CANDIDATES else rows).join(if_small(lead), "_id").groupBy(*by).agg(
            F.array_sort(F.collect_list(F.struct("_rank", *place, "sentence", "words"))).alias("_c"))
        taken = F.aggregate(F.slice("_c", 1, most), F.slice("_c", 1, 0), lambda t, c: F.when(apart(t, c), F.concat(t, F.array(c))).otherwise(t))
        judged = materialize(heads.select(*by, taken.alias("_t"), (F.size("_c") > most).alias("_more")), "summary-candidates")
        settled = judged.filter((F.size("_t") >= n) | ~F.col("_more"))
        found = settled.select(*by, F.explode("_t").alias("_s")).select(*by, *[f"_s.{c}" for c in (*place, "sentence")])
        best = found if best is None else best.unionByName(found)
        open_topics = judged.filter((F.size("_t") < n) & F.col("_more")).select(*by)
        if open_topics.isEmpty():
            break
        ranked = ranked.join(if_small(open_topics), by)
    else:
        rest = materialize(rows.join(ranked.select("_id", "score"), "_id").withColumn("_at", F.struct(*place)), "scored")
        best = best.unionByName(_one_by_one(rest, by, place, n).select(*best.columns))
    listed = best.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*place, "sentence"))).alias("_s"))
    made = listed.select(*by, F.array_join(F.transform("_s", lambda e: e["sentence"]), " ").alias("summary"))
    topics = texts.groupBy(*by).agg(F.max(F.coalesce(F.col(text), F.lit("")) != "").alias("_had"))
    missing = F.when(F.col("_had"), F.lit(NO_SUMMARY)).otherwise(F.lit(NO_CONTENT))
    return topics.join(made, by, "left").select(*by, F.coalesce(tx.blank_to_null(F.col("summary")), missing).alias("summary"))


def is_generic_title(title: Column) -> Column:
    return F.lower(title).rlike(tx.GENERIC_TITLE) | (F.size(tx.words(title)) < 2)


def clean_title(candidate: Column) -> Column:
    linkless = F.regexp_replace(F.coalesce(candidate, F.lit("")), rf"http[^{tx.SPACE}]+", " ")
    plain = F.regexp_replace(linkless, rf"[^A-Za-z0-9{tx.SPACE}\-]", " ")
    return tx.strip(F.regexp_replace(plain, rf"[{tx.SPACE}]+", " "))


def title_from(candidate: Column, words: Column, summary: Column) -> Column:
    """A given title if it says something, else keywords, else the words of the
    first sentence."""
    clean = clean_title(candidate)
    given = F.when(~is_generic_title(clean), tx.title_case(F.array_join(F.slice(tx.words(clean), 1, TITLE_WORDS), " ")))
    from_words = F.array_join(F.transform(F.slice(words, 1, TITLE_WORDS), tx.title_case), " ")
    opening = tx.strip(F.get(F.split(F.coalesce(summary, F.lit("")), "[.!?]"), F.lit(0)))
    long_words = F.filter(F.regexp_extract_all(opening, F.lit(r"\w+"), F.lit(0)), lambda w: F.length(w) > 2)
    from_opening = tx.title_case(F.array_join(F.slice(long_words, 1, TITLE_WORDS), " "))
    return F.coalesce(given, tx.blank_to_null(from_words), tx.blank_to_null(from_opening), F.lit(DEFAULT_TITLE))


def topic_title(summaries: DataFrame, by: Sequence[str], summary: str = "summary", candidate: str | None = None) -> DataFrame:
    listed = keyword_list(summaries, by, summary, TITLE_KEYWORDS)
    if candidate:
        listed = listed.join(summaries.select(*by, F.col(candidate).alias("_given")), list(by))
    else:
        listed = listed.withColumn("_given", F.lit(None).cast("string"))
    return listed.select(*by, title_from(F.col("_given"), F.col("keywords"), F.col(summary)).alias("title"))


def topic_bullets(summary: Column, n: int = BULLETS) -> Column:
    """Up to ``n`` sentences of three words or more, 30 words each, none nearly the same as one before."""
    bare = F.transform(tx.split_sentences(summary), lambda s: tx.strip(F.regexp_replace(s, r"^\W+", "")))
    long_enough = F.filter(bare, lambda s: F.size(tx.words(s)) >= BULLET_MIN_WORDS)
    near = lambda s, t: near_words(keyword_set(s), keyword_set(t), SIMILAR_BULLETS)
    apart = F.aggregate(tx.distinct_by_key(long_enough), F.array().cast("array<string>"), lambda kept, s: F.when(
        F.exists(kept, lambda t: near(s, t)), kept).otherwise(F.concat(kept, F.array(s))))
    picked = F.slice(apart, 1, n)
    return F.transform(picked, lambda s: F.array_join(F.slice(tx.words(s), 1, BULLET_WORDS), " "))


def clean_bullet(line: Column) -> Column:
    """No list markers, no leading label, single spaces."""
    bare = F.regexp_replace(tx.strip(line), tx.LIST_MARKERS, "")
    return tx.collapse_spaces(F.regexp_replace(bare, tx.BULLETS_LABEL, ""))


def bullet_clean(df: DataFrame, text: str) -> DataFrame:
    """Non-empty lines of a bullet list without markers, in order."""
    kept = [c for c in df.columns if c != text]
    lines = F.transform(F.split(text, r"\r\n|\r|\n"), lambda line: F.nullif(clean_bullet(line), F.lit("")))
    return unnest(df, kept, lines, "bullet", "line_index")


def token_intersection(a: DataFrame, b: DataFrame, by: Sequence[str], text: str, cleaned: Callable[[Column], Column] = tx.clean_text) -> DataFrame:
    """Distinct tokens that both sides of a group use in their texts, which are ``cleaned``.

    Each distinct piece of a group's texts (see ``clean_pieces``) is cleaned once, however many posts have it.
    """
    def tokens(df: DataFrame) -> DataFrame:
        pieces = unnest(df, by, tx.clean_pieces(F.col(text)), "piece").distinct()
        return unnest(pieces, by, F.array_distinct(tx.metric_tokens(cleaned(F.col("piece")))), "token").distinct()

    return tokens(a).join(tokens(b), [*by, "token"])


def summary_metrics(originals: DataFrame, summaries: DataFrame, by: Sequence[str], text: str = "text", summary: str = "summary") -> DataFrame:
    """Compression, overlap and length of each summary against its whole texts.

    Tokens of both sides are counted in one pass per (group, token), combined
    before the shuffle; a group's vocabulary is never collected.
    """
    by = list(by)

    def tagged(df: DataFrame, column: str, o: int) -> DataFrame:
        tokens = unnest(df, by, tx.metric_tokens(F.col(column)), "token")
        return tokens.select(*by, "token", F.lit(o).alias("o"), F.lit(1 - o).alias("s"))

    both = tagged(originals, text, 1).unionByName(tagged(summaries, summary, 0))
    words = both.groupBy(*by, "token").agg(F.sum("o").alias("o"), F.sum("s").alias("s"))
    totals = words.groupBy(*by).agg(
        F.sum("o").alias("o_all"), F.sum("s").alias("s_all"),
        F.count_if(F.col("o") > 0).alias("o_distinct"),
        F.count_if((F.col("o") > 0) & (F.col("s") > 0)).alias("shared"),
    )

    def floored(c: str) -> Column:
        return F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(1))

    return summaries.select(*by).join(totals, by, "left").select(
        *by,
        F.bround(floored("s_all") / floored("o_all"), 4).alias("compression_ratio"),
        F.bround(F.coalesce("shared", F.lit(0)) / floored("o_distinct"), 4).alias("lexical_overlap"),
        floored("s_all").cast("int").alias("summary_length"),
    )
