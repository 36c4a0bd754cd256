"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaza.llm import chat, chat_repair, decontaminate, exact_dedup, html_text, langid, minhash, packing, phrases, pii, quality, sentencepiece, suffix_dedup
from plaza.llm.common import Scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(twin: str | None = None):
    def register(make):
        QUERIES[make.__name__] = make
        if twin:
            ORACLES[make.__name__] = twin
        return make

    return register


@query("""
    SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
    FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), Scratch(spark, "op1"))


@query()
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"), Scratch(spark, "op2"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.packed_documents(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), Scratch(spark, "op3"), keep_ids=False)
    return packed.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), Scratch(spark, "op4"), keep_text=False).drop("kept")


_SOLID = "regexp_replace({}, '[\\x20\\x09-\\x0D]+', '', 'g')"
_LINE_SYMBOLS = quality.SYMBOLS + r"{}\[\]=\\/_~^"
_BAD_LINE = f"""(length({_SOLID.format("x")}) > 0 AND (
    length(regexp_replace(x, '[^\\p{{L}}]+', '', 'g')) = 0
    OR (length(x) - length(regexp_replace(x, '[{_LINE_SYMBOLS}]', '', 'g'))) * 100
        > length({_SOLID.format("x")}) * {quality.PUNCTUATION_PERCENT}
    OR regexp_matches(x, '{quality.MENU.replace('}+', '}')}')
    OR (length({_SOLID.format("x")}) <= {quality.NOTICE_CHARS} AND regexp_matches(x, '{quality.NOTICES}'))))"""


@query(f"""
    WITH d AS (
        SELECT doc_id, t, string_split(t, chr(10)) AS lines,
            list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
    windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY doc_id),
    measured AS (
        SELECT doc_id, len(words) AS n_words, length({_SOLID.format("t")}) AS word_chars,
            length(t) - length(regexp_replace(t, '[{quality.SYMBOLS}]', '', 'g')) AS n_symbols,
            len(list_filter(lines, lambda x: {_SOLID.format("x")} <> ''))
                - len(list_distinct(list_filter(lines, lambda x: {_SOLID.format("x")} <> ''))) AS n_dup_lines,
            coalesce(covered.n, 0) AS n_repeat_words,
            length({_SOLID.format(f"array_to_string(list_filter(lines, lambda x: NOT {_BAD_LINE}), '')")}) AS left_chars
        FROM d LEFT JOIN covered USING (doc_id))
    SELECT *, n_words < {quality.LEAST_WORDS} OR n_repeat_words * 100 > n_words * {quality.REPEATED_PERCENT} AS base_failed,
        NOT (n_words < {quality.LEAST_WORDS} OR n_repeat_words * 100 > n_words * {quality.REPEATED_PERCENT})
            AND left_chars * 100 >= word_chars * {100 - quality.LOST_PERCENT} AS kept
    FROM measured
""")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "left_chars")


@query()
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.turns(table(spark, sf_dir, "conversations"), Scratch(spark, "op6"))


@query()
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), n=3)


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = langid.predicted(docs.select("doc_id", "text"), langid.train(docs))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"), langid.held_out(F.col("row.doc_id")).alias("held_out"),
        "lang_pred", "score", "accepted")


# The pages of the tables mark their articles, hold paragraphs and headings in them, and use few references.
_PLAIN = "replace(replace(replace(replace(b, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


@query(f"""
    SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM (
        SELECT page_id, url, array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace(
                regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), chr(1)),
            lambda b: trim(regexp_replace({_PLAIN.replace("(b,", "(regexp_replace(b, '<[^>]*>', '', 'g'),")}, '[\\x20\\x09-\\x0D]+', ' ', 'g'))),
            lambda b: b <> ''), chr(10)) AS text FROM pages)
""")
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"), Scratch(spark, "op9"))


@query("""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
        UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) IN (1, 2)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
    least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
    SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
    FROM w JOIN least ON least.x = w.doc_id LEFT JOIN sizes ON sizes.doc_id = w.doc_id
""")
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), Scratch(spark, "op10"), size=3, percent=85)


_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


@query(f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    items AS (SELECT item_id, ws, least(10, len(ws)) AS k FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
    windows AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS w FROM (
        SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM items)),
    places AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w FROM (
        SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM items))),
    found AS (SELECT doc_id, k, i, item_id FROM places JOIN windows USING (k, w)),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
    named AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM found GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op11"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


# After no turn, system, user, assistant: the state after a turn that may be chosen, and what it is called.
_CHOSEN, _CALLED = [2, 2, 3, 2], {2: "user:", 3: "assistant:"}


def _repair_moves() -> str:
    """Zero to two insertions and then an edit of a row: state, initial of the row, edits, cost, inserted text, role put in, state after."""
    out = []
    for state in range(4):
        at, edits, text = state, "", ""
        for _ in range(3):
            out.append((state, None, edits + "D", 2 * len(edits) + 3, text, None, at))
            out.append((state, None, edits + "R", 2 * len(edits) + 2, text, _CALLED[_CHOSEN[at]], _CHOSEN[at]))
            for initial, after in {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[at].items():
                out.append((state, initial, edits + "K", 2 * len(edits), text, None, after))
            at, edits = _CHOSEN[at], edits + "I"
            text += f"|{_CALLED[at]}"
    say = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join(f"({', '.join(map(say, m))})" for m in out)


@query(f"""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
    said AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    ways AS (
        SELECT conv_id, turn, role, text, xor(list_reduce(
            list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS way FROM said, crc),
    dealt AS (
        SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
            CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE way WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM ways),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
            regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS mark FROM dealt),
    faulty AS (
        SELECT conv_id, turn, role, text, pos, left(role, 1) AS ini, count(*) OVER (PARTITION BY conv_id) AS n,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
            CASE WHEN mark = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                WHEN mark NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM placed),
    moves(state, ini, edits, cost, put, called, after) AS (VALUES {_repair_moves()}),
    ways_on AS (
        SELECT f.conv_id, f.pos, f.n, m.state, m.after, m.edits, m.cost + CASE WHEN fault = 'truncated' AND m.edits NOT LIKE '%D' THEN 1 ELSE 0 END AS cost,
            m.put || CASE WHEN m.edits LIKE '%D' THEN '' ELSE '|' || coalesce(m.called, f.role || ':') || replace(f.text, '|', chr(1)) END AS put
        FROM faulty f JOIN moves m ON (m.ini IS NULL OR m.ini = f.ini) AND (m.edits LIKE '%D' OR f.fault IN ('none', 'truncated'))),
    best AS (
        SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, n, 0 AS state, {{'cost': 0, 'audit': '', 'put': ''}} AS way FROM faulty
        UNION ALL
        SELECT b.conv_id, w.pos, w.n, w.after, min({{'cost': b.way.cost + w.cost, 'audit': b.way.audit || w.edits, 'put': b.way.put || w.put}})
        FROM best b JOIN ways_on w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND w.pos = b.pos + 1 AND w.state = b.state
        GROUP BY b.conv_id, w.pos, w.n, w.after),
    ended AS (
        SELECT conv_id, min({{'cost': way.cost + missing.cost, 'audit': way.audit || missing.edits, 'put': way.put || missing.put}}) AS way
        FROM best JOIN (VALUES (0, 0, '', ''), (1, 4, 'II', '|user:|assistant:'), (2, 2, 'I', '|assistant:'), (3, 0, '', '')) AS missing(state, cost, edits, put)
            USING (state) WHERE pos = n GROUP BY conv_id),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
            count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
            count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost, coalesce(way.audit, '') AS audit,
        sha256(coalesce(replace(replace(way.put[2:], '|', chr(10)), chr(1), '|'), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM c.conv_id
""")
def op12_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return chat_repair.repairs(chat_repair.damaged(conversations), conversations, Scratch(spark, "op12"))


@query("""
    WITH pieces AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
    f AS (
        SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f
        FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS lengths(m)) GROUP BY ALL),
    totals AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
    candidates AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE m > 1 AND f >= 10),
    cuts AS (
        SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS front, array_to_string(ws[k + 1:], ' ') AS back
        FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
    scored AS (
        SELECT c.lang, c.phrase, a, k, p.f AS l, q.f AS r, CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
        FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = front JOIN f q ON q.lang = c.lang AND q.phrase = back),
    best AS (SELECT lang, phrase, a, min({'score': score, 'k': k, 'l': l, 'r': r}) AS way FROM scored GROUP BY ALL),
    covered AS (
        SELECT lang, phrase, max(a) AS longer FROM (
            SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM candidates WHERE m = 3) GROUP BY ALL)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY way.score DESC, a DESC, phrase) AS rank, phrase, a, way.l AS l, way.r AS r, way.score AS score
        FROM best LEFT JOIN covered USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a) JOIN totals USING (lang) WHERE rank <= 2000
""")
def op13_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"), Scratch(spark, "op13"))
