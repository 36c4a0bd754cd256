"""The same results in DuckDB SQL, written independently of the Spark plans.

``CTES`` are named building blocks; ``sql`` puts the ones a query needs, with
what they need in turn, in front of it.
"""

from __future__ import annotations

import re

from plaza.functions.text import KEYWORD_STOPWORDS, SPACE
from plaza.operators import products, topics
from plaza.operators.activity import DEFAULT_SUBREDDITS
from plaza.plans.views import AS_OF, LAST_RUN, RUN_TS

CTES: dict[str, str] = {}
ORACLES: dict[str, str] = {}

# The English stopwords of Spark's StopWordsRemover.
ENGLISH_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while "
    "of at by for with about against between into through during before after above below to from up down in out "
    "on off over under again further then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll "
    "she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's "
    "who's why's would"
).split()

STOP = ", ".join(f"'{w}'" for w in KEYWORD_STOPWORDS)
NEAR = 0.30
ENGLISH = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_WORDS)


def sql(body: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def need(text: str) -> None:
        for name in CTES:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                need(CTES[name])
                order.append(name)

    need(body)
    # A building block may refer to itself.
    recursive = "RECURSIVE " if any("recursion" in n for n in order) else ""
    heads = ",\n".join(f"{n} AS {'' if 'recursion' in n else 'MATERIALIZED '}({CTES[n]})" for n in order)
    return f"WITH {recursive}{heads}\n{body}" if order else body


def oracle(name: str, body: str) -> None:
    ORACLES[name] = sql(body)


# ---- text expressions ----------------------------------------------------------

def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def clean(x: str) -> str:
    t = f"coalesce({x}, '')"
    for pattern, to in [
        (rf"http[^{SPACE}]+", " "), (rf"www\.[^{SPACE}]+", " "), ("([a-z])([A-Z])", r"\1 \2"),
        (rf"[{SPACE}]{{2,}}", " "), (r"[^\x00-\x7F]", ""),
    ]:
        t = f"regexp_replace({t}, '{pattern}', '{to}', 'g')"
    return strip(t)


def key_of(x: str) -> str:
    return f"regexp_replace(lower({strip(x)}), '[{SPACE}]+', ' ', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{SPACE}]+'), lambda w: w <> '')"


def sentence_list(x: str) -> str:
    marked = f"regexp_replace({x}, '([.!?])[{SPACE}]+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"


def as_sentence(x: str) -> str:
    ended = f"CASE WHEN regexp_matches({x}, '[.!?]$') THEN {x} ELSE {x} || '.' END"
    return f"(upper(substr({x}, 1, 1)) || substr({ended}, 2))"


def keyword_tokens(x: str) -> str:
    found = f"regexp_extract_all(lower({x}), '\\b[a-zA-Z0-9\\-'']+\\b')"
    return f"list_filter({found}, lambda t: length(t) > 2 AND t NOT IN ({STOP}))"


def metric_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '\\b[a-zA-Z0-9'']+\\b')"


def title_case(x: str) -> str:
    letter = f"substr({x}, CAST(i AS INT), 1)"
    before = f"substr({x}, CAST(i - 1 AS INT), 1)"
    return (
        f"array_to_string(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches({before}, '[A-Za-z]') "
        f"THEN upper({letter}) ELSE lower({letter}) END), '')"
    )


# ---- views --------------------------------------------------------------------

CTES["posts_v"] = """
SELECT 'p_' || e.event_id AS post_id, 'user_' || e.user_id AS author_id, d.source AS subreddit,
       substr(d.text, 1, 80) AS title, substr(d.text, 81) || ' ' || p.url AS selftext,
       substr(d.text, 1, 80) || chr(10) || chr(10) || substr(d.text, 81) || ' ' || p.url AS content,
       CAST(e.ts AS TIMESTAMP) AS created_at, CAST(floor(e.value) AS INT) AS score,
       CAST(regexp_extract(e.props, '[0-9]+', 0) AS INT) AS num_comments, d.lang AS flair, e.event_id
FROM events e
JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)"""

CTES["users_v"] = """
SELECT u.user_id, u.user_id AS username, [c1.c_mktsegment, c2.c_mktsegment] AS personas, s.subreddits
FROM (SELECT DISTINCT user_id AS k, 'user_' || user_id AS user_id FROM events) u
JOIN customer c1 ON c1.c_custkey = u.k JOIN customer c2 ON c2.c_custkey = u.k + 1
JOIN (SELECT author_id, list_sort(list(DISTINCT subreddit)) AS subreddits FROM posts_v GROUP BY author_id) s ON s.author_id = u.user_id"""

CTES["messy_v"] = """
SELECT user_id, personas, CASE WHEN personas[1] = personas[2] THEN []
       ELSE list_concat(list_concat(list_transform(subreddits, lambda s: upper(s)), ['']), subreddits) END AS subreddits FROM users_v"""

CTES["follows_v"] = """
SELECT DISTINCT 'user_' || user_id AS follower_id, 'user_' || o AS followed_id
FROM (SELECT user_id, (event_id * 31 + 7) % (SELECT count(DISTINCT user_id) FROM events) AS o FROM events) WHERE user_id <> o"""

CTES["runs_v"] = f"""
SELECT DISTINCT author_id AS user_id, 'reddit:' || subreddit AS source, TIMESTAMP '{LAST_RUN}' AS last_run_at
FROM posts_v WHERE created_at < TIMESTAMP '{LAST_RUN}'"""

CTES["vectors_v"] = """
SELECT 'p_' || e.event_id AS post_id, v.vec_id, v.embedding, v.label
FROM events e JOIN embeddings v ON v.vec_id = e.event_id % (SELECT count(*) FROM embeddings)"""

CTES["topics_v"] = """
SELECT DISTINCT label AS topic_id, 'topic ' || label AS topic_title, repeat('s', 295 + label) AS summary_text FROM embeddings
UNION ALL SELECT 99, 'empty topic', NULL"""

CTES["mapping_v"] = "SELECT post_id, label AS topic_id FROM vectors_v"

CTES["topic_posts_v"] = f"""
SELECT p.post_id, p.created_at, p.subreddit, v.label AS topic_index, {clean('p.content')} AS text
FROM posts_v p JOIN vectors_v v USING (post_id)"""

CTES["clean_posts_v"] = f"SELECT subreddit, created_at, post_id, {clean('content')} AS text FROM posts_v"

CTES["docs_v"] = f"SELECT doc_id, {clean('text')} AS topic_text FROM documents"

# ---- activity, budgets, selection -------------------------------------------------

_DEFAULTS = "[" + ", ".join(f"'{s}'" for s in DEFAULT_SUBREDDITS) + "]"


def subscriptions(users: str) -> str:
    return f"""
SELECT user_id, CAST(i - 1 AS INT) AS pos, l[i] AS subreddit FROM (
  SELECT user_id, l, unnest(range(1, len(l) + 1)) AS i FROM (
    SELECT user_id, CASE WHEN len(l) = 0 THEN {_DEFAULTS} ELSE l END AS l FROM (
      SELECT user_id, list_filter(low, lambda s, i: list_position(low, s) = i) AS l FROM (
        SELECT user_id, list_transform(list_filter(subreddits, lambda s: s <> ''), lambda s: lower(s)) AS low FROM {users}))))"""


CTES["subs_v"] = subscriptions("users_v")
CTES["messy_subs_v"] = subscriptions("messy_v")

CTES["activity_v"] = f"""
SELECT subreddit, greatest(0.1, 0.5 * avg(greatest(0, score)) + 0.3 * avg(greatest(0, num_comments)) + 0.2 * (avg(
         greatest(0.0, 1.0 / (1.0 + (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(created_at)) / 86400e6))) * 100.0)) AS activity
FROM (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_at DESC, post_id) AS rn FROM posts_v) WHERE rn <= 12 GROUP BY 1"""


def budget(n: int, subs: str = "subs_v", tag: str = "") -> str:
    """Names the blocks of a budget of ``n`` and returns the last one's name.
    The round robin is simulated post by post."""
    t = f"{n}{tag}"
    CTES[f"shares_{t}"] = f"""
SELECT user_id, list(subreddit ORDER BY pos) AS subs, list(raw ORDER BY pos) AS raws FROM (
  SELECT s.user_id, s.pos, s.subreddit, greatest(0.0001, coalesce(a.activity, 1.0)) AS raw
  FROM {subs} s LEFT JOIN activity_v a USING (subreddit)) GROUP BY 1"""
    CTES[f"base_{t}"] = f"""
SELECT *, {n} - list_sum(base) AS gap FROM (
  SELECT *, list_transform(raws, lambda r: least(40, greatest(5, CAST(round_even(r / total * {n}, 0) AS BIGINT)))) AS base
  FROM (SELECT *, list_sum(raws) AS total FROM shares_{t}))"""
    CTES[f"rows_{t}"] = f"""
SELECT user_id, CAST(i - 1 AS INT) AS pos, subs[i] AS subreddit, raws[i] AS raw, base[i] AS base, gap
FROM (SELECT *, unnest(range(1, len(subs) + 1)) AS i FROM base_{t})"""
    CTES[f"trimmed_{t}"] = f"""
SELECT user_id, pos, subreddit, base - greatest(0, least(base - 5, -gap - coalesce(sum(base - 5) OVER (
         PARTITION BY user_id ORDER BY raw, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS n FROM rows_{t} WHERE gap < 0"""
    CTES[f"recursion_{t}"] = f"""
SELECT user_id, base AS alloc, 0 AS turn, CAST(gap AS BIGINT) AS missing FROM base_{t} WHERE gap > 0
UNION ALL
SELECT user_id, list_transform(alloc, lambda a, i: CASE WHEN i = circle[turn % len(circle) + 1] THEN a + 1 ELSE a END), turn + 1, missing - 1
FROM (SELECT *, list_filter(range(1, len(alloc) + 1), lambda i: alloc[i] < 40) AS circle FROM recursion_{t} WHERE missing > 0) WHERE len(circle) > 0"""
    CTES[f"filled_{t}"] = f"SELECT user_id, arg_max(alloc, turn) AS alloc FROM recursion_{t} GROUP BY 1"
    CTES[f"budget_{t}"] = f"""
SELECT user_id, pos, subreddit, CAST(n AS INT) AS allocated FROM trimmed_{t}
UNION ALL SELECT r.user_id, r.pos, r.subreddit, CAST(f.alloc[r.pos + 1] AS INT) FROM rows_{t} r JOIN filled_{t} f USING (user_id)
UNION ALL SELECT user_id, pos, subreddit, CAST(base AS INT) FROM rows_{t} WHERE gap = 0"""
    return f"budget_{t}"


CTES["ranked_v"] = """
SELECT subreddit, post_id, created_at, row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, created_at DESC, post_id) AS best,
       row_number() OVER (PARTITION BY subreddit ORDER BY created_at DESC, post_id) AS newest FROM posts_v"""


def picks(n: int, since: bool = True) -> str:
    """Selection under a budget of ``n``; names its blocks, returns the last."""
    t = f"{n}{'' if since else '_first'}"
    mark = "m.last_run_at" if since else "CAST(NULL AS TIMESTAMP)"
    CTES[f"wanted_{t}"] = f"""
SELECT b.user_id, b.subreddit, b.allocated, {mark} AS since FROM {budget(n)} b
LEFT JOIN runs_v m ON m.user_id = b.user_id AND m.source = 'reddit:' || b.subreddit"""
    CTES[f"best_{t}"] = f"""
SELECT w.user_id, w.subreddit, w.allocated, w.since, r.post_id, r.created_at, r.best AS k FROM wanted_{t} w JOIN ranked_v r USING (subreddit)
WHERE r.best <= w.allocated AND (w.since IS NULL OR r.created_at > w.since)"""
    CTES[f"extra_{t}"] = f"""
SELECT w.user_id, w.subreddit, w.allocated, w.since, r.post_id, r.created_at, 1000000 + r.newest AS k
FROM wanted_{t} w JOIN ranked_v r USING (subreddit)
LEFT JOIN (SELECT user_id, subreddit, count(*) AS got FROM best_{t} GROUP BY ALL) g USING (user_id, subreddit)
WHERE r.newest <= w.allocated - coalesce(g.got, 0) AND (w.since IS NULL OR r.created_at > w.since)
  AND (w.user_id, r.post_id) NOT IN (SELECT (user_id, post_id) FROM best_{t})"""
    CTES[f"picks_{t}"] = f"""
SELECT user_id, subreddit, post_id, created_at, position FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id, subreddit ORDER BY k) - 1 AS INT) AS position
  FROM (SELECT * FROM best_{t} UNION ALL SELECT * FROM extra_{t})) WHERE position < allocated"""
    return f"picks_{t}"


P100 = picks(100)
B100 = budget(100)

# ---- topics and products ------------------------------------------------------------


def topic_text_of(rows: str, by: str, order: str, unique: bool) -> str:
    once = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by}, text ORDER BY {order}) AS copy FROM {rows} WHERE text <> '') WHERE copy = 1"
    plain = f"SELECT * FROM {rows} WHERE text <> ''"
    return f"""
SELECT {by}, substr(string_agg({as_sentence('text')}, ' ' ORDER BY {order}), 1, {topics.TOPIC_TEXT_CHARS}) AS topic_text
FROM ({once if unique else plain}) GROUP BY {by}"""


def near(a: str, b: str, hundredths: int) -> str:
    common = f"len(list_intersect({a}, {b}))"
    return f"({common} > 0 AND {common} * {common} * 10000 >= {hundredths * hundredths} * len({a}) * len({b}))"


def summary_blocks(tag: str, rows: str, by: str, order: str) -> str:
    """Extractive summary of ``rows`` (``by..., order..., text``, one per post); returns the last block."""
    place = f"{order}, si"
    CTES[f"sent_{tag}"] = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by}, {key_of('sentence')} ORDER BY {place}) AS copy FROM (
  SELECT {by}, {order}, i - 1 AS si, l[i] AS sentence FROM (SELECT {by}, {order}, l, unnest(range(1, len(l) + 1)) AS i FROM (
    SELECT {by}, {order}, {sentence_list(as_sentence('text'))} AS l FROM {rows} WHERE text <> '')))) WHERE copy = 1"""
    CTES[f"words_{tag}"] = f"SELECT {by}, {place}, unnest(list_distinct({keyword_tokens('sentence')})) AS word FROM sent_{tag}"
    CTES[f"rare_{tag}"] = f"""
SELECT word, CAST(round(ln(((SELECT count(*) FROM sent_{tag}) + 1.0) / (count(*) + 1.0)) * 1000) AS BIGINT) AS rarity FROM words_{tag} GROUP BY word"""
    CTES[f"uses_{tag}"] = f"SELECT {by}, word, count(*) AS tf FROM words_{tag} GROUP BY ALL"
    CTES[f"scored_{tag}"] = f"""
SELECT {by}, {place}, CAST(floor(sum(tf * rarity) / count(*)) AS BIGINT) AS score
FROM words_{tag} JOIN uses_{tag} USING ({by}, word) JOIN rare_{tag} USING (word) GROUP BY {by}, {place}"""
    CTES[f"rest_{tag}_0"] = f"""
SELECT {by}, {place}, sentence, coalesce(score, 0) AS score, list_distinct({keyword_tokens('sentence')}) AS ws
FROM sent_{tag} LEFT JOIN scored_{tag} USING ({by}, {place})"""
    for k in range(products.SUMMARY_SENTENCES):
        CTES[f"pick_{tag}_{k}"] = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, {place}) AS rn FROM rest_{tag}_{k}) WHERE rn = 1"""
        apart = " AND ".join(f"r.{c.strip()} IS NOT DISTINCT FROM p.{c.strip()}" for c in place.split(","))
        CTES[f"rest_{tag}_{k + 1}"] = f"""
SELECT r.* FROM rest_{tag}_{k} r JOIN pick_{tag}_{k} p USING ({by}) WHERE NOT ({apart}) AND NOT {near('r.ws', 'p.ws', products.SIMILAR_SENTENCES)}"""
    picked = " UNION ALL ".join(f"SELECT {by}, {place}, sentence FROM pick_{tag}_{k}" for k in range(products.SUMMARY_SENTENCES))
    CTES[f"made_{tag}"] = f"SELECT {by}, string_agg(sentence, ' ' ORDER BY {place}) AS summary FROM ({picked}) GROUP BY {by}"
    CTES[f"summary_{tag}"] = f"""
SELECT {by}, coalesce(nullif(m.summary, ''), CASE WHEN r.had THEN '{products.NO_SUMMARY}' ELSE '{products.NO_CONTENT}' END) AS summary
FROM (SELECT {by}, max(coalesce(text, '') <> '') AS had FROM {rows} GROUP BY {by}) r LEFT JOIN made_{tag} m USING ({by})"""
    return f"summary_{tag}"


def keyword_blocks(tag: str, rows: str, by: str, text: str) -> str:
    CTES[f"ranked_words_{tag}"] = f"""
SELECT {by}, keyword, n, CAST(row_number() OVER (PARTITION BY {by} ORDER BY n DESC, first) AS INT) AS keyword_rank FROM (
  SELECT {by}, l[i] AS keyword, count(*) AS n, min(i) AS first FROM (
    SELECT {by}, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT {by}, {keyword_tokens(text)} AS l FROM {rows})) GROUP BY ALL)"""
    return f"ranked_words_{tag}"


def title_blocks(tag: str, rows: str, by: str, given: str = "''") -> str:
    words_of = keyword_blocks(tag, rows, by, "summary")
    tidy = f"regexp_replace(regexp_replace(regexp_replace({given}, 'http[^{SPACE}]+', ' ', 'g'), '[^A-Za-z0-9{SPACE}\\-]', ' ', 'g'), '[{SPACE}]+', ' ', 'g')"
    opening = strip(f"regexp_extract(summary, '^[^.!?]*', 0)")
    CTES[f"parts_{tag}"] = f"""
SELECT {by}, given, from_words, array_to_string(list_filter(regexp_extract_all({opening}, '\\w+'), lambda w: length(w) > 2)[1:7], ' ') AS opening FROM (
  SELECT {by}, r.summary, {strip(tidy)} AS given, k.from_words FROM {rows} r
  LEFT JOIN (SELECT {by}, string_agg(keyword, ' ' ORDER BY keyword_rank) AS from_words FROM {words_of} WHERE keyword_rank <= 7 GROUP BY {by}) k USING ({by}))"""
    generic = f"(regexp_matches(lower(given), '^(list of|this is|a list of|the list of|bullets|list:)') OR len({words('given')}) < 2)"
    CTES[f"title_{tag}"] = f"""
SELECT {by}, coalesce(CASE WHEN NOT {generic} THEN {title_case("array_to_string(" + words('given') + "[1:7], ' ')")} END,
  nullif({title_case('from_words')}, ''), nullif({title_case('opening')}, ''), '{products.DEFAULT_TITLE}') AS title FROM parts_{tag}"""
    return f"title_{tag}"


def bullet_list(x: str) -> str:
    unmarked = strip("regexp_replace(s, '^[^A-Za-z0-9_]+', '')")
    bare = f"list_transform({sentence_list(x)}, lambda s: {unmarked})"
    return f"list_filter({bare}, lambda s: len({words('s')}) >= 3)"


CTES["topic_text_v"] = topic_text_of("topic_posts_v", "subreddit, topic_index", "created_at, post_id", True)
SUMMARY = summary_blocks("topics", "topic_posts_v", "subreddit, topic_index", "created_at, post_id")

# ---- oracles ---------------------------------------------------------------------

_USER_FIELDS = "user_id, username, array_to_string(personas, '|') AS personas, array_to_string(subreddits, '|') AS subreddits"
_MARK = f"TIMESTAMP '{LAST_RUN}'"
_RUN = f"TIMESTAMP '{RUN_TS}'"

oracle("read_users", f"SELECT {_USER_FIELDS} FROM users_v")
oracle("append_table", f"SELECT {_USER_FIELDS} FROM users_v")
oracle("list_users", f"SELECT {_USER_FIELDS} FROM users_v")
oracle("read_follows", "SELECT follower_id, followed_id FROM follows_v")
oracle("read_edgelist", "SELECT follower_id, followed_id FROM follows_v")
oracle("write_edgelist", "SELECT follower_id || ' ' || followed_id AS line FROM follows_v")
oracle("read_posts_landed", """
SELECT post_id, author_id, subreddit, title, selftext, title || chr(10) || chr(10) || selftext AS content, created_us, score, num_comments, flair FROM (
  SELECT 'reddit_' || event_id AS post_id, CASE WHEN flair <> 'de' THEN author_id END AS author_id, subreddit,
         CASE WHEN flair <> 'fr' THEN title ELSE '' END AS title, CASE WHEN flair <> 'es' THEN selftext ELSE '' END AS selftext,
         epoch_us(created_at) AS created_us, score, num_comments, flair FROM posts_v)""")
oracle("scan_table", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0")
oracle("rows_with_schema", "SELECT post_id, subreddit, content, CAST(created_at AS VARCHAR) AS created_at, score, num_comments FROM posts_v")
oracle("user_subreddits", "SELECT user_id, pos, subreddit FROM messy_subs_v")
oracle("last_high_water_mark", """
SELECT s.user_id, s.subreddit, 'reddit:' || s.subreddit AS source, epoch_us(r.last_run_at) AS since_us
FROM subs_v s LEFT JOIN runs_v r ON r.user_id = s.user_id AND r.source = 'reddit:' || s.subreddit""")

oracle("write_json", "SELECT post_id, author_id, subreddit, content, epoch_us(created_at) AS created_us, score, num_comments FROM posts_v")
oracle("insert_if_absent", f"SELECT post_id, epoch_us(created_at) AS created_us, CASE WHEN created_at < {_MARK} THEN -1 ELSE score END AS score FROM posts_v")
oracle("ensure_authors", """
SELECT DISTINCT author_id AS user_id, author_id AS username, 0 AS n_personas, 0 AS n_subreddits FROM posts_v
WHERE author_id NOT IN (SELECT user_id FROM users_v WHERE NOT list_contains(personas, 'BUILDING'))""")
oracle("upsert_latest", f"""
SELECT user_id, source, epoch_us(coalesce(n.last_run_at, o.last_run_at)) AS last_run_us, coalesce(n.post_count, 0) AS post_count FROM runs_v o
FULL JOIN (SELECT author_id AS user_id, 'reddit:' || subreddit AS source, max(created_at) AS last_run_at, count(*) AS post_count
           FROM posts_v WHERE created_at > {_MARK} GROUP BY ALL) n USING (user_id, source)""")
oracle("append_outputs", f"""
SELECT sha256(user_id || '|' || source || '|' || '{RUN_TS}') AS output_id, user_id, source, epoch_us({_RUN}) AS created_us,
       CAST(to_json({{'user_id': user_id, 'source': source, 'post_count': n, 'post_ids': ids}}) AS VARCHAR) AS payload_json
FROM (SELECT user_id, 'reddit:' || subreddit AS source, count(*) AS n, list(post_id ORDER BY position) AS ids FROM {P100} GROUP BY ALL)""")
oracle("append_feed_cache", f"""
SELECT sha256(user_id || '|reddit|{RUN_TS}') AS cache_id, user_id, 'reddit' AS platform, epoch_us({_RUN}) AS fetched_us, CAST(count(*) AS INT) AS n_posts,
       string_agg(post_id, '|' ORDER BY subreddit, post_id) AS post_ids, count(*) || ' posts' AS summary, 0 AS n_topics, '100' AS requested FROM {P100} GROUP BY user_id""")
oracle("append_run_log", f"""
SELECT sha256(u.user_id || '|reddit|{RUN_TS}') AS run_id, u.user_id, 'reddit' AS platform, CASE WHEN n >= 100 THEN 'success' ELSE 'failed' END AS run_status,
       epoch_us({_RUN}) AS fetched_us, CASE WHEN n >= 100 THEN 'cache_id=' || sha256(u.user_id || '|reddit|{RUN_TS}') ELSE 'no cache row stored' END AS notes
FROM users_v u LEFT JOIN (SELECT user_id, count(*) AS n FROM {P100} GROUP BY 1) p USING (user_id)""")
CTES["samples_v"] = """
SELECT subreddit, topic_index, count(*) AS n_samples, string_agg(text, ' ||| ' ORDER BY created_at, post_id) AS sample_posts FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit, topic_index ORDER BY created_at, post_id) AS rn FROM (
    SELECT *, row_number() OVER (PARTITION BY subreddit, topic_index, text ORDER BY created_at, post_id) AS copy FROM topic_posts_v WHERE text <> '') WHERE copy = 1)
WHERE rn <= 3 GROUP BY 1, 2"""
_TOPIC_ID = f"sha256('|reddit:' || subreddit || '|{RUN_TS}|' || topic_index)"
oracle("persist_topics", f"""
SELECT {_TOPIC_ID} AS topic_id, '' AS user_id, 'reddit:' || subreddit AS source, topic_index, 'topic ' || topic_index AS topic_title, sample_posts, n_posts
FROM samples_v JOIN (SELECT subreddit, topic_index, count(*) AS n_posts FROM topic_posts_v GROUP BY 1, 2) USING (subreddit, topic_index)""")
CTES["kept_users_v"] = "SELECT * FROM users_v WHERE NOT list_contains(personas, 'BUILDING')"
oracle("enforce_keys", """
SELECT 'users' AS table_name, 'in' AS state, 2 * count(*) AS n_rows FROM kept_users_v
UNION ALL SELECT 'users', 'kept', count(*) FROM kept_users_v
UNION ALL SELECT 'follows', 'in', count(*) FROM follows_v
UNION ALL SELECT 'follows', 'kept', count(*) FROM follows_v WHERE follower_id IN (SELECT user_id FROM kept_users_v) AND followed_id IN (SELECT user_id FROM kept_users_v)
UNION ALL SELECT 'posts', 'in', 2 * count(*) FROM posts_v
UNION ALL SELECT 'posts', 'kept', count(*) FROM posts_v WHERE subreddit = 'src0' OR author_id IN (SELECT user_id FROM kept_users_v)
UNION ALL SELECT 'feed_runs', 'in', count(*) FROM runs_v
UNION ALL SELECT 'feed_runs', 'kept', count(*) FROM runs_v
UNION ALL SELECT 'feed_runs', 'with user', count(*) FROM runs_v WHERE user_id IN (SELECT user_id FROM kept_users_v)""")
oracle("create_reset_tables", """
SELECT 'users' AS table_name, 'loaded' AS state, count(*) AS n_rows FROM users_v
UNION ALL SELECT 'follows', 'loaded', count(*) FROM follows_v
UNION ALL SELECT unnest(['users', 'follows', 'posts', 'live_feed_runs', 'live_feed_cache', 'live_outputs', 'live_runs', 'live_topics',
  'live_post_topic_mapping', 'live_analysis_state']), 'reset', 0""")

oracle("normalize_created_at", f"""
SELECT event_id, CASE event_type WHEN 'view' THEN epoch_us(ts) WHEN 'signup' THEN epoch_us(ts) WHEN 'click' THEN epoch_us(ts) - 7200000000
  ELSE epoch_us({_RUN}) END AS created_us FROM events""")
oracle("post_content", """
SELECT post_id, CASE WHEN flair = 'en' THEN content ELSE CASE WHEN flair <> 'fr' THEN title ELSE '' END || chr(10) || chr(10) || selftext END AS content FROM posts_v""")
oracle("cleaned_content", "SELECT post_id, replace(lower(content), chr(10), ' ') AS cleaned_content FROM posts_v")
oracle("clean_text", f"SELECT post_id, {clean('content')} AS text FROM posts_v")
oracle("post_ids_default", """
SELECT event_id, subreddit, CASE WHEN flair = 'en' THEN post_id
  ELSE 'generated_' || (row_number() OVER (PARTITION BY subreddit ORDER BY created_at, event_id) - 1) END AS post_id FROM posts_v""")
oracle("since_filter", """
SELECT p.post_id, p.author_id AS user_id, 'reddit:' || p.subreddit AS source FROM posts_v p
LEFT JOIN runs_v r ON r.user_id = p.author_id AND r.source = 'reddit:' || p.subreddit WHERE r.last_run_at IS NULL OR p.created_at > r.last_run_at""")
oracle("eda_inputs", """
SELECT post_id, CASE WHEN flair = 'en' THEN score ELSE 0 END AS score, CASE WHEN flair <> 'en' THEN num_comments ELSE 0 END AS num_comments FROM posts_v""")
oracle("topic_snippet", """
SELECT topic_id, count(post_id) AS "Posts", topic_title AS "Title",
  CASE WHEN length(summary_text) > 300 THEN substr(summary_text, 1, 300) || '...' ELSE coalesce(summary_text, '') END AS "Summary"
FROM topics_v LEFT JOIN mapping_v USING (topic_id) GROUP BY topic_id, topic_title, summary_text""")
oracle("topic_post_counts", """
SELECT topic_id, topic_title, count(post_id) AS post_count FROM topics_v LEFT JOIN mapping_v USING (topic_id) GROUP BY topic_id, topic_title ORDER BY post_count DESC""")
oracle("point_lookup", "SELECT post_id, author_id, subreddit, title FROM posts_v WHERE author_id = 'user_7'")

oracle("topics_left_join_mapping", "SELECT topic_id, topic_title, post_id FROM topics_v LEFT JOIN mapping_v USING (topic_id)")
oracle("anti_existing", "SELECT post_id, score FROM posts_v WHERE score < 100")
oracle("except_existing", """
SELECT post_id, author_id FROM posts_v WHERE author_id NOT IN (SELECT user_id FROM users_v WHERE list_contains(personas, 'BUILDING'))""")
oracle("semi_referential", """
SELECT follower_id, followed_id FROM follows_v WHERE followed_id IN (SELECT user_id FROM users_v WHERE list_contains(personas, 'BUILDING'))""")
oracle("posts_to_topic_ids", f"""
SELECT sha256(topic_ref || '|' || post_ref) AS mapping_id, * FROM (
  SELECT 'reddit:' || subreddit AS source, post_id AS post_ref, {_TOPIC_ID} AS topic_ref FROM (
    SELECT p.post_id, p.subreddit, v.label AS topic_index FROM posts_v p JOIN vectors_v v USING (post_id)))""")
MESSY100 = budget(100, "messy_subs_v", "_messy")
oracle("attach_allocations", f"""
SELECT p.user_id, p.subreddit, coalesce(b.allocated, 0) AS allocated FROM (SELECT DISTINCT author_id AS user_id, subreddit FROM posts_v) p
LEFT JOIN {MESSY100} b USING (user_id, subreddit)""")
CTES["psets_v"] = "SELECT user_id, list_sort(list_distinct(personas)) AS s FROM users_v"
oracle("persona_overlap_pairs", """
SELECT set_a, set_b, weight, count(*) AS n_pairs FROM (
  SELECT array_to_string(a.s, '|') AS set_a, CASE WHEN list_has_any(a.s, b.s) THEN array_to_string(b.s, '|') END AS set_b,
         CASE WHEN list_has_any(a.s, b.s) THEN 5 ELSE 1 END AS weight
  FROM psets_v a JOIN psets_v b ON a.user_id <> b.user_id) GROUP BY ALL""")
oracle("similarity_join", f"""
SELECT a.label, a.vec_id AS id_a, b.vec_id AS id_b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id
WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= {NEAR}""")

oracle("post_count", "SELECT count(*) AS post_count FROM posts_v")
oracle("posts_by_subreddit", "SELECT subreddit, count(*) AS post_count FROM posts_v GROUP BY 1")
oracle("avg_post_length", "SELECT round(avg(length(content)), 6) AS avg_post_length FROM posts_v")
for _name, _column in (("score_stats", "score"), ("comment_stats", "num_comments")):
    oracle(_name, f"SELECT round(avg({_column}), 6) AS avg, quantile_disc({_column}, 0.5) AS median, round(stddev_samp({_column}), 6) AS stddev FROM posts_v")
oracle("global_eda", """
SELECT count(*) AS post_count, round(avg(length(content)), 6) AS avg_post_length,
  round(avg(score), 6) AS score_avg, quantile_disc(score, 0.5) AS score_median, round(stddev_samp(score), 6) AS score_stddev,
  round(avg(num_comments), 6) AS num_comments_avg, quantile_disc(num_comments, 0.5) AS num_comments_median,
  round(stddev_samp(num_comments), 6) AS num_comments_stddev FROM posts_v""")


def top_terms_of(text: str, rows: str) -> str:
    return f"""
SELECT token, count(*) AS term_count FROM (SELECT unnest(regexp_split_to_array(lower({text}), '[ \\t\\n\\x0b\\f\\r]')) AS token FROM {rows})
WHERE token <> '' AND token NOT IN ({ENGLISH}) GROUP BY 1 ORDER BY term_count DESC, token LIMIT 40"""


oracle("top_terms", top_terms_of("text", "clean_posts_v"))
oracle("global_top_terms", top_terms_of("topic_text", "docs_v"))
oracle("term_features", f"""
SELECT post_id, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END AS norm, n AS n_terms FROM (
  SELECT post_id, len(list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0b\\f\\r]'), lambda t: t <> '' AND t NOT IN ({ENGLISH}))) AS n FROM clean_posts_v)""")
oracle("subreddit_eda", "SELECT subreddit, count(*) AS post_count, round(avg(score), 6) AS avg_score, round(avg(num_comments), 6) AS avg_comments FROM posts_v GROUP BY 1")
oracle("community_activity", """
SELECT s.subreddit, round(coalesce(a.activity, 1.0), 6) AS activity FROM (SELECT DISTINCT subreddit FROM messy_subs_v) s LEFT JOIN activity_v a USING (subreddit)""")
oracle("topic_members", """
SELECT p.subreddit, v.label AS topic_index, p.post_id, row_number() OVER (PARTITION BY p.subreddit, v.label ORDER BY p.created_at, p.post_id) - 1 AS member_position
FROM posts_v p JOIN vectors_v v USING (post_id)""")
oracle("run_totals", f"SELECT user_id, count(*) AS post_count, count(DISTINCT subreddit) AS n_communities FROM {P100} GROUP BY 1")
oracle("feed_meta", f"""
SELECT b.user_id, 100 AS requested_total, coalesce(any_value(p.n), 0) AS actual_fetched_total,
  string_agg(b.subreddit || '=' || b.allocated, '|' ORDER BY b.subreddit) AS allocations,
  string_agg(b.subreddit || '=' || CAST(round(coalesce(a.activity, 1.0) * 1000) AS BIGINT), '|' ORDER BY b.subreddit) AS activity_map
FROM {B100} b LEFT JOIN activity_v a USING (subreddit) LEFT JOIN (SELECT user_id, count(*) AS n FROM {P100} GROUP BY 1) p ON p.user_id = b.user_id GROUP BY 1""")
oracle("graph_stats", "SELECT (SELECT count(DISTINCT user_id) FROM users_v) AS n_nodes, (SELECT count(*) FROM follows_v) AS n_edges")
oracle("out_degree", "SELECT follower_id AS user_id, count(*) AS out_degree FROM follows_v GROUP BY 1")

oracle("latest_per_key", """
SELECT author_id, subreddit, post_id FROM (
  SELECT *, row_number() OVER (PARTITION BY author_id, subreddit ORDER BY created_at DESC, post_id DESC) AS rn FROM posts_v) WHERE rn = 1""")
oracle("rank_in_community", "SELECT subreddit, post_id, row_number() OVER (PARTITION BY subreddit ORDER BY created_at, post_id) - 1 AS position FROM posts_v")
for _name, _n in (("allocate_budget", 100), ("allocate_budget_fill", 500), ("allocate_budget_clamped", 700), ("allocate_budget_saturated", 900)):
    oracle(_name, f"SELECT user_id, pos, subreddit, allocated FROM {budget(_n)}")
oracle("first_occurrence", f"""
SELECT subreddit, post_id FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit, k ORDER BY created_at, post_id) AS rn FROM (
    SELECT subreddit, post_id, created_at, {key_of('t')} AS k FROM (SELECT *, {clean('content')} AS t FROM posts_v)) ) WHERE rn = 1""")
oracle("flat_feed", f"""
SELECT user_id, feed_rank, post_id FROM (
  SELECT user_id, post_id, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, post_id) AS feed_rank FROM {picks(50, False)}) WHERE feed_rank <= 50""")
oracle("select_posts", f"SELECT user_id, subreddit, position, post_id FROM {P100}")
oracle("select_posts_first_run", f"SELECT user_id, subreddit, position, post_id FROM {picks(700, False)}")
oracle("union_posts", "SELECT subreddit, post_id, score, CASE WHEN flair = 'en' THEN 'one' ELSE 'other' END AS branch FROM posts_v")
oracle("distinct_ordered", f"""
SELECT subreddit, topic_index, post_id, length({as_sentence('text')}) AS n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit, topic_index, text ORDER BY created_at, post_id) AS copy FROM topic_posts_v WHERE text <> '') WHERE copy = 1""")
oracle("token_intersection", f"""
SELECT DISTINCT subreddit, unnest({metric_tokens(clean('title'))}) AS token FROM posts_v
INTERSECT SELECT DISTINCT subreddit, unnest({metric_tokens(clean('selftext'))}) FROM posts_v""")
oracle("sample_posts", "SELECT subreddit, topic_index, n_samples, sample_posts FROM samples_v")
oracle("topk_terms_per_topic", f"""
SELECT subreddit, topic_index, keyword, n, keyword_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit, topic_index ORDER BY n DESC, keyword) AS keyword_rank FROM (
    SELECT subreddit, topic_index, keyword, count(*) AS n FROM (
      SELECT subreddit, topic_index, unnest({keyword_tokens('text')}) AS keyword FROM topic_posts_v) GROUP BY ALL)) WHERE keyword_rank <= 8""")

oracle("scalar_text", f"""
SELECT doc_id, lower(c) AS lowered, upper(source) AS uppered, upper(substr(lower(c), 1, 1)) || substr(lower(c), 2) AS capitalized,
  {title_case("('fine-tuning ' || lower(c) || ' 3d')")} AS titled, length(c) AS n_chars, c AS ascii, starts_with(source, 'src1') AS is_src1,
  substr(source, 4) AS number, len({words('c')}) AS n_words, CASE WHEN c = '' THEN '.' ELSE {as_sentence('c')} END AS sentence
FROM (SELECT doc_id, source, topic_text AS c FROM documents JOIN docs_v USING (doc_id))""")
oracle("scalar_time", f"""
SELECT event_id, epoch_us(ts) AS back_us, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 86400e6, 6) AS age_days,
  round(1.0 / (1.0 + (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 86400e6), 6) AS recency FROM events""")
oracle("scalar_math", """
SELECT vec_id, CAST(round_even(vec_id / 2, 0) AS BIGINT) AS half_even, greatest(0.1::DOUBLE, least(0.5::DOUBLE, round(e[1], 4))) AS clamped,
  round(sqrt(list_dot_product(e, e)), 6) AS norm, round(list_dot_product(e, list_reverse(e)), 6) AS dot
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)""")
oracle("scalar_array", """
SELECT user_id, len(list_distinct(subreddits)) AS n_distinct, array_to_string(list_filter(['src1', 'src2'], lambda s: list_contains(subreddits, s)), '|') AS shared,
  list_has_any(personas, ['BUILDING', 'MACHINERY']) AS overlaps, array_to_string(subreddits[1:3], '|') AS first_three, list_contains(subreddits, 'src3') AS in_src3 FROM messy_v""")
oracle("scalar_map_json", """
SELECT event_id, '{"k":' || k || '}' AS props_json, k, CASE WHEN event_type = 'view' THEN k ELSE -1 END AS views,
  CASE WHEN event_type = 'error' THEN 'none' ELSE event_type END AS kind, 0 AS n_missing
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)""")

oracle("embed_posts", """
SELECT post_id, vec_id, len(embedding) AS dims, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm FROM vectors_v""")
_TIERS = "CASE WHEN n <= 10 THEN 1 WHEN n <= 20 THEN 2 WHEN n <= 40 THEN 3 WHEN n <= 80 THEN 4 ELSE least(6, greatest(4, n // 20)) END"
oracle("num_topics", f"SELECT author_id, n AS n_posts, CAST({_TIERS} AS INT) AS num_topics FROM (SELECT author_id, count(*) AS n FROM posts_v GROUP BY 1)")
oracle("topic_mode", f"""
SELECT subreddit, flair, num_comments, CAST({_TIERS} AS INT) AS num_topics, CASE WHEN n <= 20 THEN 'single' ELSE 'cluster' END AS mode
FROM (SELECT subreddit, flair, num_comments, count(*) AS n FROM posts_v GROUP BY ALL)""")
CTES["centroids_v"] = """
SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY 1, 2) GROUP BY 1"""
oracle("assign_nearest_centroid", """
SELECT v.post_id, n.topic_index FROM vectors_v v JOIN (
  SELECT vec_id, arg_min(c.label, list_distance(CAST(e.embedding AS DOUBLE[]), c.c)) AS topic_index FROM embeddings e, centroids_v c GROUP BY 1) n USING (vec_id)""")
oracle("kmeans_topics", f"""
SELECT subreddit, n AS n_posts, CAST({_TIERS} AS INT) AS n_topics, 0 AS n_misplaced FROM (SELECT subreddit, count(*) AS n FROM posts_v GROUP BY 1) WHERE n > 20""")
oracle("topic_text", "SELECT subreddit, topic_index, topic_text FROM topic_text_v")
oracle("topic_text_single", topic_text_of("clean_posts_v", "subreddit", "created_at, post_id", False))
oracle("chunk_text", f"""
SELECT doc_id, CAST(i AS INT) AS chunk_index, substr(topic_text, CAST(i * {products.CHUNK_CHARS} + 1 AS INT), {products.CHUNK_CHARS}) AS chunk FROM (
  SELECT *, unnest(range(0, (length(topic_text) + {products.CHUNK_CHARS - 1}) // {products.CHUNK_CHARS})) AS i FROM docs_v)""")
CTES["doc_sentences_v"] = f"""
SELECT doc_id, CAST(i - 1 AS INT) AS sentence_index, l[i] AS sentence FROM (
  SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {sentence_list('topic_text')} AS l FROM docs_v))"""
oracle("split_sentences", "SELECT doc_id, sentence_index, sentence FROM doc_sentences_v")
oracle("dedupe_exact", f"""
SELECT doc_id, sentence_index, sentence FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, {key_of('sentence')} ORDER BY sentence_index) AS rn FROM doc_sentences_v) WHERE rn = 1""")
CTES["numbered_v"] = "SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings"
CTES["earlier_v"] = f"""
SELECT b.label, b.rn, b.vec_id, coalesce(list(a.vec_id) FILTER (a.vec_id IS NOT NULL), []) AS close FROM numbered_v b
LEFT JOIN numbered_v a ON a.label = b.label AND a.rn < b.rn AND list_cosine_similarity(a.e, b.e) >= {NEAR} GROUP BY ALL"""
CTES["recursion_keep"] = """
SELECT label, 0 AS step, CAST([] AS BIGINT[]) AS kept FROM (SELECT DISTINCT label FROM embeddings)
UNION ALL SELECT r.label, r.step + 1, CASE WHEN list_has_any(r.kept, n.close) THEN r.kept ELSE list_append(r.kept, n.vec_id) END
FROM recursion_keep r JOIN earlier_v n ON n.label = r.label AND n.rn = r.step + 1"""
oracle("dedupe_similar", "SELECT label, unnest(kept) AS vec_id FROM (SELECT label, arg_max(kept, step) AS kept FROM recursion_keep GROUP BY 1)")
oracle("extractive_summary", f"SELECT subreddit, topic_index, summary FROM {SUMMARY}")
oracle("keywords", f"SELECT doc_id, keyword, n, keyword_rank FROM {keyword_blocks('docs', 'docs_v', 'doc_id', 'topic_text')} WHERE keyword_rank <= 8")
oracle("topic_title", f"SELECT subreddit, topic_index, title FROM {title_blocks('topics', SUMMARY, 'subreddit, topic_index')}")
CTES["given_v"] = f"SELECT doc_id, topic_text AS summary, array_to_string({words('topic_text')}[1:doc_id % 10], ' ') AS proposed FROM docs_v"
oracle("topic_title_given", f"SELECT doc_id, title FROM {title_blocks('given', 'given_v', 'doc_id', 'r.proposed')}")
def bullets_of(l: str) -> str:
    """The bullets apart from each other, at most three."""
    once = f"list_filter({l}, lambda s, i: list_position(list_transform({l}, lambda x: {key_of('x')}), {key_of('s')}) = i)"
    told = near(f"list_distinct({keyword_tokens('u')})", f"list_distinct({keyword_tokens('b[1]')})", products.SIMILAR_BULLETS)
    apart = f"list_reduce(list_transform({once}, lambda s: [s]), lambda a, b: CASE WHEN len(list_filter(a, lambda u: {told})) > 0 THEN a ELSE list_concat(a, b) END)"
    return f"CASE WHEN len({l}) = 0 THEN CAST([] AS VARCHAR[]) ELSE {apart}[1:3] END"


CTES["bullets_v"] = f"""
SELECT subreddit, topic_index, {bullets_of('l')} AS l
FROM (SELECT subreddit, topic_index, {bullet_list('summary')} AS l FROM {SUMMARY})"""
oracle("topic_bullets", f"""
SELECT subreddit, topic_index, CAST(i - 1 AS INT) AS bullet_index, array_to_string({words('l[i]')}[1:30], ' ') AS bullet
FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM bullets_v)""")
CTES["lines_v"] = """
SELECT doc_id, CAST(i - 1 AS INT) AS line_index, l[i] AS line, i = 1 AS is_first FROM (
  SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (
    SELECT doc_id, regexp_split_to_array(text, '\\n') AS l FROM documents))"""
_LINE = f"regexp_replace({strip('line')}, '^[-•*\\s]+', '')"
oracle("bullet_clean", f"""
SELECT doc_id, line_index, bullet FROM (
  SELECT doc_id, line_index, {strip(f"regexp_replace(b, '[{SPACE}]{{2,}}', ' ', 'g')")} AS bullet FROM (
    SELECT doc_id, line_index, CASE WHEN is_first THEN {_LINE} ELSE {strip('line')} END AS b FROM lines_v)) WHERE bullet <> ''""")
oracle("summary_metrics", f"""
SELECT subreddit, topic_index, round_even(greatest(coalesce(s_all, 0), 1) / greatest(coalesce(o_all, 0), 1), 4) AS compression_ratio,
  round_even(coalesce(shared, 0) / greatest(coalesce(o_distinct, 0), 1), 4) AS lexical_overlap, CAST(greatest(coalesce(s_all, 0), 1) AS INT) AS summary_length
FROM {SUMMARY} LEFT JOIN (
  SELECT subreddit, topic_index, sum(o) AS o_all, sum(s) AS s_all, count(*) FILTER (o > 0) AS o_distinct, count(*) FILTER (o > 0 AND s > 0) AS shared FROM (
    SELECT subreddit, topic_index, token, count(*) FILTER (side = 'o') AS o, count(*) FILTER (side = 's') AS s FROM (
      SELECT subreddit, topic_index, 'o' AS side, unnest({metric_tokens('text')}) AS token FROM topic_posts_v
      UNION ALL SELECT subreddit, topic_index, 's', unnest({metric_tokens('summary')}) FROM {SUMMARY}) GROUP BY ALL) GROUP BY 1, 2) USING (subreddit, topic_index)""")

# The run: topics per list of posts, summaries weighed over all lists; users who picked the same posts have the same list.
def picked_lists(name: str, picks: str) -> None:
    CTES[f"{name}_lists_v"] = f"""
SELECT user_id, subreddit, count(*) AS n, subreddit || '/' || string_agg(post_id, ',' ORDER BY position) AS pick FROM {picks} GROUP BY 1, 2"""


picked_lists("run", P100)
CTES["run_rows_v"] = f"""
SELECT DISTINCT r.pick, k.position, c.text, c.post_id
FROM {P100} k JOIN run_lists_v r USING (user_id, subreddit) JOIN clean_posts_v c USING (post_id)"""
RUN_SUMMARY = summary_blocks("run", "run_rows_v", "pick", "position")
RUN_TITLE = title_blocks("run", RUN_SUMMARY, "pick")
CTES["run_bullets_v"] = f"""
SELECT pick, array_to_string(list_transform(
    {bullets_of('l')},
    lambda b: array_to_string({words('b')}[1:30], ' ')), '|') AS bullets
FROM (SELECT pick, {bullet_list('summary')} AS l FROM {RUN_SUMMARY})"""
oracle("run_payload", f"""
SELECT b.user_id, 'reddit:subreddit_analysis' AS source, 100 AS top_n_total, b.subreddit, b.allocated, coalesce(p.n, 0) AS post_count,
  CASE WHEN p.n > 0 THEN 1 ELSE 0 END AS n_topics, CASE WHEN p.n > 0 THEN 0 END AS topic_index, t.title, u.bullets,
  coalesce(p.n, 0) AS n_placed, round(p.s, 6) AS avg_score
FROM {B100} b LEFT JOIN (SELECT k.user_id, k.subreddit, count(*) AS n, avg(v.score) AS s FROM {P100} k JOIN posts_v v USING (post_id) GROUP BY 1, 2) p USING (user_id, subreddit)
LEFT JOIN run_lists_v r USING (user_id, subreddit) LEFT JOIN {RUN_TITLE} t USING (pick) LEFT JOIN run_bullets_v u USING (pick)""")
_PLANNED = f"CASE WHEN n <= {topics.SINGLE_TOPIC_LIMIT} THEN 1 WHEN n <= 40 THEN 3 WHEN n <= 80 THEN 4 ELSE least(6, greatest(4, n // 20)) END"
oracle("run_payload_clustered", f"""
SELECT user_id, subreddit, allocated, coalesce(n, 0) AS post_count, CASE WHEN n > 0 THEN {_PLANNED} ELSE 0 END AS n_topics,
  CASE WHEN n > 0 THEN unnest(range(CASE WHEN n > 0 THEN {_PLANNED} ELSE 1 END)) END AS topic_index, n AS n_placed,
  CASE WHEN n > 0 THEN true END AS complete, round(s, 6) AS avg_score
FROM {budget(700)} b LEFT JOIN (SELECT k.user_id, k.subreddit, count(*) AS n, avg(v.score) AS s FROM {picks(700)} k JOIN posts_v v USING (post_id) GROUP BY 1, 2) p USING (user_id, subreddit)""")
oracle("land_feed", f"""
SELECT 'users' AS table_name, user_id AS key, CAST(CASE WHEN list_contains(personas, 'BUILDING') THEN 0 ELSE 2 END AS BIGINT) AS value FROM users_v
  WHERE NOT list_contains(personas, 'BUILDING') OR user_id IN (SELECT author_id FROM posts_v WHERE post_id IN (SELECT post_id FROM {P100}))
UNION ALL SELECT 'posts', post_id, score FROM posts_v WHERE post_id IN (SELECT post_id FROM {P100})
UNION ALL SELECT 'feed_cache', user_id, count(*) FROM {P100} GROUP BY user_id
UNION ALL SELECT 'feed_runs', user_id, CAST(user_id IN (SELECT user_id FROM {P100}) AS BIGINT) FROM users_v WHERE NOT list_contains(personas, 'BUILDING')""")
oracle("topic_polarity", "SELECT DISTINCT subreddit, topic_index, true AS scored FROM topic_posts_v")
oracle("community_errors", """
SELECT subreddit, CASE WHEN score >= 300 THEN 'score out of range' WHEN num_comments = 0 THEN 'no comments' END AS error, count(*) AS n_posts FROM posts_v GROUP BY ALL""")

oracle("stream_ingest_posts", """
SELECT p.post_id, p.author_id, p.subreddit, p.score, CASE WHEN list_contains(u.personas, 'BUILDING') THEN 0 ELSE 2 END AS n_personas
FROM posts_v p JOIN users_v u ON u.user_id = p.author_id""")
oracle("stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
oracle("stream_run_state", """
SELECT user_id, source, last_run_us, output_id FROM (
  SELECT 'user_' || user_id AS user_id, 'reddit:' || event_type AS source, epoch_us(ts) AS last_run_us, CAST(event_id AS VARCHAR) AS output_id,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS rn FROM events) WHERE rn = 1""")
oracle("stream_activity", """
SELECT event_type AS subreddit, epoch_us(date_trunc('day', ts)) AS window_us, count(*) AS n_posts,
  CAST(sum(greatest(0, CAST(floor(value) AS INT))) AS BIGINT) AS score_sum, CAST(sum(CAST(regexp_extract(props, '[0-9]+', 0) AS INT)) AS BIGINT) AS comment_sum
FROM events GROUP BY 1, 2""")
