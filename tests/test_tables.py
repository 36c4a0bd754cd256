"""Keys, tables, results and positions on literal rows."""

import datetime as dt
import json
import pathlib
import random
import time

import pytest
from pyspark.sql import functions as F

from plaza import schemas, session
from plaza.operators import eda, keys, products, ranking, reports, results
from plaza.plans import registry, views
from plaza.session import materialize, new_path, shared_texts
from plaza.sources import readers, writers


def test_insert_is_idempotent_and_first_wins(spark):
    schema = "id string, ts int, v string"
    path = new_path(spark, "t")
    spark.createDataFrame([("a", 1, "old")], schema).write.parquet(path)
    batch = spark.createDataFrame([("a", 9, "new"), ("b", 2, "later"), ("b", 1, "first")], schema)
    for _ in range(2):
        stored = spark.read.schema(schema).parquet(path)
        keys.new_rows(batch, stored, "id", ["ts"]).write.mode("append").parquet(path)
    assert sorted(spark.read.parquet(path).collect()) == [("a", 1, "old"), ("b", 1, "first")]


def test_upsert_twice_is_the_same(spark):
    schema = "k string, ts int, v string"
    old = spark.createDataFrame([("a", 5, "old"), ("b", 1, "old")], schema)
    new = spark.createDataFrame([("a", 3, "new"), ("c", 1, "new")], schema)
    once = keys.upsert_latest(old, new, ["k"], "ts", "v")
    twice = keys.upsert_latest(once, new, ["k"], "ts", "v")
    expected = [("a", 3, "new"), ("b", 1, "old"), ("c", 1, "new")]
    assert sorted(once.collect()) == sorted(twice.collect()) == expected


def test_enforce_keys(spark):
    users = spark.createDataFrame([("u1", "x"), ("u1", "y"), ("u2", "z")], "user_id string, username string")
    follows = spark.createDataFrame([("u1", "u2"), ("u1", "u2"), ("u1", "gone"), ("gone", "u2")], schemas.FOLLOWS)
    posts = spark.createDataFrame([("p1", "u1"), ("p1", "u1"), ("p2", None), ("p3", "gone")], "post_id string, author_id string")
    runs = spark.createDataFrame([("r1", "u1"), ("r2", "gone"), ("r3", None)], "run_id string, user_id string")
    made = keys.enforce_keys(users, follows, posts, runs)
    assert sorted(made["users"].collect()) == [("u1", "x"), ("u2", "z")]
    assert [tuple(r) for r in made["follows"].collect()] == [("u1", "u2")]
    assert {r["post_id"] for r in made["posts"].collect()} == {"p1", "p2"}
    assert {r["run_id"]: r["user_id"] for r in made["feed_runs"].collect()} == {"r1": "u1", "r2": None, "r3": None}


def test_enforce_keys_of_cache_and_mapping(spark):
    users = spark.createDataFrame([("u1", "x")], "user_id string, username string")
    none = spark.createDataFrame([], schemas.FOLLOWS)
    posts = spark.createDataFrame([], "post_id string, author_id string")
    cache = spark.createDataFrame([("c1", "u1"), ("c2", "gone")], "cache_id string, user_id string")
    topics = spark.createDataFrame([("t1",)], "topic_id string")
    mapping = spark.createDataFrame([("m1", "t1"), ("m2", "gone")], "mapping_id string, topic_ref string")
    made = keys.enforce_keys(users, none, posts, spark.createDataFrame([], "run_id string, user_id string"), cache, topics, mapping)
    assert [r["cache_id"] for r in made["feed_cache"].collect()] == ["c1"]
    assert [r["mapping_id"] for r in made["mapping"].collect()] == ["m1"]


def test_reset_empties_what_refers_to_users(spark):
    folder = new_path(spark, "tables")
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    writers.create_tables(spark, folder, database)
    spark.sql(f"INSERT INTO {database}.live_feed_runs VALUES ('r', 'u', 'p', 's', NULL, 'n')")
    spark.sql(f"INSERT INTO {database}.live_runs VALUES ('u', 's', NULL, 1, 'o')")
    writers.truncate_core(spark, folder, database)
    assert spark.table(f"{database}.live_feed_runs").count() == 0 and spark.table(f"{database}.live_runs").count() == 1


def test_missing_authors(spark):
    posts = spark.createDataFrame([("a",), ("b",), ("b",), ("",), (None,)], "author_id string")
    users = spark.createDataFrame([("a",)], "user_id string")
    made = keys.missing_authors(posts, users).collect()
    assert [(r["user_id"], r["username"], r["personas"], r["subreddits"]) for r in made] == [("b", "b", [], [])]


def test_first_occurrence_drops_empty_keys(spark):
    df = spark.createDataFrame([("g", 2, "x"), ("g", 1, "x"), ("g", 3, ""), ("h", 4, None), ("h", 5, "x")], "g string, o int, k string")
    made = keys.first_occurrence(df, ["g"], F.col("k"), ["o"]).collect()
    assert sorted((r["g"], r["o"]) for r in made) == [("g", 1), ("h", 5)]


def test_positions_of_a_hot_group(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.7 else f"g{rnd.randrange(5)}", rnd.randrange(100), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o int, id int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["id"]: r["position"] for r in ranking.positions(df, ["g"], ["o", "id"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = {}
    for g in {r[0] for r in rows}:
        for i, r in enumerate(sorted((o, id) for gg, o, id in rows if gg == g)):
            expected[r[1]] = i
    assert got == expected


def test_positions_with_null_groups(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "g string, id int")
    assert {r["id"]: r["position"] for r in ranking.positions(df, ["g"], ["id"]).collect()} == {1: 0, 2: 1, 3: 0}


def test_json_round_trip_keeps_microseconds(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = readers.rows_with_schema(spark.createDataFrame([("p", at, None)], "post_id string, created_at timestamp, score int"), schemas.POSTS)
    path = new_path(spark, "json")
    writers.write_json(df, path)
    assert readers.read_posts(spark, path).collect() == df.collect()


def test_array_file(spark, tmp_path):
    users = [{"user_id": "u1", "username": "n", "personas": ["a"], "subreddits": ["s", "t"]}, {"user_id": "u2", "username": "m", "personas": [], "subreddits": []}]
    (tmp_path / "users.json").write_text(json.dumps(users, indent=2))
    made = readers.read_users(spark, str(tmp_path / "users.json"), array_file=True).collect()
    assert [r.asDict() for r in made] == users


def test_landed_posts(spark):
    df = spark.createDataFrame([("1", None, "s", None, "b", 1.5, None, 3, None)], schemas.LANDED_POSTS)
    r = readers.landed_to_posts(df).withColumn("us", F.unix_micros("created_at")).first()
    assert (r["post_id"], r["author_id"], r["title"], r["content"], r["us"]) == ("reddit_1", None, "", "\n\nb", 1_500_000)


@pytest.mark.parametrize("written, expected", [
    ("2024-01-02T03:04:05", "2024-01-02 03:04:05"), ("2024-01-02T03:04:05+02:00", "2024-01-02 01:04:05"),
    ("2024-01-02", "2024-01-02 00:00:00"), ("soon", "2024-02-01 00:00:00"), ("10:00:00", "2024-02-01 00:00:00"), (None, "2024-02-01 00:00:00"),
])
def test_to_instant(spark, written, expected):
    from plaza.functions import times

    df = spark.createDataFrame([(written,)], "t string")
    made = df.select(F.date_format(times.to_instant(F.col("t"), "2024-02-01 00:00:00"), "yyyy-MM-dd HH:mm:ss").alias("o"))
    assert made.first()["o"] == expected


def test_empty_statistics(spark):
    none = spark.createDataFrame([], "content string, score int, num_comments int")
    assert eda.global_eda(none).first().asDict() == {
        "post_count": 0, "avg_post_length": 0.0, "score_avg": 0.0, "score_median": 0, "score_stddev": 0.0,
        "num_comments_avg": 0.0, "num_comments_median": 0, "num_comments_stddev": 0.0}


def test_single_row_statistics(spark):
    one = spark.createDataFrame([("x", 3)], "content string, score int")
    assert tuple(eda.number_stats(one, "score").first()) == (3.0, 3, 0.0)


def test_top_terms_has_no_empty_token(spark):
    df = spark.createDataFrame([("Title\n\nbody the Body",)], "content string")
    assert [tuple(r) for r in eda.top_terms(df).collect()] == [("body", 2), ("title", 1)]


def test_last_cache_reads_missing_lists_as_empty(spark):
    def row(cache_id, day):
        return (cache_id, "u", "reddit", dt.datetime(2024, 1, day), None, "s", None, None)

    made = results.last_cache(spark.createDataFrame([row("old", 1), row("new", 2)], schemas.FEED_CACHE)).collect()
    assert [(r["cache_id"], r["raw_posts"], r["topic_data"]) for r in made] == [("new", [], [])]


def test_payload_round_trip(spark):
    df = spark.createDataFrame([("u", "s", ("u", 2))], "user_id string, source string, payload struct<user_id:string,n:int>")
    rows = results.output_rows(df, "2024-01-01 00:00:00")
    again = results.output_rows(df, "2024-01-01 00:00:00")
    assert rows.first()["output_id"] == again.first()["output_id"]
    back = results.payload_from_json(rows, df.schema["payload"].dataType).first()
    assert tuple(back["payload"]) == ("u", 2)


def test_topic_report_keeps_empty_topics(spark):
    topics = spark.createDataFrame([(1, "a", "s"), (2, "b", None)], "topic_id int, topic_title string, summary_text string")
    mapping = spark.createDataFrame([(1, "p"), (1, "q")], "topic_id int, post_id string")
    assert [tuple(r) for r in reports.topic_report(topics, mapping).collect()] == [(1, 2, "a", "s"), (2, 0, "b", "")]


def test_errors_do_not_stop_the_run(spark):
    df = spark.createDataFrame([("s", 1), ("s", None), ("t", -1)], "subreddit string, score int")
    valid, errors = results.community_errors(df, {"no score": F.col("score").isNull(), "negative": F.col("score") < 0})
    assert [tuple(r) for r in valid.collect()] == [("s", 1)]
    assert sorted(tuple(r) for r in errors.collect()) == [("s", "no score", 1), ("t", "negative", 1)]


def test_edges_between_any_white_space(spark):
    path = new_path(spark, "edges")
    lines = ["a b", "c\td", "e   f", " g h ", "a b", "# only a comment", "", "alone", "i j {'weight': 3} # said", "k#l m"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = {tuple(r) for r in readers.read_edgelist(spark, path).collect()}
    assert got == {("a", "b"), ("c", "d"), ("e", "f"), ("g", "h"), ("i", "j")}


def test_insert_moves_unseen_rows_only(spark):
    """Keys are told apart by themselves, null ones too; the rows follow for unseen keys."""
    schema = "id string, ts int, v string"
    stored = spark.createDataFrame([("a", 1, "old"), (None, 1, "old")], schema)
    batch = spark.createDataFrame([("a", 9, "new"), ("b", 2, "later"), ("b", 1, "first"), (None, 3, "x"), (None, 2, "y")], schema)
    made = keys.new_rows(batch, stored, "id", ["ts"])
    assert "LeftAnti" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(made.collect(), key=str) == [("b", 1, "first"), (None, 2, "y")]


def test_json_files_are_compressed(spark):
    path = new_path(spark, "json")
    rows = spark.range(200).select(F.col("id").alias("n"), F.lit("a text" * 50).alias("text"))
    writers.write_json(rows, path)
    files = [f.rsplit("/", 1)[1] for f in spark.read.text(path).inputFiles()]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert spark.read.schema(rows.schema).json(path).count() == 200


def test_post_texts_are_joined_last(spark, tmp_path):
    """What a post takes from other tables joins its event; the text comes after, so that it is not shuffled with the post."""
    root = str(tmp_path)
    spark.sql("SELECT id AS event_id, timestamp_ntz'2024-01-20 00:00:00' AS ts, id % 3 AS user_id, 'view' AS event_type, 1.5D AS value, 'k 1' AS props FROM range(8)").write.parquet(f"{root}/events.parquet")
    spark.sql("SELECT id AS doc_id, repeat('w ', 60) AS text, 'en' AS lang, 'src0' AS source FROM range(4)").write.parquet(f"{root}/documents.parquet")
    spark.sql("SELECT id AS page_id, concat('http://h/', id) AS url, '' AS html FROM range(2)").write.parquet(f"{root}/pages.parquet")
    spark.sql("SELECT id AS vec_id, array(1.0F) AS embedding, CAST(id AS INT) AS label FROM range(2)").write.parquet(f"{root}/embeddings.parquet")
    for made in (views.posts(spark, root), views.topic_posts(spark, root)):
        joins = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
        assert "doc_id" in joins[0] and not any("doc_id" in j for j in joins[1:])
    assert {(r["post_id"], r["topic_index"], r["selftext"].split()[-1]) for r in views.topic_posts(spark, root).collect()} == {
        (f"p_{i}", i % 2, f"http://h/{i % 2}") for i in range(8)}


def test_keywords_shuffle_texts_only(spark):
    rows = spark.createDataFrame([(1, "pear apple pear"), (2, "plum"), (None, "fig tree")], "doc_id long, t string")
    made = products.keywords(rows, ["doc_id"], "t")
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(made.collect(), key=str) == [(1, "apple", 1, 2), (1, "pear", 2, 1), (2, "plum", 1, 1), (None, "fig", 1, 1), (None, "tree", 1, 2)]


@pytest.fixture
def sorted_joins(spark):
    """No side of a join is small enough to be broadcast unasked."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shared_texts_do_not_follow_rows(spark, sorted_joins, monkeypatch):
    rows = materialize(spark.createDataFrame([(f"u{i % 7}", f"p{i % 5}") for i in range(40)] + [("u0", None), (None, "p1"), ("u1", "gone")], "user_id string, post_id string"), "rows")
    texts = materialize(spark.createDataFrame([(f"p{i}", "text " * 9 + str(i)) for i in range(6)] + [("p1", "again"), (None, "x")], "post_id string, text string"), "texts")
    for how in ("inner", "left"):
        made = shared_texts(rows, texts, "post_id", "user_id", how)
        grouped = made.groupBy("user_id").agg(F.collect_list("text"))
        plan = grouped._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
        with monkeypatch.context() as m:
            m.setattr(session, "SHARED_BYTES", 0)
            dealt = shared_texts(rows, texts, "post_id", "user_id", how)
        assert "SortMergeJoin" in dealt._jdf.queryExecution().executedPlan().toString()
        plain = rows.join(texts, "post_id", how)
        assert sorted(made.collect(), key=str) == sorted(dealt.collect(), key=str) == sorted(plain.collect(), key=str)


def test_cache_rows_move_no_record(spark, sorted_joins):
    """Whole records are neither dealt to users nor dealt again when the extras of the users join."""
    picks = materialize(spark.createDataFrame([(f"u{i % 3}", "s", f"p{i}") for i in range(9)], "user_id string, subreddit string, post_id string"), "picks")
    records = materialize(spark.createDataFrame([(f"p{i}", f"text {i}") for i in range(9)], "post_id string, content string"), "records")
    extras = picks.groupBy("user_id").agg(F.lit("s").alias("summary")).selectExpr("*", "null AS topic_data", "map('a', 'b') AS source_meta")
    made = results.feed_cache_rows(shared_texts(picks, records, "post_id", "user_id"), extras, "reddit", "2024-01-01 00:00:00")
    plan = made._jdf.queryExecution().executedPlan().toString().splitlines()
    above = plan[:next(i for i, line in enumerate(plan) if "BroadcastHashJoin" in line)]
    assert not any("Exchange" in line for line in above)
    assert {(r["user_id"], tuple(p["content"] for p in r["raw_posts"])) for r in made.collect()} == {
        (f"u{k}", tuple(f"text {i}" for i in range(9) if i % 3 == k)) for k in range(3)}


def test_newest_cache_ranks_ids_only(spark, tmp_path, sorted_joins, monkeypatch):
    """The stored texts of cached posts are not read to tell which cache row is the newest."""
    fields = schemas.FEED_CACHE["raw_posts"].dataType.elementType
    post = lambda i: tuple(f"p{i}" if f.name == "post_id" else "text" if f.name in ("title", "content") else None for f in fields)
    rows = [(f"c{u}", f"u{u}", "reddit", dt.datetime(2024, 1, 1), [post(i) for i in range(u)], "s", None, {"requested": "100"}) for u in range(3)]
    rows.append(("c9", "u9", "reddit", dt.datetime(2024, 1, 1), None, None, None, None))
    monkeypatch.setattr(registry, "cache_rows", lambda s, root: s.createDataFrame(rows, schemas.FEED_CACHE))
    made = registry.append_feed_cache(spark, str(tmp_path))
    assert "content" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["cache_id"], r["n_posts"], r["post_ids"], r["requested"]) for r in made.collect()) == [
        ("c0", 0, "", "100"), ("c1", 1, "p0", "100"), ("c2", 2, "p0|p1", "100"), ("c9", 0, "", None)]


def test_new_rows_as_a_whole_are_not_shuffled(spark):
    """A batch whose keys are all unseen and stand once is added as it lies; a null key counts as one."""
    schema = "id string, ts int, v string"
    stored = spark.createDataFrame([("a", 1, "old")], schema)
    batch = spark.createDataFrame([("b", 2, "x"), ("c", 1, "y"), (None, 3, "z")], schema)
    made = keys.new_rows(batch, stored, "id", ["ts"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert sorted(made.collect(), key=str) == sorted(batch.collect(), key=str)
    assert sorted(keys.new_rows(batch.unionByName(stored), stored, "id", ["ts"]).collect(), key=str) == sorted(batch.collect(), key=str)
    assert keys.new_rows(batch.limit(0), stored, "id", ["ts"]).count() == 0


def test_shuffles_of_written_tables_go(spark, tmp_path):
    """What was shuffled for a table that is written is deleted with the query, and the setting is as before."""
    local = pathlib.Path(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()[0])
    files = lambda: {f for f in local.rglob("shuffle_*.data")}
    before, rows = files(), spark.range(20_000).selectExpr("id % 5000 AS k", "uuid() AS text")
    kept = rows.groupBy("k").agg(F.collect_list("text").alias("t"))
    made = materialize(kept, "grouped")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and made.count() == 5000
    assert kept.count() == 5000 and files() - before  # as any other query's
    assert spark.conf.get(session.SHUFFLES_GO, "false") == "false"
