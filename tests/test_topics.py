"""Topics, similarity, graph and the whole run against brute force."""

import datetime as dt
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from plaza.operators import clustering, graph, products, results, similarity, topics
from plaza.plans import run
from plaza.session import new_path


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def vectors(spark, groups):
    rows = [(g, i, [float(x) for x in v]) for g, points in groups.items() for i, v in points]
    return spark.createDataFrame(rows, "g string, id int, v array<double>").repartition(4)


@pytest.fixture(scope="module")
def clouds():
    rnd = np.random.default_rng(5)
    hot = np.concatenate([rnd.normal(size=(1, 8)) + 0.05 * rnd.normal(size=(70, 8)), rnd.normal(size=(150, 8))])
    cold = rnd.normal(size=(25, 8))
    copies = np.repeat(hot[:3], 5, axis=0)
    points = np.concatenate([hot, copies])
    return {"hot": list(enumerate(points)), "cold": [(1000 + i, v) for i, v in enumerate(cold)]}


def brute_pairs(points, t):
    ids, m = [i for i, _ in points], unit(np.array([v for _, v in points]))
    s = m @ m.T
    return {(ids[i], ids[j]) for i in range(len(ids)) for j in range(i + 1, len(ids)) if s[i, j] >= t}


@pytest.mark.parametrize("threshold, block_rows", [(0.5, 16), (0.9, 16), (0.99, 10), (0.84, 4096)])
def test_similarity_join_is_exact(spark, clouds, threshold, block_rows):
    got = similarity.similarity_join(vectors(spark, clouds), ["g"], "id", "v", threshold, block_rows).collect()
    assert len(got) == len({(r["id_a"], r["id_b"]) for r in got})
    linked = {(r["id_a"], r["id_b"]) for r in got}
    # Copies are tied to their first row; what holds for that row holds for them.
    first = {}
    by_value = {}
    for g, points in clouds.items():
        for i, v in points:
            first[i] = by_value.setdefault((g, tuple(v)), i)
    for points in clouds.values():
        distinct = [(i, v) for i, v in points if first[i] == i]
        expected = brute_pairs(distinct, threshold) | {(first[i], i) for i, _ in points if first[i] != i}
        ids = {i for i, _ in points}
        assert {p for p in linked if p[0] in ids} == expected


def greedy(points, t):
    kept, out = [], []
    for i, v in sorted(points, key=lambda p: p[0]):
        u = v / np.linalg.norm(v)
        if not any(k @ u >= t for k in kept):
            kept.append(u)
            out.append(i)
    return out


@pytest.mark.parametrize("threshold, leaders", [(0.5, 1000), (0.5, 7), (0.84, 20)])
def test_dedupe_similar_equals_the_greedy_pass(spark, clouds, threshold, leaders):
    df = vectors(spark, clouds)
    kept = similarity.dedupe_similar(df, ["g"], ["id"], "id", "v", threshold, leaders=leaders, piece_rows=32)
    got = {r["id"] for r in kept.collect()}
    assert got == {i for points in clouds.values() for i in greedy(points, threshold)}


def test_dedupe_similar_top_k(spark, clouds):
    kept = similarity.dedupe_similar(vectors(spark, clouds), ["g"], ["id"], "id", "v", 0.5, top_k=3)
    assert {r["id"] for r in kept.collect()} == {i for points in clouds.values() for i in greedy(points, 0.5)[:3]}


def squared_error(made, value):
    members = {}
    for r in made:
        members.setdefault((r["g"], r["topic_index"]), []).append(value[r["post_id"]])
    return sum(((np.array(m) - np.mean(m, axis=0)) ** 2).sum() for m in members.values())


def test_small_clusters_are_seeded(spark):
    """One large and five small, far clusters: the error is within a tenth of MLlib's best of several starts."""

    rnd = np.random.default_rng(8)
    points = [rnd.normal(size=2) for _ in range(4000)]
    for k in range(5):
        points += [np.array([100.0 * (k + 1), 100.0 * (-1) ** k]) + rnd.normal(size=2) for _ in range(20)]
    rows = [("g", f"p{i:05}", [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "g string, post_id string, embedding array<double>").repartition(4)
    value = {r[1]: np.array(r[2]) for r in rows}
    ours = squared_error(topics.kmeans_topics(df, ["g"]).collect(), value)
    vectors_of = df.select(array_to_vector("embedding").alias("features"))
    theirs = min(KMeans(k=6, maxIter=20, seed=s).fit(vectors_of).summary.trainingCost for s in (42, 1, 2))
    assert ours <= 1.1 * theirs


def test_kmeans_reaches_a_fixed_point(spark):
    rnd = np.random.default_rng(9)
    centers = {"a": rnd.normal(size=(4, 6)) * 10, "b": rnd.normal(size=(4, 6)) * 10}
    rows = [(g, f"{g}{i}", [float(x) for x in c[i % 4] + rnd.normal(size=6)]) for g, c in centers.items() for i in range(60)]
    rows += [("tiny", f"t{i}", [float(i)] * 6) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, post_id string, embedding array<double>")
    made = topics.kmeans_topics(df, ["g"]).collect()
    assert Counter(r["g"] for r in made) == {"a": 60, "b": 60}
    value = {r[1]: np.array(r[2]) for r in rows}
    for g in centers:
        members = {}
        for r in made:
            if r["g"] == g:
                members.setdefault(r["topic_index"], []).append(value[r["post_id"]])
        assert len(members) == 4
        means = {t: np.mean(m, axis=0) for t, m in members.items()}
        for t, m in members.items():
            for v in m:
                assert min(means, key=lambda k: ((v - means[k]) ** 2).sum()) == t


def test_kmeans_without_large_groups(spark):
    df = spark.createDataFrame([("g", "p", [1.0, 2.0])], "g string, post_id string, embedding array<double>")
    assert topics.kmeans_topics(df, ["g"]).count() == 0


def test_num_topics(spark):
    sizes = [1, 10, 11, 20, 21, 40, 41, 80, 81, 100, 119, 120, 5000]
    df = spark.createDataFrame([(n,) for n in sizes], "n int")
    assert [r[0] for r in df.select(topics.num_topics(F.col("n"))).collect()] == [1, 1, 2, 2, 3, 3, 4, 4, 4, 5, 5, 6, 6]


def test_topic_text(spark):
    rows = [("t", i, f"post number {i % 60}") for i in range(400)] + [("u", 1, ""), ("u", 2, "only!"), ("u", 3, "only!")]
    df = spark.createDataFrame(rows, "t string, o int, text string").repartition(5)
    unique = {r["t"]: r["topic_text"] for r in topics.topic_text(df, ["t"], ["o"], max_chars=300).collect()}
    plain = {r["t"]: r["topic_text"] for r in topics.topic_text(df, ["t"], ["o"], unique=False, max_chars=3500).collect()}
    assert unique == {"t": " ".join(f"Post number {i}." for i in range(60))[:300], "u": "Only!"}
    assert plain == {"t": " ".join(f"Post number {i % 60}." for i in range(400))[:3500], "u": "Only! Only!"}


def test_topic_text_makes_leading_texts_only(spark):
    """Of a group with many posts only those texts are made that may be in its topic text; groups of mostly empty posts are made whole."""
    rows = spark.range(3000).unionByName(spark.range(10_000, 13_000)).selectExpr("int(id div 10000) AS t", "int(id) AS o").repartition(4)
    # Making one of the later texts fails.
    dear = rows.filter("t = 0").withColumn("text", F.expr("IF(o >= 2000, string(int(concat('x', o))), concat('post number ', o))"))
    got = {r["t"]: r["topic_text"] for r in topics.topic_text(dear, ["t"], ["o"], unique=False, max_chars=300).collect()}
    want = {0: " ".join(f"Post number {i}." for i in range(300))[:300]}
    assert got == want
    df = rows.withColumn("text", F.expr("IF(o >= 10000 AND o < 10900, '', concat('post number ', o))"))
    got = {r["t"]: r["topic_text"] for r in topics.topic_text(df, ["t"], ["o"], unique=False, max_chars=300).collect()}
    assert got == want | {1: " ".join(f"Post number {i}." for i in range(10_900, 11_200))[:300]}


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([(1, 1, ""), (2, 1, "Rust compilers improve. Compilers need rust tests."), (1, 2, None)], "id int, o int, text string")
    made = {r["id"]: r["summary"] for r in products.extractive_summary(df, ["id"], ["o"]).collect()}
    assert made == {1: products.NO_CONTENT, 2: "Rust compilers improve. Compilers need rust tests."}


def test_summary_finds_the_best_sentence_at_the_end_of_long_texts(spark):
    filler = " ".join(f"Filler{i} alone{i} here{i}." for i in range(400))
    rows = [(1, 1, filler), (1, 2, "Compilers turn programs into machine code."), (1, 3, "Programs need compilers and machine code.")]
    rows += [(2, i, f"Other{i} things{i} happen{i}.") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, o int, text string")
    made = {r["id"]: r["summary"] for r in products.extractive_summary(df, ["id"], ["o"], n=2).collect()}
    assert len(filler) > 3500 and made[1] == "Compilers turn programs into machine code. Programs need compilers and machine code."


def test_summary_passes_over_near_copies(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, i, f"{words} number{i}.") for i in range(40)] + [(1, 90, "Quite another thing."), (2, 1, "Something else entirely.")]
    df = spark.createDataFrame(rows, "id int, o int, text string")
    made = {r["id"]: r["summary"] for r in products.extractive_summary(df, ["id"], ["o"]).collect()}
    assert made[1] == f"{words.capitalize()} number0. Quite another thing."


@pytest.mark.parametrize("n_vectors", [0, 18, 30])
def test_no_post_is_lost_without_a_vector(spark, n_vectors):
    kinds = ["alpha beta gamma", "delta epsilon zeta", "eta theta iota"]
    rows = [("u", "s", f"p{i:02}", f"{kinds[i % 3]} {kinds[i % 3]} number{i}") for i in range(30)] + [("u", "few", "q1", "text"), ("u", "few", "q2", "")]
    posts = spark.createDataFrame(rows, "user_id string, subreddit string, post_id string, text string")
    vecs = spark.createDataFrame([(f"p{i:02}", [float(i % 3), 1.0]) for i in range(n_vectors)], "post_id string, embedding array<double>")
    made = topics.assign_topics(posts, vecs, ["user_id", "subreddit"]).collect()
    assert sorted(r["post_id"] for r in made) == sorted(r[2] for r in rows)
    of_topic = {}
    for r in made:
        if r["subreddit"] == "s":
            of_topic.setdefault(r["topic_index"], set()).add(int(r["post_id"][1:]) % 3)
    assert len(of_topic) == 3 and all(len(k) == 1 for k in of_topic.values())
    assert {r["mode"] for r in made} == {"single", "cluster"}


def test_summary_metrics(spark):
    texts = spark.createDataFrame([("a", "One two two"), ("a", "three it's"), ("b", "")], "t string, text string")
    summaries = spark.createDataFrame([("a", "two it's new"), ("b", None)], "t string, summary string")
    made = {r["t"]: (r["compression_ratio"], r["lexical_overlap"], r["summary_length"]) for r in
            products.summary_metrics(texts, summaries, ["t"]).collect()}
    assert made == {"a": (0.6, 0.5, 3), "b": (1.0, 0.0, 1)}


def people(spark, n):
    kinds = [["a", "b"], ["b", "c"], ["d", "d"], []]
    return [(f"u{i:03}", kinds[i % 7] if i % 7 < 4 else ["a", "b"]) for i in range(n)]


def test_persona_pairs_add_up(spark):
    rows = people(spark, 40)
    df = spark.createDataFrame(rows, "user_id string, personas array<string>")
    got = {}
    for r in graph.persona_overlap_pairs(df).collect():
        got[r["weight"]] = got.get(r["weight"], 0) + r["n_pairs"]
    close = sum(1 for a in rows for b in rows if a[0] != b[0] and set(a[1]) & set(b[1]))
    assert got == {5: close, 1: 40 * 39 - close}


def test_whole_run_with_clusters(spark):
    """A user whose one community is large enough to be clustered."""
    rnd = np.random.default_rng(2)
    words = ["alpha beta", "gamma delta", "omega sigma"]
    rows, points = [], []
    for i in range(60):
        kind = i % 3
        rows.append((f"p{i:02}", "u1", "news", f"{words[kind]} story {i}", "It has details. More follows here.", None,
                     dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i, i % 5))
        points.append((f"p{i:02}", [float(x) for x in np.eye(3)[kind] * 10 + rnd.normal(size=3) * 0.01]))
    posts = spark.createDataFrame(rows, "post_id string, author_id string, subreddit string, title string, selftext string, "
                                        "content string, created_at timestamp, score int, num_comments int")
    users = spark.createDataFrame([("u1", ["News"]), ("u2", ["nowhere"])], "user_id string, subreddits array<string>")
    runs = spark.createDataFrame([], "user_id string, source string, last_run_at timestamp")
    vecs = spark.createDataFrame(points, "post_id string, embedding array<double>")
    made = run.run_analysis(posts, users, runs, vecs, run.RunSettings("2024-01-10 00:00:00", "2024-01-11 00:00:00"))
    assert made["picked"].count() == 40
    assert {(r["user_id"], r["post_count"], r["n_communities"]) for r in made["totals"].collect()} == {("u1", 40, 1), ("u2", 0, 1)}
    mapping = made["mapping"].collect()
    assert len(mapping) == len({r["post_ref"] for r in mapping}) == 40
    assert len({r["topic_ref"] for r in mapping}) == made["topics"].count() == 3
    full = made["products"].collect()
    assert sorted(i for r in full for i in r["post_indices"]) == list(range(40))
    for r in full:
        assert len({(i) % 3 for i in r["post_indices"]}) == 1      # one kind per topic
        assert r["title"] and r["bullets"] and 0 < len(r["sample_posts"]) <= 3
    state = made["runs"].collect()
    assert sorted((r["user_id"], r["source"], r["post_count"]) for r in state) == [
        ("u1", "reddit:news", 40), ("u1", "reddit:subreddit_analysis", 40), ("u2", "reddit:subreddit_analysis", 0)]
    payload = {r["user_id"]: r for r in made["payload"].collect()}
    assert payload["u1"]["allocations"] == {"news": 40} and len(payload["u1"]["subreddits"]["news"]["topics"]) == 3
    assert payload["u2"]["subreddits"]["nowhere"]["post_count"] == 0
    news = payload["u1"]["subreddits"]["news"]
    ids = {r["source"]: r["output_id"] for r in made["outputs"].filter("user_id = 'u1'").collect()}
    assert news["allocated"] == 40 and news["output_id"] == ids["reddit:news"] and news["eda"]["post_count"] == 40
    assert all(t["metrics"]["summary_length"] > 0 for t in news["topics"])
    assert all(r["polarity_label"] is None for r in full)
    folder = new_path(spark, "stored")
    for k in range(2):  # a run that is stored twice is there once
        stored = run.store_run(made, folder, runs, f"{folder}/runs-{k}")
        assert stored.count() == 3
        sizes = {n: spark.read.parquet(f"{folder}/{n}").count() for n in ("topics", "mapping", "outputs")}
        assert sizes == {"topics": 3, "mapping": 40, "outputs": 3}
    bad = run.run_analysis(posts, users, runs, vecs, run.RunSettings("2024-01-10 00:00:00", "2024-01-11 00:00:00"),
                           rules={"no comments": F.col("num_comments") == 0})
    assert [tuple(r) for r in bad["errors"].collect()] == [("news", "no comments", 12)]
    assert bad["payload"].filter("user_id = 'u1'").first()["subreddits"]["news"]["errors"] == ["no comments"]


def test_payload_moves_no_topic(spark):
    """The topics of a list come to the users in the tasks that group them."""
    posts = spark.createDataFrame([(f"p{i}", "a", "news", f"Story {i}", "It has details. More follows here.", None, dt.datetime(2024, 1, 1, i), i, 1)
                                   for i in range(6)], "post_id string, author_id string, subreddit string, title string, selftext string, "
                                                       "content string, created_at timestamp, score int, num_comments int")
    users = spark.createDataFrame([("u1", ["news"]), ("u2", ["news", "nowhere"])], "user_id string, subreddits array<string>")
    runs = spark.createDataFrame([], "user_id string, source string, last_run_at timestamp")
    vecs = spark.createDataFrame([], "post_id string, embedding array<double>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = run.run_analysis(posts, users, runs, vecs, run.RunSettings("2024-01-10 00:00:00", "2024-01-11 00:00:00"))
        plan = made["payload"]._jdf.queryExecution().executedPlan().toString().splitlines()
        above = plan[:next(i for i, line in enumerate(plan) if "BroadcastHashJoin" in line)]
        assert not any("Exchange" in line for line in above)
        got = {r["user_id"]: {s: len(x["topics"] or []) for s, x in r["subreddits"].items()} for r in made["payload"].collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {"u1": {"news": 1}, "u2": {"news": 1, "nowhere": 0}}


@given(st.integers(0, 10**6), st.integers(2, 6), st.integers(30, 400))
@settings(max_examples=40, deadline=None)
def test_bounds_skip_rows_and_nothing_else(seed, k, n):
    """Steps with bounds give what comparing every row with every centroid gives, and compare fewer."""
    rnd = np.random.default_rng(seed)
    points = rnd.normal(size=(k, 5))[rnd.integers(k, size=n)] * 4 + rnd.normal(size=(n, 5))
    centers = points[:k].copy()
    bounds, steps = clustering.Bounds(points).first(centers), 0
    for steps in range(1, 60):
        means = bounds.means(centers)
        shift, centers = np.sqrt(((means - centers) ** 2).sum(axis=1)), means
        moved = bounds.step(centers, shift)
        gaps = clustering.squared_gaps(points, centers)
        assert np.allclose(gaps[bounds.own, np.arange(n)], gaps.min(axis=0))
        for t in range(k):
            assert bounds.counts[t] == (bounds.own == t).sum() and np.allclose(bounds.sums[t], points[bounds.own == t].sum(axis=0))
        if not moved:
            break
    assert bounds.compared <= n * (steps + 1)


def test_kmeans_over_many_blocks(spark, monkeypatch):
    """Groups of many blocks, merged in levels, beside groups of one: the error of MLlib, and a fixed point."""
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 100)
    monkeypatch.setattr(clustering, "BLOCKS_AT_ONCE", 4)
    rnd = np.random.default_rng(4)
    centers = rnd.normal(size=(6, 8)) * 3
    points = centers[rnd.choice(6, p=[0.5, 0.3, 0.1, 0.05, 0.03, 0.02], size=3000)] + rnd.normal(size=(3000, 8))
    rows = [("big" if i < 2900 else "small", f"p{i:05}", [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "g string, post_id string, embedding array<double>").repartition(5)
    made = topics.kmeans_topics(df, ["g"], max_iter=60).collect()
    assert sorted(r["post_id"] for r in made) == sorted(r[1] for r in rows)
    value = {r[1]: np.array(r[2]) for r in rows}
    big = [r for r in made if r["g"] == "big"]
    vectors_of = df.filter("g = 'big'").select(array_to_vector("embedding").alias("features"))
    theirs = min(KMeans(k=6, maxIter=20, seed=s).fit(vectors_of).summary.trainingCost for s in (42, 1, 2))
    assert squared_error(big, value) <= 1.02 * theirs
    means = {t: np.mean([value[r["post_id"]] for r in big if r["topic_index"] == t], axis=0) for t in range(6)}
    assert all(min(means, key=lambda t: ((value[r["post_id"]] - means[t]) ** 2).sum()) == r["topic_index"] for r in big)


def test_blocks_get_one_copy_of_the_centroids(spark):
    """Vectors are dealt out once; no plan of a step has a column of centroids beside single rows."""
    rows = [("g", f"p{i:05}", [float(i % 7), float(i % 5), 1.0]) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, post_id string, embedding array<double>")
    packed = clustering.blocks(df.selectExpr("*", "3 AS k", "5 AS blocks"), ["g"], "post_id", "embedding")
    assert packed.count() == 5 and sum(len(r["ids"]) for r in packed.collect()) == 500
    assert "centers" not in packed.columns


def test_tree_grows_with_the_group(spark):
    """Leaves stay bounded, and fewer pairs of them meet than there are."""
    rnd = np.random.default_rng(6)
    points = unit(rnd.normal(size=(40, 16)))[rnd.integers(40, size=3000)] + 0.03 * rnd.normal(size=(3000, 16))
    df = vectors(spark, {"g": list(enumerate(points))})
    rows, levels = similarity._split(df.select("g", "id", similarity._unit("v").alias("u")), ["g"], "id", 50)
    sizes = [r["count"] for r in rows.groupBy("cell").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 50 and len(levels) >= 2
    meet = similarity._meeting(df.select("g").distinct(), levels, ["g"], np.arccos(0.95)).count()
    assert meet < len(sizes) * (len(sizes) + 1) / 2 / 2
    got = {(r["id_a"], r["id_b"]) for r in similarity.similarity_join(df, ["g"], "id", "v", 0.95, 50).collect()}
    assert got == brute_pairs(list(enumerate(points)), 0.95)


def test_settling_takes_few_rounds(spark):
    """Fifty thousand rows with random neighbours before them: the greedy answer in fewer than ten rounds."""
    rnd = np.random.default_rng(7)
    n = 50_000
    a, b = rnd.integers(n, size=(2, 100_000))
    edges = sorted({(int(min(x, y)), int(max(x, y))) for x, y in zip(a, b) if x != y})
    before = {}
    for early, late in edges:
        before.setdefault(late, []).append(early)
    kept = set()
    for row in range(n):
        if not any(e in kept for e in before.get(row, [])):
            kept.add(row)
    df = spark.createDataFrame([("g", *e) for e in edges], "g string, early int, late int")
    gone, rounds = similarity._settled(df, ["g"])
    assert {r["_row"] for r in gone.collect()} == set(range(n)) - kept
    assert rounds < 10


def test_dedupe_with_copies_and_no_length(spark):
    points = [[1.0, 0.0], [0.0, 0.0], [2.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 3.0], [1.0, 1.0]]
    df = vectors(spark, {"g": list(enumerate(points))})
    for leaders in (1, 1000):
        kept = similarity.dedupe_similar(df, ["g"], ["id"], "id", "v", 0.9, leaders=leaders)
        assert sorted(r["id"] for r in kept.collect()) == [0, 1, 3, 4, 6]


def test_summary_beyond_a_run_of_near_copies(spark, monkeypatch):
    """More near copies than candidates: the topic takes more passes and gives the same sentences."""
    words = "engine motor piston valve crank gear shaft wheel brake clutch".split()
    copies = [f"{' '.join(words)} number{i}." for i in range(80)]
    others = [f"Apples{i} pears{i} plums{i}." for i in range(6)]
    rows = [(1, i, t) for i, t in enumerate([*copies, *others])] + [(2, i, f"Only{i} this{i} topic{i}.") for i in range(10)]
    df = spark.createDataFrame(rows, "id int, o int, text string")
    few = {r["id"]: r["summary"] for r in products.extractive_summary(df, ["id"], ["o"]).collect()}
    monkeypatch.setattr(products, "CANDIDATES", 900)
    many = {r["id"]: r["summary"] for r in products.extractive_summary(df, ["id"], ["o"]).collect()}
    assert few == many and few[1].count("piston") == 1 and few[1].count("Apples") == 4 and few[2].count("topic") == 5


def test_sentences_without_a_place_do_not_lead(spark):
    rows = [(1, None, "Compilers turn programs into machine code."), (1, 2, "Programs need compilers and machine code."), (1, 3, "Quite another thing."),
            (None, 1, "Programs need compilers.")]
    df = spark.createDataFrame(rows, "id int, o int, text string")
    made = {r["id"]: r["summary"] for r in products.extractive_summary(df, ["id"], ["o"]).collect()}
    assert made == {1: "Programs need compilers and machine code. Quite another thing.", None: products.NO_SUMMARY}


def test_more_candidates_before_a_pass_per_winner(spark, monkeypatch):
    """A topic whose leading sentences are near copies is settled by more of them; a pass per winner gives the same."""
    rows = [(1, i, f"engine motor piston valve crank gear shaft wheel brake number{i}.") for i in range(40)]
    rows += [(1, 50 + i, f"Apples{i} pears{i} plums{i}.") for i in range(6)] + [(2, i, f"Only{i} this{i}.") for i in range(3)]
    df = spark.createDataFrame(rows, "id int, o int, text string")
    made = {}
    one_by_one = products._one_by_one
    for name, first, more in (("more", 4, 16), ("winner", 4, 1)):
        calls = []
        monkeypatch.setattr(products, "CANDIDATES", first)
        monkeypatch.setattr(products, "MORE_CANDIDATES", more)
        monkeypatch.setattr(products, "_one_by_one", lambda *a: calls.append(1) or one_by_one(*a))
        made[name] = {r["id"]: r["summary"] for r in products.extractive_summary(df, ["id"], ["o"]).collect()}
        assert len(calls) == (name == "winner")
    assert made["more"] == made["winner"] and made["more"][1].count("piston") == 1 and made["more"][1].count("Apples") == 4


def broadcast_parts(df):
    """What a plan broadcasts: the text of each broadcast exchange and all below it."""
    lines, parts = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = line.index("BroadcastExchange")
            below = [l for l in lines[i + 1:]]
            end = next((k for k, l in enumerate(below) if len(l) - len(l.lstrip(" :+-*()0123456789")) <= depth), len(below))
            parts.append("\n".join([line, *below[:end]]))
    return parts


def test_topics_of_lists_are_never_broadcast(spark):
    text = "the same words over and over " * 50
    lists = spark.createDataFrame([(f"u{i}", "reddit:a", "x", 1, ["p"]) for i in range(20)], "user_id string, source string, list_id string, post_count long, post_ids array<string>")
    made = results.community_payload(lists, spark.createDataFrame([("x", (0, [text] * 3))], "list_id string, topic struct<topic_index:int,sample_posts:array<string>>"), "2024-01-01 00:00:00")
    assert not broadcast_parts(made)
    assert [len(r["result_topics"][0]["sample_posts"]) for r in made.collect()] == [3] * 20
    posts = spark.createDataFrame([(f"p{i}", f"u{i % 3}", "a", "t", text, text, f"2024-01-0{1 + i % 8} 00:00:00", i, i) for i in range(12)],
                                  "post_id string, author_id string, subreddit string, title string, selftext string, content string, created_at string, score int, num_comments int"
                                  ).withColumn("created_at", F.col("created_at").cast("timestamp"))
    users = spark.createDataFrame([(f"u{i}", f"u{i}", ["x"], ["a"]) for i in range(3)], "user_id string, username string, personas array<string>, subreddits array<string>")
    runs = spark.createDataFrame([], "user_id string, source string, last_run_at timestamp")
    vecs = spark.createDataFrame([], "post_id string, embedding array<float>")
    out = run.run_analysis(posts, users, runs, vecs, run.RunSettings("2024-01-10 00:00:00", "2024-01-11 00:00:00"))
    assert not [p for p in broadcast_parts(out["payload"]) if "sample_posts" in p]
    rows = out["payload"].collect()
    assert len(rows) == 3 and all(r["subreddits"]["a"]["post_count"] == 12 and len(r["subreddits"]["a"]["topics"]) == 1 for r in rows)


def test_samples_and_topic_texts_shuffle_no_texts(spark):
    rnd = np.random.default_rng(2)
    rows = [(i % 4, i, " ".join(map(str, rnd.integers(0, 10**9, 30)))) for i in range(3000)]
    path = new_path(spark, "posts")
    spark.createDataFrame(rows, "t int, i int, text string").write.parquet(path)
    df, before = spark.read.schema("t int, i int, text string").parquet(path), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")  # less than the posts, more than the few that are picked
    try:
        samples, texts = topics.sample_posts(df, ["t"], ["i"]), topics.topic_text(df, ["t"], ["i"])
        for made in (samples, texts):
            assert "SortMergeJoin" not in made._jdf.queryExecution().executedPlan().toString()
        got = {r["t"]: r["sample_posts"] for r in samples.collect()}
        assert got == {t: [rows[t + 4 * k][2] for k in range(3)] for t in range(4)} and texts.count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
