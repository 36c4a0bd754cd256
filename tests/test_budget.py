"""Budget split and selection against a post-by-post model."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from plaza.operators import activity, selection


def model(raw, n, low=5, high=40):
    """Hand out posts literally, one at a time."""
    raw = [max(0.0001, r) for r in raw]
    total = 0.0
    for r in raw:
        total += r
    out = [min(high, max(low, round(r / total * n))) for r in raw]
    if sum(out) > n:
        over = sum(out) - n
        for i in sorted(range(len(raw)), key=lambda i: raw[i]):
            while over and out[i] > low:
                out[i] -= 1
                over -= 1
    turn = 0
    while sum(out) < n:
        open_ = [i for i, v in enumerate(out) if v < high]
        if not open_:
            break
        out[open_[turn % len(open_)]] += 1
        turn += 1
    return out


def split(spark, lists, n):
    rows = [(f"u{u:05}", i, f"s{i}", float(a)) for u, acts in enumerate(lists) for i, a in enumerate(acts)]
    df = spark.createDataFrame(rows, "user_id string, pos int, subreddit string, activity double")
    made = activity.allocate_budget(df, n).orderBy("user_id", "pos").collect()
    out = {}
    for r in made:
        out.setdefault(r["user_id"], []).append(r["allocated"])
    return list(out.values())


def test_many_random_lists(spark):
    rnd = random.Random(7)
    lists = [[rnd.choice([0.0, 0.1, 1.0, rnd.random() * 10, rnd.random() * 500]) for _ in range(rnd.randint(1, 22))] for _ in range(400)]
    for n in (0, 30, 100, 333, 700, 900):
        assert split(spark, lists, n) == [model(l, n) for l in lists]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lists=st.lists(st.lists(st.floats(0, 1000), min_size=1, max_size=12), min_size=1, max_size=20), n=st.integers(0, 600))
def test_total_is_clamped(spark, lists, n):
    for got, acts in zip(split(spark, lists, n), lists):
        assert sum(got) == min(max(n, 5 * len(acts)), 40 * len(acts))
        assert all(5 <= v <= 40 for v in got)


def test_user_subreddits(spark):
    df = spark.createDataFrame(
        [("a", ["News", "", "news", "AI", None]), ("b", []), ("c", None)], "user_id string, subreddits array<string>")
    made = activity.user_subreddits(df).orderBy("user_id", "pos").collect()
    got = {}
    for r in made:
        got.setdefault(r["user_id"], []).append(r["subreddit"])
    assert got == {"a": ["news", "ai"], "b": activity.DEFAULT_SUBREDDITS, "c": activity.DEFAULT_SUBREDDITS}


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def posts(spark, rows):
    return spark.createDataFrame(rows, "subreddit string, post_id string, created_at timestamp, score int, num_comments int")


def test_activity_edge_cases(spark):
    rows = [("a", "p1", at(10), -5, None), ("b", "p2", None, 10, 10), ("c", "p3", at(11), 4, 0)]
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("empty",)], "subreddit string")
    made = activity.community_activity(posts(spark, rows), wanted, "2024-01-10 00:00:00")
    got = {r["subreddit"]: r["activity"] for r in made.collect()}
    assert got["empty"] == 1.0
    assert abs(got["a"] - 20.0) < 1e-9            # age 0: recency 1
    assert abs(got["b"] - (5 + 3 + 2)) < 1e-9     # unreadable time: 0.1
    assert abs(got["c"] - (2 + 2)) < 1e-9         # age exactly -1 day: 0.1


def pick_model(rows, n, since):
    best = sorted(rows, key=lambda r: (-r[3], -r[2].timestamp(), r[1]))[:n]
    first = [r for r in best if since is None or r[2] > since]
    newest = sorted(rows, key=lambda r: (-r[2].timestamp(), r[1]))[: n - len(first)]
    ids = {r[1] for r in first}
    more = [r for r in newest if (since is None or r[2] > since) and r[1] not in ids]
    return [r[1] for r in (first + more)[:n]]


def test_select_posts(spark):
    rnd = random.Random(3)
    rows = [(f"s{i % 3}", f"p{i:03}", at(1 + rnd.randrange(20), rnd.randrange(24)), rnd.randrange(6), 0) for i in range(120)]
    budgets, expected = [], {}
    for u in range(30):
        sub, n = f"s{u % 3}", 60 if u == 7 else rnd.randrange(0, 41)
        since = rnd.choice([None, at(5), at(12), rows[u][2], at(21)])
        budgets.append((f"u{u}", sub, n, since))
        expected[f"u{u}"] = pick_model([r for r in rows if r[0] == sub], n, since)
    wanted = spark.createDataFrame(budgets, "user_id string, subreddit string, allocated int, since timestamp")
    got = {u: [] for u in expected}
    for r in selection.select_posts(posts(spark, rows), wanted).orderBy("user_id", "position").collect():
        got[r["user_id"]].append(r["post_id"])
    assert got == expected


def test_tasks_follow_the_picks(spark, monkeypatch):
    monkeypatch.setattr(selection, "PICKS_AT_ONCE", 50)
    rows = [("s", f"p{i:03}", at(1 + i % 20), i % 6, 0) for i in range(40)]
    wanted = spark.createDataFrame([(f"u{i}", "s", 20, None) for i in range(60)], "user_id string, subreddit string, allocated int, since timestamp")
    made = selection.select_posts(posts(spark, rows), wanted.coalesce(1))
    sizes = made.groupBy(F.spark_partition_id()).count().collect()
    assert made.rdd.getNumPartitions() == 24 and sum(r["count"] for r in sizes) == 1200 and max(r["count"] for r in sizes) < 300


def test_since_is_strict(spark):
    df = spark.createDataFrame([("eq", at(2), at(2)), ("new", at(3), at(2)), ("none", at(1), None), ("bad", None, at(2))],
                               "id string, created_at timestamp, since timestamp")
    assert {r["id"] for r in selection.since_filter(df).collect()} == {"new", "none", "bad"}


def test_plan_prunes_before_the_shuffle(spark):
    df = posts(spark, [("a", "p", at(1), 1, 1)])
    plan = activity.community_activity(df, df, "2024-01-10")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
