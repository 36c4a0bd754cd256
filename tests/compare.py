"""Run registered queries next to their SQL twins.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):  # arrays and structs
        return tuple(map(plain, value))
    if isinstance(value, dict):
        return tuple(sorted(((plain(k), plain(v)) for k, v in value.items()), key=str))
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, con, root: str, name: str, query, twin: str | None) -> tuple[int, str]:
    """Row count, and what differs (empty when nothing does)."""
    df = query(spark, root)
    ours = rows_of(df.columns, df.collect())
    n = sum(ours.values())
    if twin is None:
        return n, "" if n else "no rows"
    got = con.execute(twin)
    names = [d[0] for d in got.description]
    theirs = rows_of(names, got.fetchall())
    if sorted(names) != sorted(df.columns):
        return n, f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        show = lambda c: [str(r)[:400] for r, _ in c.most_common(2)]
        return n, f"{n} / {sum(theirs.values())} rows; extra {sum(extra.values())} {show(extra)}; lacking {sum(lacking.values())} {show(lacking)}"
    return n, ""


def main(root: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from plaza.session import build_session

    spark = build_session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(root), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            n, wrong = difference(spark, con, root, name, query, twins.get(name))
        except Exception as error:  # report and go on with the next query
            n, wrong = -1, f"{type(error).__name__}: {str(error)[:700]}"
            con = connect(root)
        bad += bool(wrong)
        state = "BAD" if wrong else "ok" if name in twins else "rows"
        print(f"{state:4} {name:28} {n:8} {time.time() - start:6.1f}s {wrong}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
