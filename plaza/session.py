"""Session settings and the shared folder that written tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "plaza", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive times are read as UTC everywhere, so the session zone has to be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="plaza-", dir=os.environ.get("TMPDIR")))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Whether the files of a query's shuffles go when it ends, and not only when the driver's memory is collected.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage,
    survives executor loss, and fixes values such as row ids for later reads. What was shuffled
    for it is not needed any more and goes."""
    spark = df.sparkSession
    path, before = new_path(spark, label), spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """The side of a join that holds texts: never broadcast. Spark knows of a written table only the size of its files, and
    texts that repeat take a hundred times more in the driver's memory."""
    return df.hint("merge")


# Texts that are broadcast, at most, and texts that a task groups.
SHARED_BYTES, TASK_BYTES = 32 << 20, 64 << 20


def measured(df: DataFrame) -> tuple[int, int]:
    """Bytes of the texts of a written table, and rows: its files tell little, as texts that repeat are stored once."""
    size, n = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.count(F.lit(1))).first()
    return size or 0, n


def if_small(df: DataFrame) -> DataFrame:
    """A side of a join that is broadcast if it is small, as measured."""
    return F.broadcast(df) if measured(df)[0] <= SHARED_BYTES else df


def shared_texts(rows: DataFrame, texts: DataFrame, on: str, by: str, how: str = "inner") -> DataFrame:
    """``rows`` (narrow) with the ``texts`` of their key ``on``, to be grouped by ``by`` next; both are written, as they are
    read twice.

    Where many rows share few texts, a join dealt by key sends every text once per row to its group, which is many times what
    there is. So rows are dealt by group first, into tasks that hold TASK_BYTES of text each, and the texts come to
    them as a broadcast: neither they nor the groups move again. More than SHARED_BYTES, as measured, are dealt by key.
    """
    size, n = measured(texts)
    if size > SHARED_BYTES:
        return rows.join(dealt(texts), on, how)
    each = size // max(n, 1) + 1
    # With fewer partitions than a shuffle has by default, Spark would deal the groups again for the next join.
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() * each // TASK_BYTES))
    return rows.repartition(tasks, by).join(F.broadcast(texts), on, how)


BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: rows may be large, and a batch counts rows only unless told otherwise."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
