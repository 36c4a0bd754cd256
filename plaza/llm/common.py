"""What the operators share: tables, written intermediates, packed numbers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaza.session import shared_dir

# White space of all contracts: the blank and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Stands for a null id in Python, where a column of whole numbers with nulls would turn into
# floats; an id of this value counts as null.
NO_ID = -(1 << 63)


def named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID)).alias(column)


def unnamed(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column)).alias(column)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """The maximal runs of characters other than white space."""
    return F.filter(F.split(text, f"{SPACE}+", -1), lambda w: w != "")


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Texts are long: a worker is to hold a few megabytes of them at a time, not ten thousand rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


class Scratch:
    """Written intermediates of one run, in the folder all executors share.

    A written table cuts the lineage and survives lost executors. ``drop`` removes
    one that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        small_batches(spark)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)

    def free(self) -> None:
        """Let Spark remove the shuffle files of queries that have ended."""
        self.spark._jvm.System.gc()


def give_back() -> None:
    """Return memory that Python and Arrow hold free to the system: a worker is kept for later tasks, and C's allocator
    (where it has this call) would keep the most it ever had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def squeezed(raw: bytes) -> bytes:
    """Bytes that are written and shuffled as one value, packed tighter than Spark's own codecs do."""
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unsqueezed(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def pieces_of(rows: int, each: int, least: int = 16) -> int:
    """How many groups to deal ``rows`` into, so that one holds about ``each``."""
    return max(least, -(-rows // each))


def batches_of(frames: Iterator[pd.DataFrame], column: str, limit: int) -> Iterator[pd.DataFrame]:
    """The same rows in slices of about ``limit`` characters (one row at least)."""
    for frame in frames:
        if len(frame):
            sizes = frame[column].str.len().fillna(0).to_numpy().astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(frame)]):
                if hi > lo:
                    yield frame.iloc[lo:hi]
