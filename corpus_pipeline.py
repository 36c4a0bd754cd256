"""A corpus pipeline: from ``documents`` to packed sequences.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; what it returns is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``.

1. language_id: documents whose language the model rejects (or that have no letter) go; ``lang`` becomes the
   predicted language.
2. exact_dedup: of equal texts the one with the smallest id stays.
3. minhash_near_dedup: of each group of near-duplicates (five-word shingles, Jaccard 0.8 or more) the one with the
   smallest id stays.
4. pii: personal data is masked in the texts; ``n_chars`` follows.
5. best_fit_packing: pieces of the documents, with their ids, packed into sequences.

Columns of ``documents`` that are null stay so; an empty table goes through all stages. A row without id is kept by
the dedup stages unless an equal text with an id is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plaza.llm import exact_dedup, langid, minhash, packing, pii
from plaza.llm.common import Scratch, table
from plaza.llm.queries import tokenizer_file

NEAR_WORDS, NEAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = langid.predicted(docs, langid.train(docs)).filter("accepted")
    return judged.select(*[
        (F.col("lang_pred") if c == "lang" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def _kept(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents whose row stays. Ids are unique, so the smaller side is a list of ids; the
    texts are joined with those that go, which are few."""
    gone = groups.filter(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, exact_dedup.exact_groups(docs, Scratch(spark, "exact")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, minhash.near_groups(docs, Scratch(spark, "near"), NEAR_WORDS, NEAR_PERCENT))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask_documents(docs, Scratch(spark, "personal"))
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, tokenizer_file("byte_bpe_50k.json"), Scratch(spark, "packed"), keep_ids=True).drop("fill")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("pii", personal),
    ("best_fit_packing", packed),
]

# Learned models decide in the first and fourth stage, a tokenizer in the last: no SQL can say this.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch, before = Scratch(spark, "pipeline"), None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
