"""Each stage on its own input, against brute force, and the whole on awkward rows."""

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from plaza.llm import packing
from plaza.llm.common import Scratch
from plaza.llm.queries import tokenizer_file
from tests.llm import test_exact_dedup as exact_model, test_minhash as near_model, test_pii as pii_model


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Input and output of every stage, written as the pipeline does."""
    scratch, docs, out = Scratch(spark, "stages"), spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = scratch.write(stage(spark, docs, sf), name)
        out[name] = docs, made
        docs = made
    return out


def rows(df):
    return [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]


def test_columns_stay(stages):
    for name, (docs, made) in list(stages.items())[:-1]:
        assert made.columns == docs.columns


def test_language_id_keeps_clean_documents(stages):
    docs, made = stages["language_id"]
    kept = {d: lang for d, _, lang in rows(made)}
    known = {d: lang for d, _, lang in rows(docs)}
    assert len(kept) >= 0.99 * len(known) and sum(kept[d] == known[d] for d in kept) > 0.97 * len(kept)


def test_exact_dedup(stages):
    docs, made = stages["exact_dedup"]
    want = {r[0] for r in exact_model.expected(rows(docs)) if r[3]}
    assert {d for d, *_ in rows(made)} == want


def test_near_dedup(stages):
    docs, made = stages["minhash_near_dedup"]
    want = {r[0] for r in near_model.expected(rows(docs), corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT) if r[3]}
    assert {d for d, *_ in rows(made)} == want


def test_personal_data_is_masked_and_nothing_else(stages):
    docs, made = stages["pii"]
    before, after = ({d: t for d, t, _ in rows(df)} for df in (docs, made))
    assert before.keys() == after.keys()
    masked = 0
    for d, text in before.items():
        spans = pii_model.base_spans(text)
        masked += bool(spans)
        assert not any(text[a:b] in after[d] for a, _, b, kind in spans if kind == "email")
        assert ("[" in after[d] and after[d] != text) if spans else True
    assert masked


def test_packing(stages):
    docs, made = stages["best_fit_packing"]
    own = packing.Encoder(tokenizer_file("byte_bpe_50k.json"))
    want = {d: [*own.whole.encode(t, add_special_tokens=False).ids, packing.END] for d, t, _ in rows(docs)}
    got, bins = {}, {}
    for r in sorted(made.collect(), key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(got.setdefault(r["doc_id"], []))
        got[r["doc_id"]] += np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for parts in bins.values():
        assert sum(n for _, n in parts) <= packing.LENGTH and len({o for o, _ in parts}) == len(parts)


def test_awkward_documents(spark, awkward, tmp_path):
    docs = spark.createDataFrame([(*r, "s", 1) for r in awkward], "doc_id long, text string, lang string, source string, n_chars long")
    for at, table in enumerate((docs, docs.limit(0))):
        folder = str(tmp_path / str(at))
        table.write.parquet(f"{folder}/documents.parquet")
        made = corpus_pipeline.run(spark, folder)
        assert {"doc_id", "sequence_id", "ids"} <= set(made.columns) and (made.count() > 0) == (at == 0)


def test_queries_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and names["pipeline"] is corpus_pipeline.run
