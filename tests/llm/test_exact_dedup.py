import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from plaza.llm import exact_dedup, golomb


@given(st.sets(st.integers(0, 2**48 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_golomb_round_trip(values):
    numbers = np.array(sorted(values), dtype=np.uint64)
    code = golomb.encode(numbers, 48)
    assert golomb.decode(len(numbers), *code).tolist() == numbers.tolist()


def test_golomb_is_short():
    numbers = np.unique(np.random.default_rng(1).integers(0, 2**48, 10_000, dtype=np.uint64))
    width, unary, rest = golomb.encode(numbers, 48)
    assert len(unary) + len(rest) < 0.75 * 8 * len(numbers)


def expected(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            own = keep if len(ids) > 1 else i
            out.append((i, own, len(ids), own == i, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_awkward_rows(documents, awkward, scratch):
    assert found(exact_dedup.exact_groups(documents(awkward), scratch)) == expected(awkward)


@pytest.mark.parametrize("parts", [1, 7])
def test_hot_group_over_partitions(documents, scratch, parts):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i // 2}", "en") for i in range(300)]
    assert found(exact_dedup.exact_groups(documents(rows).repartition(parts), scratch)) == expected(rows)


def test_empty_table(documents, scratch):
    assert found(exact_dedup.exact_groups(documents([]), scratch)) == []
