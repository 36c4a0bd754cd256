import os

import pytest

from plaza.llm.common import Scratch


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


@pytest.fixture(scope="session")
def documents(spark):
    """A table with what tables may hold: nulls, empty and long texts, ties, repeated rows, other columns."""

    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        if extra:  # names that the operators use themselves
            for name in ("row", "kept", "text_sha256", "found", "spans", "signature", "key", "fp", "piece", "n"):
                df = df.selectExpr("*", f"concat('x', doc_id) AS `{name}`")
        return df

    return make


LONG = " ".join(f"word{i} again" for i in range(20_000))
AWKWARD = [
    (1, "The same text here.", "en"), (2, "The  same\ttext here.", "en"), (3, None, None), (4, "", "en"), (5, "", None),
    (6, "   \n\t ", "en"), (7, LONG, "en"), (8, LONG, "en"), (9, "x", "en"), (9, "x", "en"), (None, "no id", "en"),
    (None, None, None), (10, "\x00\x01 odd 😀 漢字 ▁ text", "de"), (11, "The same text here.", "en"),
    (12, "no id", "en"), (13, "1234567", "en"),
]


@pytest.fixture(scope="session")
def awkward():
    return AWKWARD


@pytest.fixture(scope="session")
def sf():
    root = "/root/testdata/sf0.001"
    if not os.path.isdir(root):
        pytest.skip("no test tables")
    return root
