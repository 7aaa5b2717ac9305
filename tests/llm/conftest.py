import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, repeated ids, and columns named like the operators' own."""
    long_text = " ".join(f"word{i % 977}x{i % 31}" for i in range(20_000))
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, "", "en", "src1"), (2, None, "en", "src1"), (None, "null id here", "en", "src1"), (4, long_text, "de", None),
            (5, line, None, "src2"), (5, line, None, "src2"), (5, "another text for the same id", "en", "src2"),
            (7, "   \n\t ", "fr", ""), (8, line, "en", "src2"), (9, "short", "en", "src3"), (10, line + " extra", "en", "src2")]
    clash = "rk long, i long, label string, start long, severity double, epoch long, component long, _g_id long, slot long"
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 1, 2, "x", 3, 0.5, 4, 5, 6, 7) for r in rows],
                                 DOCS + ", " + clash)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (4, 1, 0), (5, 1, 1), (8, 1, 0), (8, 0, 0), (None, 1, 1), (9, None, None),
                                  (10, 7, 3)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
