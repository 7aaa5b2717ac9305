import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from seekframe.session import checkpoint_dir, local_session

    s = local_session(4, 4, app="seekframe-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def docs(spark):
    """The reference's integration document shape: _id, title, body, type, createdAt."""
    from datetime import datetime

    from seekframe import Index, Mapping

    rows = [
        ("1", "hello world", "plain body", "TEST_A", datetime(2025, 1, 1)),
        ("2", "world hello", "hello world body", "TEST_B", datetime(2025, 1, 15, 10, 0)),
        ("3", "exact match title", "bodyA.\n bodyB", "TEST_A", datetime(2025, 3, 1)),
        ("4", "keyword1 title", None, "TEST_B", datetime(2025, 6, 1)),
    ]
    df = spark.createDataFrame(rows, "_id string, title string, body string, type string, createdAt timestamp")
    m = Mapping().text("title", keyword=True).text("body").keyword("type").date("createdAt")
    return Index(df, m, name="test")
