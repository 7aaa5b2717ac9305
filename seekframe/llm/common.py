"""Helpers that several operators share: input, ASCII case, shared folder."""

from __future__ import annotations

import contextlib
import functools
import string
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.session import gone_at_exit

#: Words of the word-based contracts: ASCII digits, lower-case letters, anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; null counts as empty text."""
    return F.translate(F.coalesce(c, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def words(c: Column) -> Column:
    """Array of the words of a text that is already lower-cased.

    Every character that no word holds separates words, so splitting on runs
    of them gives the words and at most an empty string at either end.
    """
    return F.filter(F.split(c, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def row_key() -> Column:
    """Tells rows apart that repeat a doc_id with another text; equal rows share it, and their results."""
    return F.xxhash64("text")


def packed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs`` as one struct), doc_id, rk and text, so that no name of ``docs`` can clash.

    ``select("row.*")`` gives the rows back as they were.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), "doc_id", row_key().alias("rk"), "text")


def taught_text(rows: DataFrame) -> DataFrame:
    """One row (doc_id, y, text) for each labelled id of ``rows``: of several texts the one with the smallest MD5."""
    text = F.coalesce("text", F.lit(""))
    return rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.md5(text).alias("digest"), text.alias("text"))).alias("t")).select(
        "doc_id", "y", "t.text")


@functools.cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="seekframe-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A folder of its own only where none is set and everything runs in one process.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = _own_dir()
    return d.rstrip("/")


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when each job is done: what they lead to is on the shared store by then."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def stored(df: DataFrame, name: str, *, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: whatever is read from it later survives the loss of
    executors without repeating the work, and Spark knows its size, so small
    tables are broadcast by the session's own threshold and large ones are not.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    gone_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
