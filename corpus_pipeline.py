"""Corpus pipeline: toxicity, near-duplicates, benchmark passages, source mix, training-order shards.

Each stage reads all that its predecessor kept, as Parquet in the folder that
driver and executors share, and writes its own result there, so a lost
executor costs at most the stage at work.  All stages but the last return the
columns of ``documents``; the last returns one row for every sequence of its
shards.

Rows equal in doc_id and text are one document in every stage; null and empty
texts pass the filters and take part as documents without words; an empty
table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seekframe.llm.common import read, stored
from seekframe.llm.decontaminate import decontaminate
from seekframe.llm.mixing import document_mix, mix_documents
from seekframe.llm.neardup import drop_near_duplicates
from seekframe.llm.tokens import tokens_digest
from seekframe.llm.toxicity import fit_toxicity, reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7, fitted on the labelled rows of the whole corpus: documents that reach the limit go."""
    return reject_toxic(docs, fit_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3 on five-word shingles at 0.8: one document of each group stays."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a window of a benchmark item go."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each document as often as the target weights take it."""
    return mix_documents(docs, document_mix())


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: shards in training order, read back sequence by sequence."""
    return tokens_digest(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("token_shards", token_shards)]

#: The toxicity stage is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
