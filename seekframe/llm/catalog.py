"""The queries of the subpackage, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seekframe.llm.bytepair import bytepair_digest
from seekframe.llm.common import read
from seekframe.llm.decontaminate import DECONTAMINATE_SQL, decontaminate_digest
from seekframe.llm.licenses import licenses_digest, licenses_sql
from seekframe.llm.linedup import LINEDUP_SQL, linedup_digest
from seekframe.llm.mixing import mixing_digest, mixing_sql
from seekframe.llm.neardup import neardup_digest
from seekframe.llm.periodic import periodic_digest
from seekframe.llm.quality import quality_digest
from seekframe.llm.secrets import secrets_digest
from seekframe.llm.tokens import tokens_digest
from seekframe.llm.topk import TOPK_SQL, topk_digest
from seekframe.llm.toxicity import toxicity_digest
from seekframe.llm.trie import TRIE_SQL, conversations_digest

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses_digest(read(spark, sf_dir, "documents"))


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_digest(read(spark, sf_dir, "documents"))


def op4_linedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup_digest(read(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_digest(read(spark, sf_dir, "documents"))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_digest(read(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate_digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_digest(read(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(read(spark, sf_dir, "documents"))


def op11_bytepair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepair_digest(read(spark, sf_dir, "documents"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations_digest(read(spark, sf_dir, "conversations"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_digest(read(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_quality, op2_licenses, op3_neardup, op4_linedup, op5_tokens, op6_topk, op7_toxicity,
                                    op8_mixing, op9_decontaminate, op10_secrets, op11_bytepair, op12_trie,
                                    op13_periodic)}


def llm_sql() -> dict[str, str]:
    return {"op2_licenses": licenses_sql(), "op4_linedup": LINEDUP_SQL, "op6_topk": TOPK_SQL, "op8_mixing": mixing_sql(), "op9_decontaminate": DECONTAMINATE_SQL,
            "op12_trie": TRIE_SQL}
