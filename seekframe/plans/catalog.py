"""Registered queries over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built with
the library.  Every query reads whole tables; the oracle for each lives in
:mod:`seekframe.plans.oracle` under the same key and returns the same
columns.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clauses import Bool, Match, Term
from ..operators.search import search
from ..sources.files import read_table
from ..sources.index import Index
from ..sources.mapping import Mapping

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


# ---- indices over the driver tables --------------------------------------

def documents_index(spark, sf_dir) -> Index:
    df = table(spark, sf_dir, "documents")
    m = (Mapping().long("doc_id").text("text").keyword("lang").keyword("source").long("n_chars"))
    return Index(df, m, name="documents", id_col="doc_id")


def benchmark_index(spark, sf_dir) -> Index:
    m = Mapping().long("item_id").text("text")
    return Index(table(spark, sf_dir, "benchmark"), m, name="benchmark", id_col="item_id")


def pages_index(spark, sf_dir) -> Index:
    m = Mapping().long("page_id").text("url").text("html")
    return Index(table(spark, sf_dir, "pages"), m, name="pages", id_col="page_id")


def events_index(spark, sf_dir) -> Index:
    m = (Mapping().long("event_id").date("ts").long("user_id").keyword("event_type")
         .double("value").keyword("props"))
    return Index(table(spark, sf_dir, "events"), m, name="events", id_col="event_id")


def orders_index(spark, sf_dir) -> Index:
    m = (Mapping().long("o_orderkey").long("o_custkey").keyword("o_orderstatus").double("o_totalprice")
         .date("o_orderdate").keyword("o_orderpriority"))
    return Index(table(spark, sf_dir, "orders"), m, name="orders", id_col="o_orderkey")


def part_index(spark, sf_dir) -> Index:
    m = (Mapping().long("p_partkey").text("p_name", keyword=True).keyword("p_brand").keyword("p_type")
         .integer("p_size").double("p_retailprice"))
    return Index(table(spark, sf_dir, "part"), m, name="part", id_col="p_partkey")


def lineitem_index(spark, sf_dir) -> Index:
    df = table(spark, sf_dir, "lineitem").withColumn(
        "_id", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return Index(df, name="lineitem")


# ---- X1 flagship ----------------------------------------------------------

FLAGSHIP_TEXT = "ering retion"


@register("flagship_search")
def flagship_search(spark, sf_dir):
    ix = documents_index(spark, sf_dir)
    q = Bool(must=[Match("text", FLAGSHIP_TEXT)], filter=[Term("lang", "en")])
    res = search(ix, q, sort=[("_score", "desc")], size=10, source=["doc_id", "lang", "n_chars"])
    return res.hits.drop("_sort")


def hits_of(res, keep_sort: bool = False) -> DataFrame:
    return res.hits if keep_sort else res.hits.drop("_sort")


def all_queries() -> dict[str, QueryFn]:
    # import the modules that register the rest
    from . import catalog_more, catalog_stored  # noqa: F401
    return dict(REGISTRY)
