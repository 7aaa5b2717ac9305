"""Batch search: a table of queries against search tables, with exact pruning.

Scoring every document that shares a term with a query costs the product of
queries and documents, as common words stand nearly everywhere.  Three steps
avoid that and give the same rows:

1. *Floor.*  Each query's rarest terms are scored alone, and the k best documents
   by these are scored in full.  The least of these k scores is a floor of the
   k-th best score of all.
2. *Essential terms.*  A term's part is at most its idf times the tf factor of
   its largest tf and smallest dl / tf (``term_stats``).  A query's terms with the
   smallest bounds, as many as sum up to less than the floor, cannot bring a
   document among the first k by themselves; the others are essential.  Only
   documents with an essential term are candidates, and only those whose
   essential parts and the bounds of the rest reach the floor stay.
3. *Completion.*  Candidates look up their remaining parts by (term, document),
   so the postings of common words are read once for all queries.

Query terms, floors and bounds are small tables staged in the shared folder,
which tells Spark their size: it broadcasts them where that allows and joins
them by shuffle where not.  The top k per query go through a partial group
limit before the last shuffle.

A query table may carry conditions: ``where`` maps document columns to
expressions over the query's row; a null expression means no condition, so one
batch holds queries with and without them (``F.when`` and ``F.coalesce`` give a
choice of two).  Queries with the same conditions form a group; a document stands
in every group whose conditions it meets, and the postings that a group's queries
ask for are staged once by group.  Rarity, floors and bounds then count only
documents that pass.  The k best by their essential parts are scored in full for a
second floor, close to the k-th best score, and the few candidates that it leaves
meet the remaining postings by document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring import bm25, idf, round_score, tf_norm, tf_norm_bound
from ..session import staged
from ..sources.index import Index
from .postings import SearchTables, query_term_table, scan_tables

#: More than rounding can move a score.
_MARGIN = 1e-5


class _Batch:
    """The staged tables of one batch: query terms with their bounds and whether they are essential."""

    def __init__(self, tables: SearchTables, queries: DataFrame, query_col: str, id_col: str, field: str, k: int,
                 analyzer: str | None, where: dict[str, Column] | None, documents: DataFrame | None, seeds: int):
        self.k = k
        postings = tables.postings.filter(F.col("field") == F.lit(field))
        # one row, read once for all steps
        known = tables.field_stats.filter(F.col("field") == F.lit(field)).agg(F.max("n"), F.max("sum_dl")).first()
        n, total = known[0] or 0, known[1] or 0
        self.n, self.avgdl = F.lit(n).cast("bigint"), F.lit(total / n if n else None).cast("double")
        self.post = postings.select("term", "_id", tf_norm(F.col("tf"), F.col("dl"), self.avgdl).alias("norm"))
        qt = query_term_table(queries, query_col, id_col, field, analyzer).select("query_id", "term").distinct()
        known = tables.term_stats.filter(F.col("field") == F.lit(field)).drop("field")
        self.grouped = bool(where)
        if self.grouped:
            if documents is None:
                raise ValueError("where needs the documents that hold its columns")
            #: what postings and query terms are joined by
            self.on = ["slot"]
            terms = self._grouped(qt.join(known.select("term", "df"), "term"), queries, id_col, where, documents)
        else:
            self.on = ["term"]
            most = tf_norm_bound(F.col("max_tf"), F.col("min_dl_per_tf"), self.avgdl)
            terms = qt.join(known, "term").select("query_id", "term", "df", F.col("df").alias("met"), (idf(self.n, F.col("df")) * most).alias("bound"))
        terms = staged(terms, "terms")
        before = Window.partitionBy("query_id").orderBy("met", "term").rowsBetween(Window.unboundedPreceding, -1)
        rare = terms.withColumn("seen", F.coalesce(F.sum("met").over(before), F.lit(0))).filter(F.col("seen") < seeds * k)
        floors = self._floors(self._scored(rare), terms)
        upto = Window.partitionBy("query_id").orderBy("bound", F.desc("df"), "term")
        small = F.sum("bound").over(upto) < F.col("floor") - _MARGIN
        self.terms = staged(terms.join(floors, "query_id", "left").withColumn("essential", ~F.coalesce(small, F.lit(False))), "essential")

    def _grouped(self, terms: DataFrame, queries: DataFrame, id_col: str, where: dict[str, Column], documents: DataFrame) -> DataFrame:
        """The query terms that a passing document holds: how many do, and a bound of the term's part in these.

        ``post`` becomes the postings that any query asks for, once for every group of conditions that their document meets;
        a term and a group make a slot, a number, which joins faster than words.
        """
        asked, held = [f"q{i}" for i in range(len(where))], [f"d{i}" for i in range(len(where))]
        # every combination of a query that stands there several times is one of its conditions
        given = (queries.select(F.col(id_col).alias("query_id"), *[e.alias(q) for q, e in zip(asked, where.values())]).filter("query_id is not null")
                 .groupBy("query_id").agg(F.sort_array(F.collect_set(F.struct(*asked))).alias("conditions")))
        given = staged(given.withColumn("group", F.min("query_id").over(Window.partitionBy("conditions"))), "conditions")
        choices = given.select("group", F.inline("conditions")).distinct()
        # equal ids are one document, which passes if any of its rows does, and whose parts are summed
        rows = staged(documents.select("_id", *[F.col(f"`{c}`").alias(d) for c, d in zip(where, held)]).filter("_id is not null")
                      .withColumn("copies", F.count(F.lit(1)).over(Window.partitionBy("_id"))), "rows")
        members = []
        for unset in choices.select(*[F.col(q).isNull() for q in asked]).distinct().collect():
            some = choices.filter(reduce(Column.__and__, [F.col(q).isNull() == F.lit(u) for q, u in zip(asked, unset)]))
            equal = [F.col(d) == F.col(q) for d, q, u in zip(held, asked, unset) if not u]
            members.append((rows.join(some, equal) if equal else rows.crossJoin(some)).select("_id", "group", "copies"))
        terms = staged(terms.join(given.select("query_id", "group"), "query_id"), "asked")
        slots = staged(terms.select("term", "group").distinct().withColumn("slot", F.monotonically_increasing_id()), "slots")
        terms = terms.join(slots, ["term", "group"])
        if not members:
            return terms.select("query_id", "term", "slot", "df", F.lit(0).cast("long").alias("met"), F.lit(0.0).alias("bound"))
        members = staged(reduce(DataFrame.unionByName, members).distinct(), "members")
        self.post = staged(self.post.join(slots.select("term").distinct(), "term", "left_semi").join(members, "_id")
                           .join(slots, ["term", "group"]).select("slot", "_id", "norm", "copies"), "held")
        met = self.post.groupBy("slot").agg(F.count(F.lit(1)).alias("met"), F.max(F.col("norm") * F.col("copies")).alias("most"))
        return terms.join(met, "slot").select("query_id", "term", "slot", "df", "met", (idf(self.n, F.col("df")) * F.col("most")).alias("bound"))

    def _part(self) -> Column:
        return idf(self.n, F.col("df")) * F.col("norm")

    def _scored(self, terms: DataFrame) -> DataFrame:
        """query_id, _id and got: the summed parts of these terms."""
        return (self.post.join(terms.select("query_id", *self.on, "df"), self.on)
                .groupBy("query_id", "_id").agg(F.sum(self._part()).alias("got")))

    def _floors(self, scored: DataFrame, terms: DataFrame) -> DataFrame:
        """query_id and floor: the k best of these are scored in full, so k documents reach at least the least of their scores."""
        best = Window.partitionBy("query_id").orderBy(F.desc("got"))
        few = staged(scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= self.k)
                     .select("query_id", "_id").join(terms.select("query_id", *self.on, "df"), "query_id"), "first")
        return (self.post.join(few, [*self.on, "_id"]).groupBy("query_id", "_id").agg(F.sum(self._part()).alias("got"))
                .groupBy("query_id").agg(F.when(F.count(F.lit(1)) == self.k, F.min("got")).alias("floor")))

    def candidates(self) -> DataFrame:
        """query_id, _id and got of every document that can be among the first k."""
        rest = self.terms.groupBy("query_id").agg(
            F.sum(F.when(~F.col("essential"), F.col("bound")).otherwise(0.0)).alias("rest"), F.max("floor").alias("floor"))
        reach = F.col("floor").isNull() | (F.col("got") + F.col("rest") >= F.col("floor") - _MARGIN)
        got = self._scored(self.terms.filter("essential")).join(rest, "query_id").filter(reach).drop("floor")
        if self.grouped:            # whose bounds hold for ids in several rows too
            got = staged(got, "got")
            got = got.join(self._floors(got.select("query_id", "_id", "got"), self.terms), "query_id", "left").filter(reach)
        return got.select("query_id", "_id", "got")

    def scored(self) -> DataFrame:
        others = self.terms.filter(~F.col("essential")).select("query_id", *self.on, "df")
        common = self.post.join(others.select(*self.on).distinct(), self.on, "left_semi")
        if self.grouped:            # few are left, so that they meet the postings by document
            candidates = staged(self.candidates(), "candidates")
            parts = (common.join(candidates.select("query_id", "_id"), "_id").join(others, ["query_id", *self.on])
                     .select("query_id", "_id", self._part().alias("got")))
            sums = candidates.unionByName(parts).groupBy("query_id", "_id").agg(F.sum("got").alias("raw"))
        else:
            wanted = self.candidates().join(others, "query_id", "left")
            sums = (wanted.join(common, [*self.on, "_id"], "left")
                    .groupBy("query_id", "_id").agg((F.max("got") + F.coalesce(F.sum(self._part()), F.lit(0.0))).alias("raw")))
        return sums.select("query_id", "_id", round_score(F.col("raw")).alias("_score"))


def batch_candidates(tables: SearchTables, queries: DataFrame, query_col: str, id_col: str, field: str, k: int = 10,
                     analyzer: str | None = None, *, where: dict[str, Column] | None = None, documents: DataFrame | None = None,
                     seeds: int = 64) -> DataFrame:
    """query_id and _id of the pairs that :func:`batch_search` scores in full."""
    return _Batch(tables, queries, query_col, id_col, field, k, analyzer, where, documents, seeds).candidates().select("query_id", "_id")


def batch_search(tables: SearchTables, queries: DataFrame, query_col: str, id_col: str, field: str, k: int = 10,
                 analyzer: str | None = None, *, where: dict[str, Column] | None = None, documents: DataFrame | None = None,
                 seeds: int = 64) -> DataFrame:
    """Top ``k`` documents per query (``query_id, _id, _score, rank``) by BM25 over ``field``; ties broken by ``_id``.

    A query without hits is one row of nulls.  ``documents`` holds ``_id`` and the
    columns that ``where`` names.  ``seeds`` times k is how many postings of the
    rarest terms at least set the floor (it changes the cost, not the result).
    """
    batch = _Batch(tables, queries, query_col, id_col, field, k, analyzer, where, documents, seeds)
    w = Window.partitionBy("query_id").orderBy(F.desc("_score"), F.asc("_id"))
    top = batch.scored().withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)
    asked = queries.select(F.col(id_col).alias("asked")).distinct()
    return asked.join(top, F.col("asked").eqNullSafe(F.col("query_id")), "left").select(
        F.col("asked").alias("query_id"), "_id", "_score", "rank")


def each_items(index: Index, items: DataFrame, item_col: str, field: str, *, boost_col: str | None = None) -> DataFrame:
    """One should-clause for every row of ``items`` (``_id``, ``_score`` of the documents that any of them matches).

    On a text field an item is matched like a query, elsewhere it is one value.  Items
    are summed up by term first, so a document costs as many rows as it holds terms of any item.
    """
    boost = F.lit(1.0) if boost_col is None else F.coalesce(F.col(boost_col).cast("double"), F.lit(1.0))
    rf = index.field(field)
    if rf.is_text:
        an = index.analyzers.get(rf.search_analyzer)
        terms = items.select(F.explode(F.array_distinct(an.column(F.col(item_col)))).alias("term"), boost.alias("boost"))
        terms = staged(terms.groupBy("term").agg(F.sum("boost").alias("boost")), "items")
        tables = index.stats if index.stats is not None and field in index.stats.fields else scan_tables(index, field, terms)
        n, avgdl = tables.scalar("n_docs", field), tables.scalar("avgdl", field)
        known = terms.join(tables.term_stats.filter(F.col("field") == F.lit(field)).select("term", "df"), "term")
        post = tables.postings.filter(F.col("field") == F.lit(field)).select("term", "_id", "tf", "dl")
        part = F.col("boost") * bm25(F.col("tf"), F.col("dl"), n, F.col("df"), avgdl)
        return post.join(known, "term").groupBy("_id").agg(round_score(F.sum(part)).alias("_score"))
    value = F.col(item_col).cast(rf.element_type)
    if rf.spec.normalizer in ("lowercase", "lower"):
        value = F.lower(value)
    wanted = (items.select(value.alias("value"), boost.alias("boost")).filter("value is not null")
              .groupBy("value").agg(F.sum("boost").alias("boost")))
    held = index.df.select("_id", (F.explode(F.array_distinct(rf.predicate_value)) if rf.is_array else rf.predicate_value).alias("value"))
    hits = held.join(wanted, "value")
    if isinstance(rf.element_type, T.StringType):            # keyword: a value's weight is its idf
        n = index.df.agg(F.count_if(rf.value.isNotNull())).scalar()
        hits = hits.join(hits.groupBy("value").agg(F.count(F.lit(1)).alias("df")), "value")
        hits = hits.withColumn("boost", F.col("boost") * idf(n, F.col("df")))
    return hits.groupBy("_id").agg(round_score(F.sum("boost")).alias("_score"))


def postings_search(tables: SearchTables, field: str, terms: list[str], k: int = 10) -> DataFrame:
    """One query answered from the postings (reads only the rows of its terms)."""
    spark = tables.postings.sparkSession
    q = spark.createDataFrame([(0, " ".join(dict.fromkeys(terms)))], "query_id int, q string")
    return batch_search(tables, q, "q", "query_id", field, k, analyzer="whitespace").drop("query_id")
