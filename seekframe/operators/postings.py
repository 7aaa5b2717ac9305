"""Search tables (postings + statistics) and batch search over them.

``postings``    field, term, _id, tf, dl, positions   (one row per term per document)
``term_stats``  field, term, df, max_tf, min_dl_per_tf
``field_stats`` field, n, sum_dl

Built once from an index without a shuffle (a document's tokens stand in one
row) and written without one: partitioned by ``field``, rows sorted by
(``term``, ``_id``) within each batch of documents, so a lookup of a few terms
reads a few pages of each batch, and a term that stands in most
documents spreads over all files.  Term statistics are counted from the written
postings, so no step builds them again.

``term_stats`` also holds each term's largest tf and smallest dl / tf, which bound
its part of any score whatever the average length is (:mod:`.batch`).  After a
mutation :func:`refresh_tables` merges signed counts of the changed documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.analysis import DEFAULT_ANALYZERS, AnalyzerRegistry
from ..sources.index import Index
from ..sources.mapping import token_column_name
from ..session import staged


@dataclass
class SearchTables:
    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    fields: tuple[str, ...]     # the fields that the tables cover
    counted: bool = False       # term_stats are the counts of these postings and nothing else

    # used by the clause compiler: statistics from the stored tables
    def scalar(self, kind: str, path: str, term=None) -> Column | None:
        if path not in self.fields:
            return None
        fs = self.field_stats.filter(F.col("field") == F.lit(path))
        if kind == "n_docs":
            return fs.agg(F.max("n")).scalar()
        if kind == "avgdl":
            return fs.agg((F.max("sum_dl").cast("double") / F.max("n").cast("double"))).scalar()
        if kind == "df":
            ts = self.term_stats.filter((F.col("field") == F.lit(path)) & (F.col("term") == F.lit(term)))
            return ts.agg(F.coalesce(F.max("df"), F.lit(0).cast("bigint"))).scalar()
        return None

    def vocabulary(self, path: str) -> DataFrame | None:
        if path not in self.fields:
            return None
        return self.term_stats.filter(F.col("field") == F.lit(path)).select("term", "df")


def _text_fields(index: Index, fields: list[str] | None) -> list[str]:
    if fields:
        return list(fields)
    return [k for k, v in index.mapping.properties.items() if v.is_text and v.index]


def _postings_of(positions: bool) -> Callable:
    """For ``mapInArrow``: the postings of batches of documents (_id, dl, tokens), sorted by term and document."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    group, rows = 1 << 21, 1 << 16      # tokens sorted at once (a longer document alone), rows handed on at once

    def sorted_runs(docs: pa.RecordBatch) -> pa.RecordBatch:
        ids, dl, tokens = docs.columns
        lengths, n = dl.to_numpy(zero_copy_only=False), docs.num_rows
        words = tokens.flatten().dictionary_encode("encode")
        by_term, by_id = (pc.sort_indices(x).to_numpy() for x in (words.dictionary, ids))
        term, doc = np.empty(len(by_term), "int64"), np.empty(n, "int64")
        term[by_term], doc[by_id] = np.arange(len(by_term)), np.arange(n)
        longest = int(lengths.max())
        place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # term, document and position as one number: below 2^62, as n + longest and the terms are at most group + 1
        key = np.sort((term[words.indices.to_numpy()] * n + np.repeat(doc, lengths)) * longest + place)
        run, place = np.divmod(key, longest)
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        ends = np.append(first, len(run))
        term, doc = np.divmod(run[first], n)
        doc = by_id[doc]
        out = [words.dictionary.take(pa.array(by_term[term])), ids.take(pa.array(doc)), pa.array(lengths[doc]), pa.array(np.diff(ends))]
        names = ["term", "_id", "dl", "tf"]
        if positions:
            out.append(pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(place.astype("int32"))))
            names.append("positions")
        return pa.RecordBatch.from_arrays(out, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto = np.cumsum(batch.column(1).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + group, "right")))
                out = sorted_runs(batch.slice(at, end - at))
                yield from (out.slice(i, rows) for i in range(0, out.num_rows, rows))
                at = end

    return run


def build_postings(index: Index, fields: list[str] | None = None, positions: bool = True) -> DataFrame:
    """Postings without a shuffle: all tokens of a document stand in its row, so a batch of rows sorts its own
    (term, document, position) triples and cuts them into runs."""
    names = _text_fields(index, fields)
    ix = index.with_tokens(names)
    kind = {f.name: f.dataType.simpleString() for f in ix.df.schema.fields}["_id"]
    parts = []
    for f in names:
        toks = F.col(f"`{token_column_name(f)}`")
        docs = ix.df.select("_id", F.size(toks).cast("bigint").alias("dl"), toks.alias("tokens")).filter("dl > 0")
        made = docs.mapInArrow(_postings_of(positions), f"term string, _id {kind}, dl long, tf long" + (", positions array<int>" if positions else ""))
        parts.append(made.select(F.lit(f).alias("field"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_term_stats(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("max_tf"),
                                                   F.min(F.col("dl") / F.col("tf")).alias("min_dl_per_tf"))


def build_field_stats(index: Index, fields: list[str] | None = None) -> DataFrame:
    names = _text_fields(index, fields)
    ix = index.with_tokens(names)
    parts = []
    for f in names:
        toks = F.col(f"`{token_column_name(f)}`")
        parts.append(ix.df.agg(F.lit(f).alias("field"), F.count_if(toks.isNotNull()).alias("n"),
                               F.coalesce(F.sum(F.size(toks)), F.lit(0)).cast("bigint").alias("sum_dl")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_tables(index: Index, fields: list[str] | None = None, positions: bool = True) -> SearchTables:
    postings = build_postings(index, fields, positions)
    return SearchTables(postings, build_term_stats(postings), build_field_stats(index, fields),
                        tuple(_text_fields(index, fields)), counted=True)


def scan_tables(index: Index, field: str, terms: DataFrame) -> SearchTables:
    """Search tables of ``field`` restricted to the terms in ``terms.term``,
    built from the index in the same job (no stored postings needed).

    Tokens that no query asks for go before anything is counted; the rest are
    counted within their document before the shuffle.  Document frequencies of
    the terms are exact because every posting of a kept term is kept."""
    toks = F.col(f"`{token_column_name(field)}`")
    # one entry without a term for every document, so that the same pass gives the statistics of all documents
    tokens = index.with_tokens([field]).df.select("_id", F.size(toks).cast("bigint").alias("dl"),
                                                  F.explode(F.concat(toks, F.array(F.lit(None).cast("string")))).alias("term"))
    wanted = terms.select(F.col("term").alias("wanted")).distinct()
    wanted = wanted.unionByName(wanted.sparkSession.range(1).select(F.lit(None).cast("string").alias("wanted")))
    kept = staged(tokens.join(wanted, F.col("term").eqNullSafe(F.col("wanted")), "left_semi")
                  .groupBy("_id", "dl", "term").agg(F.count(F.lit(1)).alias("tf")).withColumn("field", F.lit(field)), "postings")
    post = kept.filter("term is not null")
    whole = kept.filter("term is null").groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("sum_dl"))
    return SearchTables(post, build_term_stats(post), whole, (field,))


def write_tables(tables: SearchTables, path: str, mode: str = "overwrite") -> SearchTables:
    """Write the three tables under ``path``; postings sorted by term and document in each file, so no term is one partition."""
    spark = tables.postings.sparkSession
    # as built they are sorted by batch, which serves as well and needs no memory
    postings = tables.postings if tables.counted else tables.postings.sortWithinPartitions("field", "term", "_id")
    (postings.write.mode(mode).partitionBy("field").parquet(f"{path}/postings"))
    term_stats = build_term_stats(spark.read.schema(tables.postings.schema).parquet(f"{path}/postings")) if tables.counted else tables.term_stats
    term_stats.write.mode(mode).partitionBy("field").parquet(f"{path}/term_stats")
    tables.field_stats.coalesce(1).write.mode(mode).parquet(f"{path}/field_stats")
    return read_tables(spark, path)


def read_tables(spark, path: str) -> SearchTables:
    stats = spark.read.parquet(f"{path}/field_stats")          # one row a field
    return SearchTables(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/term_stats"), stats,
                        tuple(r["field"] for r in stats.select("field").collect()))


def refresh_postings(old: DataFrame, index: Index, changed_ids: DataFrame, fields: list[str] | None = None,
                     positions: bool = True) -> DataFrame:
    """Postings after a mutation: drop the changed ids, add postings of their
    new versions (deleted ids simply have none).  Only changed documents are
    re-tokenised."""
    ids = changed_ids.select("_id").distinct()
    kept = old.join(ids, "_id", "left_anti")
    fresh_docs = index.with_df(index.df.join(ids, "_id", "left_semi"))
    fresh = build_postings(fresh_docs, fields, positions)
    return kept.unionByName(fresh.select(*old.columns))


def refresh_tables(tables: SearchTables, old: Index, new: Index, changed_ids: DataFrame) -> SearchTables:
    """All three tables after a mutation from ``old`` to ``new`` that changed, added or deleted ``changed_ids``.

    Statistics move by signed counts of the old and new versions of these
    documents alone; terms that no document holds any more go.  ``max_tf`` and
    ``min_dl_per_tf`` only widen, so they stay bounds."""
    fields = list(tables.fields)
    # staged, so that Spark knows how few they are and need not exchange postings and documents to meet them
    ids = staged(changed_ids.select("_id").distinct(), "changed")
    positions = "positions" in tables.postings.columns
    gone = tables.postings.join(ids, "_id", "left_semi").select("field", "term", F.lit(-1).cast("long").alias("df"), "tf", "dl")
    fresh = build_postings(new.with_df(new.df.join(ids, "_id", "left_semi")), fields, positions)
    moved = gone.unionByName(fresh.select("field", "term", F.lit(1).cast("long").alias("df"), "tf", "dl"))
    delta = moved.groupBy("field", "term").agg(F.sum("df").alias("df"), F.max("tf").alias("max_tf"),
                                                 F.min(F.col("dl") / F.col("tf")).alias("min_dl_per_tf"))
    # a term that leaves one document and enters another has no row to change in ``df``, but may widen its bounds
    columns = ["field", "term", "df", "max_tf", "min_dl_per_tf"]
    term_stats = (tables.term_stats.select(*columns).unionByName(delta.select(*columns)).groupBy("field", "term")
                  .agg(F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_dl_per_tf").alias("min_dl_per_tf")).filter("df > 0"))
    before = build_field_stats(old.with_df(old.df.join(ids, "_id", "left_semi")), fields)
    after = build_field_stats(new.with_df(new.df.join(ids, "_id", "left_semi")), fields)
    field_stats = (tables.field_stats.select("field", "n", "sum_dl").unionByName(after)
                   .unionByName(before.select("field", (-F.col("n")).alias("n"), (-F.col("sum_dl")).alias("sum_dl")))
                   .groupBy("field").agg(F.sum("n").alias("n"), F.sum("sum_dl").alias("sum_dl")))
    postings = tables.postings.join(ids, "_id", "left_anti").unionByName(fresh.select(*tables.postings.columns))
    return SearchTables(postings, term_stats, field_stats, tables.fields)


def query_term_table(queries: DataFrame, query_col: str, id_col: str, field: str,
                     analyzer: str | None = None, registry: AnalyzerRegistry | None = None) -> DataFrame:
    """query_id, field and term of every distinct term of every query."""
    an = (registry or DEFAULT_ANALYZERS).get(analyzer)
    return queries.select(F.col(id_col).alias("query_id"), F.lit(field).alias("field"),
                          F.explode(F.array_distinct(an.column(F.col(query_col)))).alias("term"))
