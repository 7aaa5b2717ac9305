"""Exact top-k search by Fagin's threshold algorithm (operator 6).

Vectors fall into blocks of bounded size, each vector into one.  Within a block
each dimension has its list of rows sorted by value.  A query walks all lists
from the end that its component's sign prefers, a growing stretch at a time;
every row that comes up is scored in full, and the sum of query component times
the list value reached bounds all rows not seen yet.  The walk stops once this
threshold is *below* the kth score (at a tie a row not seen could still win by
its smaller id).

Bounds cross blocks: queries first meet one block, whose kth score is a floor
of the kth score of all.  Then a query goes only to blocks whose lists' ends
bound a score that reaches its floor, and starts with the floor there.  A task
holds one block and its lists while the queries stream by, so a vector is
shuffled once, however many queries there are.  The best ``k`` of each block
merge into the best ``k`` of all by a partial window limit.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component take no part; neither do rows with a null id; vectors of another
length than a query score nothing against it; a repeated row counts as often
as it stands there, and never against a query of the same id; a query id that
is repeated is one query for each distinct vector; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import stored

VECTOR_BLOCK = 32_768


def threshold_search(ids: np.ndarray, x: np.ndarray, lists: np.ndarray, q: np.ndarray, own: int, k: int,
                     floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of a block for one query: (ids, scores), best first, ties to the smaller id.

    ``lists`` holds for every dimension the row numbers by ascending value; rows below ``floor`` may be left out.
    Scores are whole numbers below 2**53, so float64 products are exact.
    """
    n, d = x.shape
    seen = np.zeros(n, bool)
    seen[ids == own] = True                       # never a candidate, costs nothing
    up = q < 0                                    # these lists are walked from the small end
    dims = np.flatnonzero(q)
    found_id, found = np.zeros(0, ids.dtype), np.zeros(0)
    depth, step = 0, max(2, 2 * k // max(d, 1))
    while True:
        to = min(n, depth + step)
        if len(dims):
            rows = np.concatenate([lists[dims[up[dims]], depth:to].ravel(),
                                   lists[dims[~up[dims]], n - to:n - depth].ravel()])
        else:                                     # all scores are 0, so every row is a tie
            rows, to = np.arange(n), n
        fresh = np.zeros(n, bool)
        fresh[rows] = True
        fresh &= ~seen
        new = np.flatnonzero(fresh)
        seen[new] = True
        if len(new):
            found_id = np.concatenate([found_id, ids[new]])
            found = np.concatenate([found, x[new] @ q])
            if len(found) > k:
                kth = -np.partition(-found, k - 1)[k - 1]
                keep = found >= kth
                found_id, found = found_id[keep], found[keep]
                if len(found) > 4 * k:
                    best = np.lexsort((found_id, -found))[:k]
                    found_id, found = found_id[best], found[best]
        if to >= n:
            break
        least = max(floor, found.min() if len(found) >= k else -np.inf)
        if least > -np.inf:
            reached = np.where(up[dims], lists[dims, to - 1], lists[dims, n - to])
            if float(x[reached, dims] @ q[dims]) < least:
                break
        depth, step = to, step * 2
    best = np.lexsort((found_id, -found))[:k]
    return found_id[best], found[best]


def top_k(vectors: DataFrame, queries: Column, *, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = VECTOR_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``queries`` holds its k best other rows.

    Components become floor(scale * component), so that scores are whole numbers.
    """
    comp = F.col(vector_col)
    fine = (F.col(id_col).isNotNull() & comp.isNotNull() & (F.size(comp) > 0)
            & F.forall(comp, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False))))
    base = vectors.filter(fine).select(
        F.col(id_col).cast("long").alias("id"), queries.alias("is_query"),
        F.transform(comp, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("v"))
    n_vec = -(-base.count() // block) or 1
    # rows are dealt by their content plus place, so that equal rows spread over blocks
    rows = stored(base.select("id", "is_query", "v", F.size("v").alias("d"),
                              F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n_vec)).alias("vb")), "vectors")
    asks = stored(rows.filter("is_query").select("id", "v", "d").distinct().withColumn("qn", F.xxhash64("v")), "queries")

    def search(queries: DataFrame, vectors: DataFrame) -> DataFrame:
        """Best rows of each block for the queries (id, qn, v, floor, d, vb) sent there."""
        meet = (vectors.select("vb", "d", F.lit(0).alias("kind"), "id", F.lit(None).cast("long").alias("qn"), "v", F.lit(None).cast("double").alias("floor"))
                .unionByName(queries.select("vb", "d", F.lit(1).alias("kind"), "id", "qn", "v", "floor")))
        return (meet.repartition("vb", "d").sortWithinPartitions("vb", "d", "kind").mapInArrow(
            _search_blocks(k), "query_id long, qn long, vec_id long, score long"))

    first = rows.filter("vb = 0")
    start = search(asks.withColumn("vb", F.lit(0).cast("long")).withColumn("floor", F.lit(None).cast("double")), first)
    start = stored(start, "first-block")
    floors = start.groupBy("query_id", "qn").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("floor"))
    ends = (rows.filter("vb > 0").select("vb", "d", F.posexplode("v").alias("dim", "x")).groupBy("vb", "d", "dim")
            .agg(F.min("x").alias("low"), F.max("x").alias("high")).groupBy("vb", "d")
            .agg(F.sort_array(F.collect_list(F.struct("dim", "low", "high"))).alias("ends")))       # a row a block
    reach = F.aggregate(F.zip_with("v", "ends", lambda q, e: F.greatest(q * e["low"], q * e["high"])), F.lit(0.0), lambda s, x: s + x)
    sent = (asks.join(floors.withColumnRenamed("query_id", "id"), ["id", "qn"], "left")
            .withColumn("vb", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(max(n_vec - 1, 1)).cast("long")))).join(ends, ["vb", "d"])
            .filter(F.col("floor").isNull() | (reach >= F.col("floor"))).select("id", "qn", "v", "d", "vb", "floor"))
    best = start.unionByName(search(sent, rows.filter("vb > 0"))) if n_vec > 1 else start
    w = Window.partitionBy("query_id", "qn").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search_blocks(k: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block, the block's vectors before its queries."""
        at, ids, parts, ready = None, [], [], None
        for b in batches:
            out: list[tuple[int, int, int, int]] = []
            for vb, d, kind, i, qn, v, floor in zip(*(b.column(c).to_pylist() for c in ("vb", "d", "kind", "id", "qn")),
                                                    _vectors(b.column("v")), b.column("floor").to_pylist()):
                if (vb, d) != at:
                    at, ids, parts, ready = (vb, d), [], [], None
                if kind == 0:
                    ids.append(i)
                    parts.append(v)
                elif ids:
                    if ready is None:
                        x = np.stack(parts)
                        ready = np.array(ids), x, np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
                        parts = []
                    found, scores = threshold_search(*ready, v, i, k, -np.inf if floor is None else floor)
                    out += [(i, qn, int(a), int(s)) for a, s in zip(found, scores)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((),) * 4)],
                                             names=["query_id", "qn", "vec_id", "score"])

    return fn


def _vectors(column: pa.Array) -> list[np.ndarray]:
    values, cuts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(cuts, cuts[1:])]


def topk_digest(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.coalesce(F.pmod("vec_id", F.lit(100)) == 0, F.lit(False)))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
