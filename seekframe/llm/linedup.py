"""Line deduplication by prefix doubling over line-ID sequences (operator 4).

A document is the sequence of its lines that are not blank (blank lines stay
where they are).  Suffixes of all sequences are ranked by their first line, and
prefix doubling ranks them by their first 2, 4, ... lines: the pair of ranks at
i and i + k orders and names the suffix's first 2k lines.  Ranks keep the order
of a suffix array (pairs are range-partitioned, sorted and numbered in order),
and the suffixes that share a rank at depth d are its longest-common-prefix
interval of at least d lines.  Suffixes whose prefix stands only once leave the
race after each round, so the first round already drops all lines that never
repeat, the bulk of a corpus.

In an interval at depth d all but the first copy (by doc_id, then place) are
later copies.  They are deleted if d is ``min_lines`` (a power of two), or if
d is smaller and the window holds ``min_words`` words or more.  Lengths between
d and 2d are named by two overlapping ranks of depth d, so no repeated run that
has ``min_words`` words is too short or of the wrong length.  A run of more than
``min_lines`` lines is the union of such windows: neighbouring lines belong to
one run where a deleted window holds both (``joined`` of the second with the
first), so two runs that only touch stay two.  Everything is DataFrame
functions.  No interval is ever gathered: first copies come from a partial
minimum, and lines are told apart from them by place, which no key makes hot.

Defined cases: null text stays null and has no lines; texts are compared line
by line without outer spaces; rows equal in doc_id and text count as one
document and come back equally cut, rows that share only the doc_id are
different documents; null doc_ids come first; an empty table stays empty;
other columns stay as they are.  A document may become empty; it is not
dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import packed, row_key, stored

_PLACE = ["doc_id", "rk", "i"]


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, rk, i (number among lines that are not blank), line (number among all), words, and two hashes."""
    kept = F.filter(F.transform(F.split("text", "\n"), lambda x, n: F.struct(n.alias("line"), _trimmed(x).alias("t"))),
                    lambda x: x["t"] != "")
    return (docs.select("doc_id", row_key().alias("rk"), F.posexplode(kept).alias("i", "x"))
            .select("doc_id", "rk", "i", F.col("x.line").alias("line"),
                    F.regexp_count("x.t", F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
                    F.xxhash64("x.t").alias("a"), F.xxhash64(F.lit(1), F.col("x.t")).alias("b")))


def _ranked(named: DataFrame, pair: list[str], name: str) -> DataFrame:
    """Places whose pair stands at least twice, with the pair's rank ``r`` in sort order."""
    pairs = named.groupBy(*pair).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    order = stored(pairs.repartitionByRange(*pair).sortWithinPartitions(*pair)
                   .withColumn("r", F.monotonically_increasing_id()), f"{name}-ranks")
    return stored(named.join(order, pair).drop(*pair), name)


def _later(at: DataFrame, name: list[str]) -> DataFrame:
    """The places of ``at`` without the first of each name."""
    first = at.groupBy(*name).agg(F.min(F.struct(*_PLACE)).alias("f")).select("f.*")
    return at.alias("x").join(first.alias("f"), F.col("x.doc_id").eqNullSafe(F.col("f.doc_id"))
                              & (F.col("x.rk") == F.col("f.rk")) & (F.col("x.i") == F.col("f.i")), "left_anti")


def _ahead(at: DataFrame, by: int, *columns: Column) -> DataFrame:
    """``at`` joined with its ranks (``r1``, and ``r2`` that many lines further on)."""
    ahead = at.select(F.col("doc_id").alias("d2"), F.col("rk").alias("rk2"), (F.col("i") - by).alias("i2"),
                      *[F.col(c).alias(f"{c}2") for c in at.columns if c not in _PLACE])
    return (at.join(ahead, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("rk") == F.col("rk2"))
                    & (F.col("i") == F.col("i2")))
            .select(*_PLACE, *columns, F.col("r").alias("r1"), "r2"))


def _covered(copies: DataFrame, depth: int) -> DataFrame:
    return (copies.select("doc_id", "rk", F.col("i").alias("first"), F.explode(F.sequence("i", F.col("i") + (depth - 1))).alias("i"))
            .select(*_PLACE, (F.col("i") > F.col("first")).alias("joined")))


def repeated_lines(docs: DataFrame, *, min_lines: int = 4, min_words: int = 50) -> DataFrame:
    """doc_id, rk, i, line and joined (to the line before) of every line that a later copy of a repeated run covers."""
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    lines = stored(_lines(docs), "lines")
    # places are unique: rows equal in doc_id and text are one document
    at = _ranked(lines, ["a", "b"], "depth-1").dropDuplicates(_PLACE)
    at = at.withColumn("counts", F.array("words"))              # words by line, less than min_lines of them
    depth, later = 1, []
    while True:
        at = stored(at, f"suffixes-{depth}")
        copies = _later(at, ["r"])
        if depth < min_lines:
            copies = copies.filter(F.col("words") >= min_words)
        later.append(_covered(copies, depth))
        if depth >= min_lines:
            break
        for length in range(depth + 1, min(2 * depth, min_lines)):
            head = F.aggregate(F.slice("counts", 1, length - depth), F.lit(0), lambda n, c: n + c)
            windows = _ahead(at, length - depth, (head + F.col("words2")).alias("words")).filter(F.col("words") >= min_words)
            later.append(_covered(_later(stored(windows, f"windows-{length}"), ["r1", "r2"]), length))
        pairs = _ahead(at, depth, (F.col("words") + F.col("words2")).alias("words"), F.concat("counts", "counts2").alias("counts"))
        depth *= 2
        at = _ranked(stored(pairs, f"pairs-{depth}"), ["r1", "r2"], f"depth-{depth}")
    gone = later[0]
    for x in later[1:]:
        gone = gone.unionByName(x)
    # each place once, with the line's number in its text
    once = gone.groupBy(*_PLACE).agg(F.bool_or("joined").alias("joined"))
    places = lines.select(*_PLACE, "line").distinct()
    return (places.alias("l").join(stored(once, "gone").alias("g"), F.col("l.doc_id").eqNullSafe(F.col("g.doc_id"))
                                   & (F.col("l.rk") == F.col("g.rk")) & (F.col("l.i") == F.col("g.i")))
            .select("l.*", "g.joined"))


def deduplicate_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with later copies deleted from ``text``, and ``n_lines``, ``n_deleted`` and ``n_runs``."""
    gone = (repeated_lines(docs, **how).groupBy("doc_id", "rk")
            .agg(F.collect_list("line").alias("gone"), F.count_if(~F.col("joined")).alias("runs")))
    # exploding one array keeps the split from being repeated for every line
    parts = F.explode(F.array(F.when(F.col("gone").isNotNull(), F.split("text", "\n"))))
    joined = (packed(docs).alias("d").join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id"))
                                           & (F.col("d.rk") == F.col("g.rk")), "left")
              .select("row", "text", "runs", "gone", parts.alias("parts")))
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone")
    cut = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda n: F.element_at("parts", n + 1)), "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(
        F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1)
    return joined.select(
        *[F.col(f"row.`{c}`") if c != "text" else cut.alias("text") for c in docs.columns],
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_deleted"),
        F.coalesce("runs", F.lit(0)).cast("long").alias("n_runs"))


def linedup_digest(docs: DataFrame) -> DataFrame:
    return deduplicate_lines(docs.select("doc_id", "text"))


LINEDUP_SQL = r"""
WITH l AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS i, line, t,
         len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, u.line, regexp_replace(u.x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t
        FROM (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, n: {'x': x, 'line': n - 1})) AS u FROM documents))
  WHERE t <> ''
), w AS (
  SELECT doc_id, i, 1 AS d, t AS run, words FROM l
  UNION ALL
  SELECT a.doc_id, a.i, 2, a.t || chr(10) || b.t, a.words + b.words FROM l a JOIN l b ON b.doc_id = a.doc_id AND b.i = a.i + 1
  UNION ALL
  SELECT a.doc_id, a.i, 3, a.t || chr(10) || b.t || chr(10) || c.t, a.words + b.words + c.words
  FROM l a JOIN l b ON b.doc_id = a.doc_id AND b.i = a.i + 1 JOIN l c ON c.doc_id = a.doc_id AND c.i = a.i + 2
  UNION ALL
  SELECT a.doc_id, a.i, 4, a.t || chr(10) || b.t || chr(10) || c.t || chr(10) || e.t, a.words + b.words + c.words + e.words
  FROM l a JOIN l b ON b.doc_id = a.doc_id AND b.i = a.i + 1 JOIN l c ON c.doc_id = a.doc_id AND c.i = a.i + 2
  JOIN l e ON e.doc_id = a.doc_id AND e.i = a.i + 3
), n AS (
  SELECT *, row_number() OVER (PARTITION BY d, run ORDER BY doc_id, i) AS copy FROM w
), gone AS (
  SELECT doc_id, i, bool_or(joined) AS joined
  FROM (SELECT doc_id, unnest(range(i, i + d)) AS i, unnest(list_transform(range(d), lambda k: k > 0)) AS joined
        FROM n WHERE copy > 1 AND (d = 4 OR words >= 50)) GROUP BY doc_id, i
), per AS (
  SELECT doc_id, count(*) AS n_deleted, count(*) FILTER (NOT joined) AS n_runs, list(line) AS lines
  FROM gone JOIN l USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id,
       CASE WHEN lines IS NULL THEN text ELSE array_to_string(list_transform(list_filter(list_transform(string_split(text, chr(10)),
         lambda x, n: {'x': x, 'n': n - 1}), lambda s: NOT list_contains(lines, s.n)), lambda s: s.x), chr(10)) END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END::BIGINT AS n_lines,
       coalesce(n_deleted, 0)::BIGINT AS n_deleted, coalesce(n_runs, 0)::BIGINT AS n_runs
FROM documents LEFT JOIN per USING (doc_id)
"""
