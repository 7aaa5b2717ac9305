"""Benchmark decontamination over a distributed positional inverted index (operator 9).

A window is ``window`` consecutive words of an item, an item of fewer words is
one window.  Document frequencies of all benchmark words are counted over the
whole corpus; every window's ``anchors`` rarest words are its test terms.  The
index stores the training postings (word, document, position) of test terms.
A posting at position p of a word that stands at offset o of an item puts the
item's start at p - o; per document and item the offset-adjusted lists are
intersected by grouping on that start, beginning with the rarest term, and an
alignment stays a candidate only if some window has all its test terms there.
Candidates are then compared word by word with the document's own words, which
makes phrase matches exact.  Proximity matches, where an item's rarest words
stand close together in any order, come from the same postings.

Words of the index are wider than the contract's (Unicode lower case), so
they can only add candidates; the comparison decides.  Corpus passes join the
exploded words to the benchmark's terms in blocks of ``term_block`` terms by
their hash, each broadcast, so a broadcast's size is bounded whatever the
benchmark's; all later joins are left to Spark.  Everything is DataFrame
functions.

Defined cases: null text has no words; an item without words has no window; a
null item_id's windows hit but it is not an item to count or list; repeated
items are one item; rows repeating a doc_id with another text stay apart;
equal rows get equal results; empty tables give empty results or documents
without hits; other columns are ignored, also where both tables have them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import ascii_lower, packed, row_key, stored, words

_BETWEEN_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _any_case_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BETWEEN_ANY), lambda w: w != "")


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.rk") == F.col(f"{b}.rk"))


def item_words(benchmark: DataFrame) -> DataFrame:
    """item, its words and its window length; one row per different item."""
    return (benchmark.select(F.col("item_id").alias("item"), words(ascii_lower(F.col("text"))).alias("words"))
            .filter(F.size("words") > 0).distinct()
            .withColumn("text_no", F.xxhash64("words")))


def find_matches(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, anchors: int = 2, near_terms: int = 3,
                 slop: int = 30, term_block: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(phrases, proximities).

    phrases: doc_id, rk, item, start, length, one row per place where a window of an item occurs;
    proximities: doc_id, rk, item, where the item's ``near_terms`` rarest words stand within 2 * ``slop`` words.
    """
    items = stored(item_words(benchmark), "items")
    at = items.select("item", "text_no", F.size("words").alias("n"), F.posexplode("words").alias("o", "w")).withColumn(
        "term", F.lower("w"))
    terms = stored(at.groupBy("term").agg(F.count(F.lit(1)).alias("n_bench")), "terms")
    blocks = max(1, -(-terms.count() // term_block))

    def in_block(table: DataFrame, b: int) -> DataFrame:
        return F.broadcast(table.filter(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b).select("term"))

    texts = docs.select("doc_id", row_key().alias("rk"), "text")
    distinct_words = texts.select(F.explode(F.array_distinct(F.transform(
        _any_case_words(F.col("text")), lambda w: F.lower(w)))).alias("term"))
    frequency = reduce(DataFrame.unionByName, [distinct_words.join(in_block(terms, b), "term") for b in range(blocks)])
    df = stored(frequency.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "df")

    # test terms: the rarest words of each window, with their first offset in the item from the window's start on
    placed = at.join(df, "term")              # a word that the corpus lacks rules its windows out
    windows = (placed.withColumn("s", F.explode(F.sequence(
                   F.greatest(F.lit(0), F.col("o") - (window - 1)),
                   F.least(F.col("o"), F.greatest(F.lit(0), F.col("n") - window)))))
               .groupBy("item", "text_no", "n", "s")
               .agg(F.count(F.lit(1)).alias("here"), F.collect_set(F.struct("df", "term")).alias("ts"),
                    F.collect_list(F.struct("o", "term")).alias("os"))
               .filter(F.col("here") == F.least(F.lit(window), F.col("n")))
               .withColumn("tests", F.slice(F.array_sort("ts"), 1, anchors).getField("term")))
    first = F.transform("tests", lambda t: F.array_min(F.transform(
        F.filter("os", lambda x: x["term"] == t), lambda x: x["o"])))
    windows = stored(windows.select("item", "text_no", "n", "s", "tests", F.array_sort(first).alias("offsets")), "windows")
    rare = (placed.groupBy("item", "text_no").agg(F.slice(F.array_sort(F.collect_set(F.struct("df", "term"))), 1, near_terms)
                                                  .getField("term").alias("near")))
    rare = stored(rare, "rare")
    test_terms = stored(windows.select(F.explode("tests").alias("term"))
                        .union(rare.select(F.explode("near"))).distinct(), "test-terms")

    # the positional index: postings of every test term
    places = texts.select("doc_id", "rk", F.posexplode(_any_case_words(F.col("text"))).alias("p", "w")).select(
        "doc_id", "rk", "p", F.lower("w").alias("term"))
    index = stored(reduce(DataFrame.unionByName, [places.join(in_block(test_terms, b), "term") for b in range(blocks)]),
                   "postings")

    # offset-adjusted lists, intersected: all test terms of a window at the same item start
    adjusted = (windows.select("item", "text_no", F.posexplode("tests").alias("t", "term"), "offsets").distinct()
                .select("text_no", "term").distinct()
                .join(at.select("text_no", "term", "o").distinct(), ["text_no", "term"]))
    starts = (index.join(adjusted, "term")
              .groupBy("doc_id", "rk", "text_no", (F.col("p") - F.col("o")).alias("start"))
              .agg(F.collect_set("o").alias("found")))
    offsets = windows.groupBy("text_no").agg(F.collect_set("offsets").alias("wanted"))
    fits = F.exists("wanted", lambda w: F.size(F.array_intersect(w, "found")) == F.size(w))
    single = F.exists("wanted", lambda w: F.size(w) == 1)
    least = windows.groupBy("text_no").agg(F.min(F.size("offsets")).alias("least"))
    candidates = (starts.join(least, "text_no").filter(F.size("found") >= F.col("least")).drop("least")
                  .join(offsets, "text_no").filter(fits).select("doc_id", "rk", "text_no", "start"))
    candidates = stored(candidates, "candidates")

    # exact comparison with the words of the documents that have candidates
    own = (texts.alias("d").join(candidates.select("doc_id", "rk").distinct().alias("c"), _same("d", "c"), "left_semi")
           .dropDuplicates(["doc_id", "rk"])
           .select("doc_id", "rk", words(ascii_lower(F.col("text"))).alias("d_words")))
    texts_of = items.select("text_no", "words").distinct()
    lo = F.greatest(F.lit(0), -F.col("start"))          # offsets of the item that fall inside the document
    hi = F.least(F.size("words"), F.size("d_words") - F.col("start")) - 1
    compared = (candidates.alias("c").join(own.alias("d"), _same("c", "d")).join(texts_of, "text_no")
                .select("c.doc_id", "c.rk", "text_no", "start", "words", "d_words",
                        lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
                .select("doc_id", "rk", "text_no", "start", "lo", F.size("words").alias("n"),
                        F.zip_with(F.slice("d_words", F.col("start") + F.col("lo") + 1, F.col("hi") - F.col("lo") + 1),
                                   F.slice("words", F.col("lo") + 1, F.col("hi") - F.col("lo") + 1),
                                   lambda a, b: F.when(a == b, "1").otherwise("0")).alias("eq")))
    # runs of equal words, as long as they go: '1' stretches of the comparison
    length = F.least(F.lit(window), F.col("n"))
    line = F.array_join("eq", "")
    runs = (compared.select("doc_id", "rk", "text_no", "start", "lo", length.alias("length"), line.alias("line"))
            .filter(F.length("line") >= F.col("length"))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.length("line") - F.col("length"))))
            .filter(F.col("line").substr(F.col("i") + 1, F.col("length")) == F.repeat(F.lit("1"), F.col("length"))))
    names = items.select("text_no", "item").distinct()
    phrases = (runs.select("doc_id", "rk", "text_no", (F.col("start") + F.col("lo") + F.col("i")).alias("start"), "length")
               .join(names, "text_no").select("doc_id", "rk", "item", "start", "length"))

    near = (index.join(rare.select("item", "text_no", F.size("near").alias("k"), F.explode("near").alias("term")), "term")
            .withColumn("zone", F.explode(F.array(F.floor(F.col("p") / slop), F.floor(F.col("p") / slop) - 1)))
            .groupBy("doc_id", "rk", "item", "text_no", "zone", "k").agg(F.collect_set("term").alias("ts"))
            .filter(F.size("ts") == F.col("k")).select("doc_id", "rk", "item").distinct())
    return phrases, near


def hit_words(phrases: DataFrame) -> DataFrame:
    """Words of each document inside any occurrence: the union of its intervals, by document."""
    w = (Window.partitionBy("doc_id", "rk").orderBy("start")
         .rowsBetween(Window.unboundedPreceding, -1))
    spans = phrases.groupBy("doc_id", "rk", "start").agg(F.max(F.col("start") + F.col("length")).alias("stop"))
    reached = F.greatest(F.col("start"), F.coalesce(F.max("stop").over(w), F.lit(0)))
    return (spans.withColumn("new", F.greatest(F.col("stop") - reached, F.lit(0)))
            .groupBy("doc_id", "rk").agg(F.sum("new").alias("n_hit")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """Rows of ``docs`` in which no window occurs, columns as they were."""
    phrases, _ = find_matches(docs, benchmark, **how)
    bad = phrases.select("doc_id", "rk").distinct()
    return packed(docs).alias("d").join(bad.alias("b"), _same("d", "b"), "left_anti").select("row.*")


def decontaminate_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    phrases, near = find_matches(docs, benchmark)
    phrases = stored(phrases, "phrases")
    found = (phrases.groupBy("doc_id", "rk")
             .agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    close = near.groupBy("doc_id", "rk").agg(F.count_distinct("item").alias("n_near"))
    per_doc = (hit_words(phrases).alias("h").join(found.alias("f"), _same("h", "f"), "left")
               .select("h.doc_id", "h.rk", "n_hit", "items"))
    all_docs = docs.select("doc_id", row_key().alias("rk"),
                           F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
                           .cast("long").alias("n_words"))
    none = F.expr("cast(array() as array<string>)")
    return (all_docs.alias("a").join(per_doc.alias("p"), _same("a", "p"), "left")
            .join(close.alias("n"), _same("a", "n"), "left")
            .select("a.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")))


#: Every window of every length that items have, looked up among the documents' own.
DECONTAMINATE_SQL = r"""
WITH lower_case AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b
), item AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark, lower_case
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[s + 1:s + least(10, len(w))] AS x
  FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS s FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents, lower_case
), n AS (SELECT DISTINCT n FROM win
), dwin AS (
  SELECT r, n, s, w[s + 1:s + n] AS x
  FROM (SELECT r, n, w, unnest(range(len(w) - n + 1)) AS s FROM doc, n WHERE len(w) >= n)
), hit AS (
  SELECT r, item_id, s, n FROM dwin JOIN win USING (n, x)
), per AS (
  SELECT r, count(DISTINCT p) AS n_hit, list_sort(list(DISTINCT item_id::VARCHAR) FILTER (item_id IS NOT NULL)) AS items
  FROM (SELECT r, item_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r
), term AS (
  SELECT DISTINCT item_id, w, lower(unnest(w)) AS term FROM item
), df AS (
  SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS x FROM doc) JOIN (SELECT DISTINCT term FROM term) ON lower(x) = term
  GROUP BY term
), rare AS (
  SELECT item_id, w, term, count(*) OVER (PARTITION BY item_id, w) AS k
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id, w ORDER BY df, term) AS rank FROM term JOIN df USING (term)) WHERE rank <= 3
), post AS (
  SELECT r, lower(w[p + 1]) AS term, p FROM (SELECT r, w, unnest(range(len(w))) AS p FROM doc)
), zoned AS (
  SELECT r, item_id, w, k, rare.term, unnest([p // 30, p // 30 - 1]) AS zone FROM post JOIN rare ON post.term = rare.term
), close AS (
  SELECT r, count(DISTINCT item_id) AS n_near
  FROM (SELECT r, item_id FROM zoned GROUP BY r, item_id, w, k, zone HAVING count(DISTINCT term) = k) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near
FROM doc LEFT JOIN per USING (r) LEFT JOIN close USING (r)
"""
