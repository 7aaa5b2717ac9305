"""Indexes of the vocabulary and searches over postings that use them.

``grams``     field, gram, term, df     2- and 3-character pieces of ``^term$``
``variants``  field, variant, term, df  the first PREFIX characters of each term with up to two left out

Both grow with the vocabulary, not with the documents.  The vocabulary is dealt
out first, in parts of TERMS_A_PART terms; each part makes its own pieces and is
written sorted by their key, so a lookup of a few keys reads a few pages of each.

*Wildcards and prefixes* ask for terms that hold all pieces of the pattern's
literal parts (an intersection by count) and check those against the pattern.
*Fuzzy terms*: two words within e edits meet in a form that each reaches by
leaving out at most e characters, and so do their beginnings of equal length,
so the variants of the beginning of the query's word, a few dozen, look up all
candidates; the edit distance of the whole words decides.  *Phrases* intersect
the postings' positions: an occurrence starts at position minus offset, and a
start that all offsets share is a phrase.  The rarest term comes first and the
others are read for its documents only.

No search here scans documents.  Scores are those of the clauses of the same
name (:mod:`.clauses`).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.analysis import DEFAULT_ANALYZERS, query_terms
from ..functions.scoring import bm25, idf, round_score, tf_norm
from .clauses import _wildcard_to_like, fuzzy_max_edits
from .postings import SearchTables

#: Marks of a term's beginning and end within grams; no analyser lets them into a term.
BEGIN, END = "\x02", "\x03"
SIZES = (2, 3)
#: Edits that the variants cover.
MOST_EDITS = 2
#: Characters of a term that the variants cover: a longer word has no more of them (22 at most).
PREFIX = 6
#: Terms whose pieces one task makes and sorts.
TERMS_A_PART = 1 << 16


@dataclass
class Dictionary:
    grams: DataFrame
    variants: DataFrame
    vocabulary: DataFrame       # field, term, df


def _left_out(words: Column) -> Column:
    """Each of the words with one character left out, at every place."""
    return F.flatten(F.transform(words, lambda w: F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: i <= F.length(w)),
        lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))))


def build_dictionary(term_stats: DataFrame) -> Dictionary:
    vocabulary = term_stats.select("field", "term", "df")
    marked = F.concat(F.lit(BEGIN), F.col("term"), F.lit(END))

    def pieces(k: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - (k - 1), F.lit(1))), lambda i: F.substring(marked, i, F.lit(k)))

    grams = F.array_distinct(F.flatten(F.array(*map(pieces, SIZES))))
    beginning = F.array(F.substring("term", 1, PREFIX))
    one = _left_out(beginning)
    variants = F.array_distinct(F.concat(beginning, one, _left_out(F.array_distinct(one))))
    return Dictionary(vocabulary.select("field", F.explode(grams).alias("gram"), "term", "df"),
                      vocabulary.select("field", F.explode(variants).alias("variant"), "term", "df"), vocabulary)


def write_dictionary(d: Dictionary, path: str, mode: str = "overwrite") -> Dictionary:
    spark = d.vocabulary.sparkSession
    d.vocabulary.write.mode(mode).partitionBy("field").parquet(f"{path}/vocabulary")
    vocabulary = spark.read.schema(d.vocabulary.schema).parquet(f"{path}/vocabulary")
    parts = -(-max(vocabulary.count(), 1) // TERMS_A_PART)
    dealt = build_dictionary(vocabulary.repartition(parts, "field", "term"))
    for name, key in (("grams", "gram"), ("variants", "variant")):
        (getattr(dealt, name).sortWithinPartitions("field", key, "term")
         .write.mode(mode).partitionBy("field").parquet(f"{path}/{name}"))
    return read_dictionary(spark, path)


def read_dictionary(spark, path: str) -> Dictionary:
    return Dictionary(*(spark.read.parquet(f"{path}/{n}") for n in ("grams", "variants", "vocabulary")))


# expansions: term and df

def _grams(part: str) -> list[str]:
    k = max((k for k in SIZES if k <= len(part)), default=0)        # long pieces imply the short ones in them
    return [part[j:j + k] for j in range(len(part) - k + 1) if k]


def pattern_grams(pattern: str) -> list[str]:
    """Pieces that every term matching the wildcard pattern holds (``*`` any run, ``?`` one character)."""
    parts = (BEGIN + pattern + END).replace("?", "*").split("*")
    return list(dict.fromkeys(g for p in parts for g in _grams(p)))


def _holding(d: Dictionary, field: str, grams: list[str]) -> DataFrame:
    """Terms that hold all the grams; without any, the vocabulary is read."""
    if not grams:
        return d.vocabulary.filter(F.col("field") == field).select("term", "df")
    return (d.grams.filter((F.col("field") == field) & F.col("gram").isin(grams)).groupBy("term", "df")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams)).select("term", "df"))


def wildcard_terms(d: Dictionary, field: str, pattern: str) -> DataFrame:
    """Terms of ``field`` that match the pattern; one without two characters in a row reads the vocabulary."""
    return _holding(d, field, pattern_grams(pattern)).filter(F.col("term").like(_wildcard_to_like(pattern)))


def prefix_terms(d: Dictionary, field: str, prefix: str) -> DataFrame:
    return _holding(d, field, _grams(BEGIN + prefix)).filter(F.col("term").startswith(prefix))


def deletions(word: str, edits: int) -> list[str]:
    """The word and all that is left of it without up to ``edits`` characters."""
    return sorted({"".join(c for i, c in enumerate(word) if i not in out)
                   for k in range(min(edits, len(word)) + 1) for out in combinations(range(len(word)), k)})


def fuzzy_terms(d: Dictionary, field: str, word: str, edits: int, *, prefix_length: int = 0,
                max_expansions: int | None = None) -> DataFrame:
    """Terms of ``field`` within ``edits`` of ``word`` that share its first ``prefix_length`` characters."""
    if edits > MOST_EDITS:
        raise ValueError(f"the variants cover {MOST_EDITS} edits")
    found = (d.variants.filter((F.col("field") == field) & F.col("variant").isin(deletions(word[:PREFIX], edits)))
             .select("term", "df").distinct().filter(F.levenshtein(F.col("term"), F.lit(word), edits) >= 0))
    if prefix_length:
        found = found.filter(F.substring("term", 1, prefix_length) == word[:prefix_length])
    return found if max_expansions is None else found.orderBy(F.desc("df"), "term").limit(max_expansions)


# searches: _id and _score

def _stats(tables: SearchTables, field: str) -> tuple[Column, Column]:
    return tables.scalar("n_docs", field), tables.scalar("avgdl", field)


def _postings(tables: SearchTables, field: str) -> DataFrame:
    return tables.postings.filter(F.col("field") == F.lit(field)).drop("field")


def wildcard_stored(tables: SearchTables, d: Dictionary, field: str, pattern: str, boost: float = 1.0) -> DataFrame:
    """Documents with a term that matches the pattern; the score is the boost."""
    return (_postings(tables, field).join(wildcard_terms(d, field, pattern), "term", "left_semi").select("_id").distinct()
            .withColumn("_score", round_score(F.lit(float(boost)))))


def fuzzy_stored(tables: SearchTables, d: Dictionary, field: str, query: str, *, fuzziness="AUTO", prefix_length: int = 0,
                 max_expansions: int | None = None, operator: str = "or", analyzer: str | None = None, boost: float = 1.0) -> DataFrame:
    """``Match`` with fuzziness: every expansion of every query term is scored like a term, with its own df."""
    words = query_terms(query, analyzer)
    if not words:
        return _postings(tables, field).limit(0).select("_id", F.lit(0.0).alias("_score"))
    n, avgdl = _stats(tables, field)
    found = None
    for i, w in enumerate(words):
        more = fuzzy_terms(d, field, w, fuzzy_max_edits(w, fuzziness), prefix_length=prefix_length, max_expansions=max_expansions)
        more = more.withColumn("word", F.lit(i))
        found = more if found is None else found.unionByName(more)
    scored = (_postings(tables, field).select("term", "_id", "tf", "dl").join(found, "term").groupBy("_id")
              .agg(F.sum(bm25(F.col("tf"), F.col("dl"), n, F.col("df"), avgdl)).alias("raw"), F.count_distinct("word").alias("words")))
    if operator.lower() == "and":
        scored = scored.filter(F.col("words") == len(words))
    return scored.select("_id", round_score(F.col("raw") * boost).alias("_score"))


def _starts(tables: SearchTables, field: str, slots: list[DataFrame | str]) -> DataFrame:
    """_id, dl and start of every place where a term of each slot follows the one before.

    A slot is one term or a table of alternative terms.
    """
    post = _postings(tables, field).select("term", "_id", "dl", "positions")
    fixed = sorted({s for s in slots if isinstance(s, str)})
    known = {r["term"]: r["df"] for r in tables.term_stats.filter((F.col("field") == field) & F.col("term").isin(fixed))
             .select("term", "df").collect()}                        # one row a word of the phrase
    if len(known) < len(fixed):
        return post.limit(0).select("_id", "dl", F.lit(0).alias("start"))
    if fixed:
        rarest = min(fixed, key=lambda t: (known[t], t))
        holders = post.filter(F.col("term") == rarest).select("_id")
    offsets: dict[str, list[int]] = {}
    for i, s in enumerate(slots):
        if isinstance(s, str):
            offsets.setdefault(s, []).append(i)
    rows = []
    if fixed:
        own = post.filter(F.col("term") == rarest)
        others = [t for t in fixed if t != rarest]
        if others:
            own = own.unionByName(post.filter(F.col("term").isin(others)).join(holders, "_id", "left_semi"))
        offset = F.coalesce(*[F.when(F.col("term") == t, F.array(*map(F.lit, at))) for t, at in offsets.items()])
        rows.append(own.select("_id", "dl", "positions", F.explode(offset).alias("offset")))
    for i, s in enumerate(slots):
        if not isinstance(s, str):
            of = post.join(s.select("term"), "term", "left_semi")
            of = of.join(holders, "_id", "left_semi") if fixed else of
            rows.append(of.select("_id", "dl", "positions", F.lit(i).alias("offset")))
    places = rows[0]
    for r in rows[1:]:
        places = places.unionByName(r)
    return (places.select("_id", "dl", "offset", F.explode("positions").alias("position"))
            .groupBy("_id", "dl", (F.col("position") - F.col("offset")).alias("start")).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") == len(slots)).select("_id", "dl", "start"))


def phrase_stored(tables: SearchTables, field: str, query: str, *, analyzer: str | None = None, boost: float = 1.0) -> DataFrame:
    """``MatchPhrase`` from stored positions: the phrase's frequency is that of occurrences that don't overlap."""
    words = DEFAULT_ANALYZERS.get(analyzer).terms(query)
    if not words:
        return _postings(tables, field).limit(0).select("_id", F.lit(0.0).alias("_score"))
    n, avgdl = _stats(tables, field)
    size = len(words)
    # a document's starts in order, each taken if the last one taken has ended
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("free"))
    taken = F.aggregate(F.sort_array(F.collect_list("start")), nothing, lambda s, x: F.when(
        x >= s["free"], F.struct((s["n"] + 1).alias("n"), (x + size).alias("free"))).otherwise(s))["n"]
    weight = None
    for w in dict.fromkeys(words):
        part = idf(n, tables.scalar("df", field, w))
        weight = part if weight is None else weight + part
    found = _starts(tables, field, words).groupBy("_id", "dl").agg(taken.alias("freq"))
    return found.select("_id", round_score(weight * tf_norm(F.col("freq"), F.col("dl"), avgdl) * boost).alias("_score"))


def phrase_prefix_stored(tables: SearchTables, d: Dictionary, field: str, query: str, *, analyzer: str | None = None,
                         boost: float = 1.0) -> DataFrame:
    """``MatchPhrasePrefix``: the last word is a prefix; the score is the boost."""
    words = DEFAULT_ANALYZERS.get(analyzer).terms(query)
    if not words:
        return _postings(tables, field).limit(0).select("_id", F.lit(0.0).alias("_score"))
    slots = [*words[:-1], prefix_terms(d, field, words[-1])]
    return _starts(tables, field, slots).select("_id").distinct().withColumn("_score", F.lit(float(boost)))
