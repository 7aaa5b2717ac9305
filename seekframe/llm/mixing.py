"""Mixing sources to target weights by hierarchical budgeting (operator 8).

The tree's levels are columns (domain, language, source).  A token budget runs
from the root to the leaves.  At each node the children share the node's
budget by their weights; a child can take no more than its capacity, the
tokens below it times ``max_epochs``.  What a child cannot take is shared by
its siblings, again by weight, and only what all siblings together cannot take
would go to the parent's level; as a parent never gets more than its subtree's
capacity, shortages are settled among siblings first, then among the parent's
siblings, up to the root.  The shares are found in closed form: with children
sorted by capacity over weight, those before the first unsaturated one get
their capacity and the rest weight times one common level.

A leaf takes whole epochs of its documents as long as its budget lasts, and
the token-prefix of the next epoch's seeded order that still fits.  Prefix sums
run over 4,096 hash buckets per leaf, added up before any shuffle; only the one
bucket in which the budget ends is ordered document by document, so a leaf with
a third of all rows is no single task.  Everything is DataFrame functions.

Defined cases: nulls in a level's column count as ''; null texts have no
tokens; a leaf without tokens has no budget, but its documents cost nothing and
are taken once; children of weight 0 or less get nothing and give their share
to siblings; rows equal in doc_id and text share one place in the order and are
taken or left together, each as often; an empty table stays empty; other
columns stay as they are.  A budget beyond all capacity is cut to it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import packed, row_key, stored

TOKEN = r"[^\x20\x09-\x0D]+"
HEX = 3     # hex digits of the order's hash that make a bucket


@dataclass(frozen=True)
class Mix:
    """Levels from the root down as (name, Column), weights by level and value (1 where not named), and the budget
    as a share of all tokens."""

    levels: tuple[tuple[str, Column], ...]
    weights: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    budget: float = 1.0
    max_epochs: int = 2
    seed: int = 17

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.levels]


def _weight(mix: Mix, level: str) -> Column:
    w = F.lit(1.0)
    for value, x in mix.weights.get(level, {}).items():
        w = F.when(F.col(level) == value, F.lit(float(x))).otherwise(w)
    return F.greatest(w, F.lit(0.0))


def leaf_budgets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per leaf: level names, tokens, budget (tokens to take).

    ``sizes`` holds the level names and ``tokens`` of every leaf.
    """
    names = mix.names
    root = sizes.agg(F.sum("tokens").alias("t")).select(
        F.coalesce(F.least(F.col("t") * mix.budget, F.col("t").cast("double") * mix.max_epochs), F.lit(0.0)).alias("budget"))
    parent = root
    for depth, name in enumerate(names):
        path, above = names[:depth + 1], names[:depth]
        weight = _weight(mix, name)
        nodes = (sizes.groupBy(*path).agg(F.sum("tokens").alias("tokens"))
                 .withColumn("w", weight)
                 .withColumn("cap", F.when(F.col("w") > 0, F.col("tokens").cast("double") * mix.max_epochs).otherwise(0.0)))
        nodes = nodes.join(parent, above) if above else nodes.withColumn("budget", parent.scalar())
        ratio = F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(0.0)
        siblings = Window.partitionBy(*above)
        order = siblings.orderBy("ratio", name)
        nodes = (nodes.withColumn("ratio", ratio)
                 .withColumn("below", F.coalesce(F.sum("cap").over(
                     order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
                 .withColumn("open", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
                 .withColumn("level", F.when(F.col("open") > 0, (F.col("budget") - F.col("below")) / F.col("open")))
                 .withColumn("free", F.col("ratio") > F.col("level"))
                 .withColumn("level", F.max(F.when(F.col("free"), F.col("level"))).over(siblings)))
        parent = nodes.select(*path, "tokens", F.when(F.col("level").isNull(), F.col("cap")).otherwise(
            F.least(F.col("cap"), F.greatest(F.col("w") * F.col("level"), F.lit(0.0)))).alias("budget"))
        if depth + 1 < len(names):
            parent = parent.drop("tokens")
    return parent


def mix_picks(docs: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, rk, level names, n_tokens and epoch (from 0): one row for each time a document is taken."""
    names = mix.names
    level = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in mix.levels]
    sized = stored(docs.select("doc_id", row_key().alias("rk"), *level,
                               F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TOKEN)).cast("long").alias("n_tokens")),
                   "sized")
    sizes = stored(sized.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    leaves = stored(leaf_budgets(sizes, mix)
                    .withColumn("full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long"))
                    .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")), "budgets")
    # the order of the epoch that is not taken whole
    placed = sized.join(leaves.select(*names, "full", "rest"), names).withColumn(
        "h", F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    placed = placed.withColumn("bucket", F.substring("h", 1, HEX))
    buckets = placed.groupBy(*names, "bucket").agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("rest"))
    upto = F.sum("t").over(Window.partitionBy(*names).orderBy("bucket"))
    ends = stored(buckets.withColumn("upto", upto).filter(F.col("upto") > F.col("rest"))
                  .groupBy(*names).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before"))).alias("e"))
                  .select(*names, F.col("e.bucket").alias("end"), F.col("e.before").alias("before")), "ends")
    at = placed.join(ends, names, "left")
    whole = at.filter("full > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)))
    part = at.filter("end IS NULL OR bucket < end").withColumn("epoch", F.col("full"))
    run = F.sum("n_tokens").over(Window.partitionBy(*names).orderBy("h", "doc_id", "rk"))
    last = (at.filter("bucket = end").withColumn("run", F.col("before") + run)
            .filter("run <= rest").withColumn("epoch", F.col("full")))
    cols = ["doc_id", "rk", *names, "n_tokens", "epoch"]
    # a leaf whose budget ends with an epoch has taken all it needs, but for documents that cost nothing in epoch 0
    part = part.unionByName(last, allowMissingColumns=True).filter("rest > 0 OR full = 0 OR n_tokens > 0")
    return whole.select(*cols).unionByName(part.select(*cols))


def mix_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """Rows of ``docs``, each as often as it is taken, columns as they were."""
    picks = (mix_picks(docs, mix).select("doc_id", "rk", "epoch").distinct()
             .groupBy("doc_id", "rk").agg(F.count(F.lit(1)).alias("times")))
    taken = packed(docs).alias("d").join(picks.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
                                         & (F.col("d.rk") == F.col("p.rk")))
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")


#: Production mix: sources in three domains by the last character of their name; languages by fixed weights; sources alike.
DOCUMENT_MIX_WEIGHTS = {"lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}


def document_mix() -> Mix:
    source = F.coalesce("source", F.lit(""))
    domain = F.concat(F.lit("domain"), (F.ascii(F.right(source, F.lit(1))) % 3).cast("string"))
    return Mix((("domain", domain), ("lang", F.col("lang")), ("source", F.col("source"))), DOCUMENT_MIX_WEIGHTS)


def mixing_digest(docs: DataFrame) -> DataFrame:
    return mix_picks(docs, document_mix()).drop("rk")


def _level_sql(name: str, path: list[str], above: list[str], weight: str) -> str:
    by = f"PARTITION BY {', '.join(above)} " if above else ""
    join = f"JOIN {'p' + str(len(above))} USING ({', '.join(above)})" if above else ", p0"
    me = f"p{len(path)}"
    return f"""
, n{len(path)} AS (
  SELECT *, CASE WHEN w > 0 THEN cap / w ELSE 0 END AS ratio
  FROM (SELECT *, CASE WHEN w > 0 THEN tokens * 2.0::DOUBLE ELSE 0 END AS cap
        FROM (SELECT {', '.join(path)}, sum(tokens) AS tokens, {weight}::DOUBLE AS w FROM leaf GROUP BY ALL)) {join}
), l{len(path)} AS (
  SELECT *, (budget - coalesce(sum(cap) OVER ({by}ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER ({by}ORDER BY ratio, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n{len(path)}
), {me} AS (
  SELECT {', '.join(path)}, {'tokens, ' if name == 'source' else ''}
    CASE WHEN lv IS NULL THEN cap ELSE least(cap, greatest(w * lv, 0)) END AS budget
  FROM (SELECT *, max(CASE WHEN ratio > level THEN level END) OVER ({by}) AS lv FROM l{len(path)})
)"""


def mixing_sql() -> str:
    lang = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in DOCUMENT_MIX_WEIGHTS["lang"].items()) + " ELSE 1 END"
    names = ["domain", "lang", "source"]
    levels = "".join(_level_sql(n, names[:i + 1], names[:i], w) for i, (n, w) in enumerate(zip(names, ("1", lang, "1"))))
    return rf"""
WITH d AS (
  SELECT doc_id, 'domain' || (ascii(right(coalesce(source, ''), 1)) % 3) AS domain, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '{TOKEN}')) AS n_tokens
  FROM documents
), leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY ALL
), p0 AS (
  SELECT sum(tokens)::DOUBLE AS budget FROM leaf
){levels}
, b AS (
  SELECT *, CASE WHEN tokens > 0 THEN floor(budget / tokens)::BIGINT ELSE 0 END AS n_full FROM p3
), r AS (
  SELECT d.*, n_full, budget - n_full * tokens AS rest,
    sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || n_full || ':' || coalesce(doc_id::VARCHAR, '')), doc_id) AS run
  FROM d JOIN b USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, unnest(range(n_full))::BIGINT AS epoch FROM r
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens, n_full FROM r WHERE run <= rest AND (rest > 0 OR n_full = 0 OR n_tokens > 0)
"""
