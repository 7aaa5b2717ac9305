"""Toxicity: cumulative-link ordinal regression on sparse text features (operator 7).

Severity grades are 0 (clean), 1, 2 and 3.  Labels only say whether a text is
toxic, so the grades of labelled toxic texts come from the texts themselves,
grade 1, 2 or 3 by the thirds of their evidence (log counts of toxic features, summed), clean
ones are grade 0.  One weight vector is shared by all thresholds,
P(grade <= g) = sigmoid(theta_g - w.x), theta_0 <= theta_1 <= theta_2, fitted by
full-batch gradient steps; the score is the expected grade.

Features: words and four-letter word beginnings, counted in a bounded sample of
labelled rows (``sample`` of each label at most, chosen by a hash of the id).
A feature joins the vocabulary if its smoothed log odds reach ``min_odds`` and
its log-likelihood ratio is beyond what chance gives among so many features,
counted once by texts and once by different words before it, so that copies
of one toxic text don't turn its rare words into signs of toxicity.  All that
pass enter the fit, which works on the features present in each text, so the
model is bounded by the sample.  The values of ``strata`` (languages, few), a key
for sampling alone, give equal shares of the sample or all that they have, so
that a language with few toxic texts among many others is learnt from them.

Defined cases: a text without any feature of the vocabulary, null and empty
texts among them, has severity 0; equal texts get
equal grades, each row is scored by itself; where a labelled id stands beside
several texts, the one with the smallest MD5 teaches; an empty table gives an
empty result; without toxic labels nothing is toxic; labels that are null, other
than 0 and 1, or contradict each other for one document do not teach; extra
columns of the input are kept; ``severity`` and ``grade`` replace columns of
these names where scores are asked for.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import packed, stored, taught_text

_WORDS = re.compile(r"[^\W\d_]+")
GRADES = 4
STEM = 4


def features(text: str | None) -> dict[str, int]:
    """Counts of words ('=word') and word beginnings ('stem')."""
    out: dict[str, int] = {}
    for w in _WORDS.findall((text or "").lower()):
        k = "=" + w
        out[k] = out.get(k, 0) + 1
    stems: dict[str, int] = {}
    for k, c in out.items():
        if len(k) > STEM + 1:
            s = k[1:STEM + 1]
            stems[s] = stems.get(s, 0) + c
    out.update(stems)
    return out


@dataclass(frozen=True)
class ToxicityModel:
    vocabulary: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray       # GRADES - 1, ascending

    def values(self, text: str | None) -> tuple[list[int], list[float]]:
        v = self.vocabulary
        idx, val = [], []
        if v:
            seen: dict[int, int] = {}
            stems_get = v.get
            for w in _WORDS.findall((text or "").lower()):
                i = stems_get("=" + w)
                if i is not None:
                    seen[i] = seen.get(i, 0) + 1
                if len(w) > STEM and (i := stems_get(w[:STEM])) is not None:
                    seen[i] = seen.get(i, 0) + 1
            for i, c in seen.items():
                idx.append(i)
                val.append(float(np.log1p(c)))
        return idx, val

    def expected(self, text: str | None) -> float:
        idx, val = self.values(text)
        if not idx:                                  # nothing toxic about it
            return 0.0
        z = float(self.weights[idx] @ np.array(val))
        return float(np.sum(1 - _sigmoid(self.thresholds - z)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Entries:
    """The entries of a sparse matrix that are not zero."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    @classmethod
    def of(cls, x: np.ndarray) -> Entries:
        r, c = np.nonzero(x)
        return cls(r, c, x[r, c].astype(float), x.shape)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.shape[0])

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * g[self.row], self.shape[1])


def fit_ordinal(x: Entries | np.ndarray, y: np.ndarray, *, steps: int = 400, rate: float = 0.05, l2: float = 1e-4,
                positive: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the cumulative-link model, by Adam on the whole matrix.

    The thresholds are theta_0 and positive gaps, so that they stay in order.  With ``positive`` weights stay at
    zero or above: every feature was chosen as a sign of toxicity, so more of them never lower a grade.
    """
    x = x if isinstance(x, Entries) else Entries.of(x)
    n, f = x.shape
    p = np.zeros(f + GRADES - 1)
    p[f] = 1.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    # each class weighs the same in sum, so rare grades are learnt
    share = np.array([max((y == g).sum(), 1) for g in range(GRADES)], float)
    row = (1 / share)[y] / GRADES
    for t in range(1, steps + 1):
        w, theta = p[:f], _theta(p[f:])
        z = x.times(w)
        c = _sigmoid(np.concatenate([np.full((n, 1), -40.0), theta[None, :] - z[:, None], np.full((n, 1), 40.0)], 1))
        lo, hi = c[np.arange(n), y], c[np.arange(n), y + 1]
        prob = np.maximum(hi - lo, 1e-9)
        dhi = np.where(y < GRADES - 1, hi * (1 - hi), 0) / prob
        dlo = np.where(y > 0, lo * (1 - lo), 0) / prob
        gz = row * (dhi - dlo)                                   # of -log prob by z
        gt = np.zeros(GRADES - 1)
        for g in range(GRADES - 1):
            gt[g] = -(row * dhi)[y == g].sum() + (row * dlo)[y == g + 1].sum()
        grad = np.concatenate([x.back(gz) + l2 * w, _theta_back(p[f:], gt)])
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        if positive:
            p[:f] = np.maximum(p[:f], 0)
    return p[:f], _theta(p[f:])


def _theta(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([raw[:1], np.exp(np.clip(raw[1:], -6, 6))]))


def _theta_back(raw: np.ndarray, gt: np.ndarray) -> np.ndarray:
    rest = np.cumsum(gt[::-1])[::-1]
    return np.concatenate([rest[:1], rest[1:] * np.exp(np.clip(raw[1:], -6, 6))])


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", teaches: Column | None = None,
                 min_odds: float = 3.0, sample: int = 10_000, strata: str | None = "lang") -> ToxicityModel:
    """Fit on at most ``sample`` labelled rows of each label for which ``teaches`` (over doc_id) holds.

    ``strata`` names a column of ``docs`` with few values that share the sample (None, or a name that ``docs`` lacks: one share).
    """
    nothing = ToxicityModel({}, np.zeros(0), np.array([1.0, 2.0, 3.0]) * 40)
    lab = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (F.lit(True) if teaches is None else teaches))
           .groupBy("doc_id").agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("y2"))
           .filter("y = y2").select("doc_id", "y"))
    group = F.col(f"`{strata}`") if strata in docs.columns else F.lit(None)
    digest = F.md5(F.col("doc_id").cast("string"))
    known = (lab.join(docs.select("doc_id", group.cast("string").alias("stratum")), "doc_id").groupBy("doc_id", "y")
             .agg(F.coalesce(F.min("stratum"), F.lit("")).alias("stratum")).withColumn("digest", digest))
    sizes = known.groupBy("y", "stratum").agg(F.count(F.lit(1)).alias("n")).collect()       # a row a label and language
    shares = [(r["y"], r["stratum"], min(1.0, _level([x["n"] for x in sizes if x["y"] == r["y"]], sample) / r["n"])) for r in sizes]
    share = docs.sparkSession.createDataFrame(shares, "y int, stratum string, share double")
    # a hash of the id says whether a row is in its stratum's share, so no stratum is sorted
    drawn = known.join(F.broadcast(share), ["y", "stratum"]).filter(F.pmod(F.xxhash64("digest"), F.lit(1 << 40)) < F.col("share") * (1 << 40))
    chosen = drawn.filter("y = 0").orderBy("digest", "doc_id").limit(sample).unionByName(
        drawn.filter("y = 1").orderBy("digest", "doc_id").limit(sample)).select("doc_id", "y")
    # 2 * sample ids at most, so the texts need no shuffle to meet them
    labelled = stored(taught_text(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")), "labelled")
    totals = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return nothing

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for b in batches:
            for t, y in zip(b.column("text"), b.column("y").to_pylist()):
                for k in features(t.as_py()):
                    c = counts.get(k)
                    if c is None:
                        c = counts[k] = [0, 0]
                    c[y] += 1
            if len(counts) > 200_000:               # partial counts, summed in Spark
                yield _counted(counts)
                counts = {}
        yield _counted(counts)

    counted = stored(labelled.select("text", "y").mapInArrow(names, "feature string, clean long, toxic long")
                     .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "feature-counts")
    # among this many features, chance alone reaches a log-likelihood ratio of about 2 ln(features)
    chance = 2 * math.log(max(counted.count(), 2))

    def strong(table: DataFrame) -> list[str]:
        odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
        both = F.col("toxic") + F.col("clean")
        ratio = 2 * (_xlog(F.col("toxic"), both * n1 / (n0 + n1)) + _xlog(F.col("clean"), both * n0 / (n0 + n1)))
        return [r["feature"] for r in table.filter((odds >= min_odds) & (ratio >= chance))
                .orderBy(ratio.desc(), "feature").select("feature").collect()]

    candidates = {f: i for i, f in enumerate(strong(counted))}

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = {(f, y, p) for t, y in zip(b.column("text"), b.column("y").to_pylist())
                    for f, p in _in_context(t.as_py(), candidates)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in seen], pa.string()), pa.array([x[1] for x in seen], pa.int32()),
                 pa.array([x[2] for x in seen], pa.string())], names=["feature", "y", "before"])

    # copies of one text repeat its words before the same words; different words before it are separate evidence
    around = (labelled.select("text", "y").mapInArrow(contexts, "feature string, y int, before string").distinct()
              .groupBy("feature").agg(F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean")))
    vocabulary = {f: i for i, f in enumerate(strong(around))}
    if not vocabulary:
        return nothing
    probe = ToxicityModel(vocabulary, np.zeros(len(vocabulary)), np.zeros(3))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [probe.values(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.string()), b.column("y"),
                 pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.float32()))],
                names=["doc_id", "y", "idx", "val"])

    got = (labelled.select("doc_id", "y", "text")
           .mapInArrow(rows, "doc_id string, y int, idx array<int>, val array<float>").toArrow().to_pylist())
    got.sort(key=lambda r: r["doc_id"])
    counts = [len(r["idx"]) for r in got]
    x = Entries(np.repeat(np.arange(len(got)), counts), np.array([i for r in got for i in r["idx"]], np.int64),
                np.array([v for r in got for v in r["val"]], float), (len(got), len(vocabulary)))
    y = np.array([r["y"] for r in got])
    evidence = x.times(np.ones(len(vocabulary)))
    cuts = np.quantile(evidence[y == 1], [1 / 3, 2 / 3])
    grade = y * (1 + (evidence > cuts[0]) + (evidence > cuts[1]))
    weights, thresholds = fit_ordinal(x, grade)
    return ToxicityModel(vocabulary, weights, thresholds)


def _level(sizes: list[int], total: int) -> float:
    """How much each stratum gives at most, so that all together give ``total`` or all that they have."""
    left = total
    for i, n in enumerate(sorted(sizes)):
        even = left / (len(sizes) - i)
        if n > even:
            return even
        left -= n
    return float(max(sizes))


def _in_context(text: str | None, wanted: dict[str, int]) -> Iterator[tuple[str, str]]:
    """Wanted features of a text with the word before them."""
    before = ""
    for w in _WORDS.findall((text or "").lower()):
        if "=" + w in wanted:
            yield "=" + w, before
        if len(w) > STEM and w[:STEM] in wanted:
            yield w[:STEM], before
        before = w


def _xlog(n: Column, expected: Column) -> Column:
    return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)


def _counted(counts: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
         pa.array([c[1] for c in counts.values()], pa.int64())], names=["feature", "clean", "toxic"])


def _severity(model: ToxicityModel) -> Column:
    # the model, bounded by the sample, travels with the function

    @F.pandas_udf("double")
    def severity(texts):
        return texts.map(model.expected, na_action=None).astype("float64")

    return severity("text")


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``severity`` (expected grade, 0 to 3) and ``grade`` (the nearest whole grade), which replace
    columns of these names."""
    return docs.withColumn("severity", _severity(model)).withColumn("grade", F.rint("severity").cast("int"))


def reject_toxic(docs: DataFrame, model: ToxicityModel, *, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose expected grade is below ``limit``, columns as they were."""
    scored = packed(docs).select("row", _severity(model).alias("severity"))
    return scored.filter(F.col("severity") < limit).select("row.*")


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", "severity", "grade", (F.col("severity") >= 0.5).alias("toxic"))
