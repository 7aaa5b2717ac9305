"""Quality classifier: nearest-neighbour voting over latent-semantic vectors (operator 1).

Fit: a bounded sample of labelled rows (``sample`` rows at most, half of them
of each label where there are enough, chosen by a hash of the doc_id) gives a
matrix of hashed features; its truncated singular value decomposition, found
by a seeded randomised range finder, gives the latent-semantic projection.
The sample's projected, unit-length vectors and their vote weights are
broadcast: ``sample * dims`` floats, 1 MB at the defaults, whatever the corpus.

Score: each task turns whole texts into features and projects them, and takes
exact cosines of a block of documents with all labelled vectors as one matrix
product.  The ``k`` nearest vote with max(cosine, 0) ** power; a label's votes
are weighted by its share of all labelled rows over its share of the sample,
so that the stratified sample does not shift the scores.

Defined cases: null and empty texts have the zero vector, which has no
neighbours, and score the prior share of label 1; equal texts score alike;
rows are scored one by one, whatever their ids; where a labelled id stands
beside several texts, the one with the smallest MD5 teaches; an empty table
gives an empty result; without any usable label the score is 0.5; labels that
are null, other than 0 and 1, or name a document twice with both values do not
teach.  Scores are rounded to six digits, so that neither the order of rows nor
how they are dealt out shows in them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import taught_text

SHAPES, WORDS, STATS = 1024, 4096, 8
#: Latent weight of each feature family before the decomposition.
SHAPE_WEIGHT, WORD_WEIGHT, STAT_WEIGHT = 2.0, 0.4, 1.0
CACHE = 200_000
#: Least share of the largest singular value that a latent direction must have.
NOISE = 1e-4
_RUNS = ((re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0"))


def _shape(tok: str) -> str:
    """Letters and digits collapsed, punctuation kept: 'Thre***' -> 'Aa***'."""
    def letters(m: re.Match) -> str:
        s = m[0]
        return "A" if s.isupper() and len(s) > 1 else "Aa" if s[0].isupper() else "a"
    return _RUNS[1][0].sub("0", _RUNS[0][0].sub(letters, tok))[:12]


class Features:
    """Sparse features of a text: token shapes, hashed words, a few ratios; whole texts, one pass."""

    def __init__(self) -> None:
        self.cache: dict[str, tuple[int, int, bool]] = {}

    def _of(self, tok: str) -> tuple[int, int, bool]:
        s = _shape(tok)
        got = (zlib.crc32(s.encode()) % SHAPES, SHAPES + zlib.crc32(tok.lower().strip(".,;:!?").encode()) % WORDS,
               s in ("A", "Aa", "a", "a.", "a,", "Aa.", "Aa,"))
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[tok] = got
        return got

    def __call__(self, text: str | None) -> tuple[list[int], list[float], list[float]]:
        toks = (text or "").split()
        n = len(toks)
        if not n:
            return [], [], [0.0] * STATS
        counts = Counter(toks)
        shapes: Counter = Counter()
        idx, val = [], []
        plain = 0
        get = self.cache.get
        for t, c in counts.items():
            sh, w, ok = get(t) or self._of(t)
            shapes[sh] += c
            plain += c * ok
            idx.append(w)
            val.append(WORD_WEIGHT * (1 + math.log(c)))
        top = max(counts.values())
        norm = math.sqrt(sum(v * v for v in val)) / WORD_WEIGHT
        val = [v / norm for v in val]
        idx += shapes.keys()
        val += [SHAPE_WEIGHT * math.sqrt(c / n) for c in shapes.values()]
        lines = text.count("\n") + 1
        length = len(text)
        stats = [1.0, len(counts) / n, math.sqrt(top / n), plain / n, min(length / n, 20) / 20,
                 math.log1p(n) / 10, min(n / lines, 200) / 200, sum(c > 2 for c in counts.values()) / len(counts)]
        return idx, val, [STAT_WEIGHT * s for s in stats]


def matrix(feats: list) -> np.ndarray:
    out = np.zeros((len(feats), SHAPES + WORDS + STATS), np.float32)
    for r, (idx, val, stats) in zip(out, feats):
        if idx:
            np.add.at(r, idx, val)
        r[SHAPES + WORDS:] = stats
    return out


@dataclass(frozen=True)
class QualityModel:
    project: np.ndarray   # features x dims, idf folded in
    vectors: np.ndarray   # labelled sample, unit length
    labels: np.ndarray    # 0 or 1
    weights: np.ndarray   # prior share over sample share, per row
    prior: float
    k: int
    power: float

    def embed(self, x: np.ndarray) -> np.ndarray:
        v = x @ self.project
        n = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, n, out=np.zeros_like(v), where=n > 0)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(x), 0.5)
        sims = self.embed(x) @ self.vectors.T                      # exact blocked cosines
        k = min(self.k, sims.shape[1])
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        s = np.maximum(np.take_along_axis(sims, near, 1), 0).astype(np.float64) ** self.power
        w = s * self.weights[near]
        total = w.sum(1)
        one = (w * self.labels[near]).sum(1)
        # one vote of the prior's size keeps scores of far documents near the prior
        return np.clip((one + 0.01 * self.prior) / (total + 0.01), 0.0, 1.0)


def fit_matrix(x: np.ndarray, y: np.ndarray, share_one: float, *, dims: int, k: int, power: float,
               seed: int = 7) -> QualityModel:
    if not len(y):
        return QualityModel(np.zeros((x.shape[1], dims), np.float32), np.zeros((0, dims), np.float32),
                            y, y.astype(float), 0.5, k, power)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32)
    idf[:SHAPES] = 0.5 + idf[:SHAPES] / 4
    idf[SHAPES + WORDS:] = 1
    xi = x * idf
    rng = np.random.default_rng(seed)
    q = xi @ rng.standard_normal((x.shape[1], min(dims + 16, len(x))), dtype=np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(xi @ (xi.T @ q))
    _, weight, vt = np.linalg.svd(q.T @ xi, full_matrices=False)
    # directions that the sample does not have are rounding noise
    vt = vt[weight > NOISE * weight[0]]
    project = (vt[:dims].T * idf[:, None]).astype(np.float32)
    m = QualityModel(project, np.zeros((0, project.shape[1])), y, y.astype(float), share_one, k, power)
    share = y.mean()
    weights = np.where(y == 1, share_one / max(share, 1e-9), (1 - share_one) / max(1 - share, 1e-9))
    return QualityModel(project, m.embed(x), y, weights, share_one, k, power)


def fit_quality(docs: DataFrame, labels: DataFrame, *, teaches: Column | None = None, label: str = "quality",
                sample: int = 4000, dims: int = 64, k: int = 15, power: float = 8.0) -> QualityModel:
    """Fit on at most ``sample`` labelled rows for which ``teaches`` (over doc_id) holds."""
    lab = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (F.lit(True) if teaches is None else teaches))
           .groupBy("doc_id").agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("y2"))
           .filter("y = y2").select("doc_id", "y"))
    counts = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    take1 = min(n1, max(sample // 2, sample - n0))
    take0 = min(n0, sample - take1)
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = (lab.filter("y = 0").orderBy(order, "doc_id").limit(take0)
              .unionByName(lab.filter("y = 1").orderBy(order, "doc_id").limit(take1)))
    texts = taught_text(docs.select("doc_id", "text").join(chosen, "doc_id"))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Features()
        for b in batches:
            got = [f(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.string()), b.column("y"),
                 pa.array([g[0] for g in got], pa.list_(pa.int32())),
                 pa.array([g[1] for g in got], pa.list_(pa.float32())),
                 pa.array([g[2] for g in got], pa.list_(pa.float32()))],
                names=["doc_id", "y", "idx", "val", "stats"])

    # features of the bounded sample, not its texts, come to the driver
    rows = (texts.mapInArrow(fn, "doc_id string, y int, idx array<int>, val array<float>, stats array<float>")
            .toArrow().to_pylist())
    rows.sort(key=lambda r: r["doc_id"])
    x = matrix([(r["idx"], r["val"], r["stats"]) for r in rows])
    y = np.array([r["y"] for r in rows], np.int64)
    return fit_matrix(x, y, n1 / max(n0 + n1, 1), dims=dims, k=k, power=power)


def score_quality(docs: DataFrame, model: QualityModel, *, block: int = 256) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    # the model travels with the function; Spark broadcasts functions of this size: sample * dims floats and the projection
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, m = Features(), model
        for b in batches:
            for lo in range(0, b.num_rows, block):
                part = b.slice(lo, block)
                x = matrix([f(t.as_py()) for t in part.column("text")])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(m.score(x).round(6), pa.float64())],
                                                 names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(fn, f"doc_id {id_type}, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit_quality(docs, labels, teaches=~held_out(F.col("doc_id")))
    return (score_quality(docs, model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))
