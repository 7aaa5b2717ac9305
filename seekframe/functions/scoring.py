"""Okapi BM25 as Spark Column arithmetic (Robertson & Zaragoza, 2009).

score(t, d) = idf(t) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
idf(t)      = ln(1 + (N - df + 0.5) / (df + 0.5))

Everything is double arithmetic on native columns; scores are rounded to
``SCORE_DIGITS`` before they are sorted on or put in a cursor so that the
order of summation can never move a document across a page boundary.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the relevance model.
K1 = 1.2
B = 0.75
SCORE_DIGITS = 6


def idf(n_docs: Column, df: Column) -> Column:
    n = n_docs.cast("double")
    d = df.cast("double")
    return F.log(F.lit(1.0) + (n - d + F.lit(0.5)) / (d + F.lit(0.5)))


def tf_norm(tf: Column, dl: Column, avgdl: Column, k1: float = K1, b: float = B) -> Column:
    tf = tf.cast("double")
    dl = dl.cast("double")
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl / avgdl)
    return tf * F.lit(k1 + 1.0) / (tf + norm)


def tf_norm_bound(max_tf: Column, min_dl_per_tf: Column, avgdl: Column, k1: float = K1, b: float = B) -> Column:
    """At least ``tf_norm`` of every posting of a term, whatever the average length is: tf / (tf + norm), divided by tf."""
    rest = F.lit(1.0 - b) / max_tf.cast("double") + F.lit(b) * min_dl_per_tf / avgdl
    return F.lit(k1 + 1.0) / (F.lit(1.0) + F.lit(k1) * rest)


def bm25(tf: Column, dl: Column, n_docs: Column, df: Column, avgdl: Column,
         k1: float = K1, b: float = B) -> Column:
    """BM25 contribution of one term; 0 where the term is absent."""
    return F.when(tf > 0, idf(n_docs, df) * tf_norm(tf, dl, avgdl, k1, b)).otherwise(F.lit(0.0))


def round_score(score: Column) -> Column:
    return F.round(score, SCORE_DIGITS)


def bm25_py(tf: float, dl: float, n_docs: float, df: float, avgdl: float,
            k1: float = K1, b: float = B) -> float:
    """Reference formula in plain Python (tests and brute-force checks)."""
    if tf <= 0:
        return 0.0
    w = math.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))
    return w * tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * dl / avgdl))
