"""Periodic runs of words by recompression (operator 13).

A run is a stretch of words with smallest period q and at least
``max(min_words, min_exponent * q)`` words that no neighbour extends keeping
the period.  The words that equal the word q further on form a stretch of at
least that length less q, so for each q one position of a grid with that step
lies in it (a harmonic sum over all q, about n log n positions).  Positions
whose word, and two words beside it, equal those q further on are candidates;
:class:`~seekframe.llm.grammar.Grammar` gives their exact extensions both ways.
An interval found with several periods keeps the smallest.

Texts are independent, so there is no shuffle: a task takes its texts in
groups of up to ``group_words`` words (a longer text is a group by itself; it
takes some 200 bytes a word), joined with a separate sentinel after each, and
resolves candidates a million at a time, so memory does not grow with their
number.

Defined cases: null and empty texts have no words and no runs; a null doc_id
is a value like any other (the digest repeats nothing there); repeated rows
give the same result each; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.grammar import Grammar

#: Candidates resolved at a time.
CHUNK = 1_000_000

Order = Callable[[object, int], "np.ndarray | None"]


def _runs(seq: np.ndarray, i: np.ndarray, q: np.ndarray, least: Callable) -> np.ndarray:
    """Rows (start, stop, period) of the runs that candidates at ``i`` with period ``q`` belong to."""
    g = Grammar(seq)
    found = np.zeros((0, 3), np.int64)
    for lo in range(0, len(i), CHUNK):
        a, p = i[lo:lo + CHUNK], q[lo:lo + CHUNK]
        start = a + 1 - g.extend(a, a + p, -1)             # extensions count the candidate itself
        stop = a + p + g.extend(a, a + p)
        ok = stop - start >= least(p)
        found = np.unique(np.vstack([found, np.stack([start, stop, p], 1)[ok]]), axis=0)
    # by start, stop, period: the first of an interval has its smallest period
    same = (found[1:, :2] == found[:-1, :2]).all(1)
    return found[np.r_[True, ~same]] if len(found) else found


def find_runs(texts: list[np.ndarray], *, min_words: int = 6, min_exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each sequence of word numbers (from 0), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]

    def least(q):
        return np.maximum(min_words, min_exponent * q)

    order = sorted((k for k, t in enumerate(texts) if len(t) >= min_words), key=lambda k: -len(texts[k]))
    if not order:
        return out

    def joined(ks: list[int]) -> tuple[np.ndarray, np.ndarray]:
        top = max(int(texts[k].max()) for k in ks) + 1
        parts = [np.array([top])]
        for x, k in enumerate(ks):
            parts += [texts[k], np.array([top + 1 + x])]   # sentinels: words equal nothing across texts for long
        begin = np.cumsum([1, *(len(texts[k]) + 1 for k in ks)])
        return np.concatenate(parts), begin

    seq, begin = joined(order)
    sizes = np.array([len(texts[k]) for k in order])
    found_i, found_q = [], []
    for q in range(1, int(sizes[0]) // min_exponent + 1):
        need = int(least(q))
        active = int(np.searchsorted(-sizes, -need, "right"))   # texts, longest first, that can hold such a run
        if not active:
            break
        end = int(begin[active])
        at = np.arange(0, end - q, need - q)
        at = at[seq[at] == seq[at + q]]
        if not len(at):
            continue
        # two more equal words around it, as its stretch has need - q of them
        near = [(o, (at + o >= 0) & (at + o + q < end)) for o in (-2, -1, 1, 2)]
        m = {o: ok & (seq[np.maximum(at + o, 0)] == seq[np.minimum(at + o + q, end - 1)]) for o, ok in near}
        at = at[m[1] & m[2] | m[-1] & m[1] | m[-1] & m[-2]] if need - q >= 3 else at
        if len(at):
            found_i.append(at)
            found_q.append(np.full(len(at), q))
    if not found_i:
        return out
    i, q = np.concatenate(found_i), np.concatenate(found_q)
    text = np.searchsorted(begin, i, "right") - 1
    real = (text >= 0) & (text < len(order))
    i, q, text = i[real], q[real], text[real]
    some = np.unique(text)
    if not len(some):
        return out
    short, begin2 = joined([order[x] for x in some])
    new = np.searchsorted(some, text)
    i = i - begin[text] + begin2[new]
    inside = i + q < len(short)                            # else the partner lies in a text without candidates
    for start, stop, p in _runs(short, i[inside], q[inside], least):
        x = int(np.searchsorted(begin2, start, "right")) - 1
        out[order[some[x]]].append((int(start - begin2[x]), int(stop - start), int(p)))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when each run keeps its first period only."""
    gone = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    return np.cumsum(gone[:-1]) == 0


def periodic_runs(docs: DataFrame, *, min_words: int = 6, min_exponent: int = 4, word_order: Order | None = None,
                  group_words: int = 500_000) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and collapsed (the text without repeats) for every row.

    Words are what stands between ASCII white space.  ``word_order(doc_id, n)``
    may give the original word numbers that stand at places 0 to n - 1 (None: as they are).
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def group(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        seqs = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in texts]
        runs = find_runs(seqs, min_words=min_words, min_exponent=min_exponent)
        left = [b" ".join(itertools.compress(w, kept_words(len(w), r)) if r else w) for w, r in zip(texts, runs)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_arrow), pa.array(list(map(len, texts)), pa.int64()),
             pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], run),
             pa.array(left, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal id_arrow
        for b in batches:
            id_arrow = b.column("doc_id").type
            ids, texts, total = [], [], 0
            for i, t in zip(b.column("doc_id"), b.column("text").cast(pa.binary())):
                i, w = i.as_py(), (t.as_py() or b"").split()
                at = word_order(i, len(w)) if word_order else None
                if at is not None:
                    w = [w[k] for k in at.tolist()]
                if total and total + len(w) > group_words:
                    yield group(ids, texts)
                    ids, texts, total = [], [], 0
                ids.append(i)
                texts.append(w)
                total += len(w)
            if ids:
                yield group(ids, texts)

    id_arrow = None
    return docs.select("doc_id", "text").mapInArrow(
        fn, f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def tenth_periodic(doc_id, n: int) -> "np.ndarray | None":
    """The contract's planted repeats: a tenth of the ids repeat their words from place a on with period p."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def periodic_digest(docs: DataFrame) -> DataFrame:
    r = periodic_runs(docs, word_order=tenth_periodic)
    best = F.array_max(F.transform("runs", lambda x: F.struct(x["length"], -x["start"], -x["period"])))
    lines = F.array_join(F.transform("runs", lambda x: F.concat(
        x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"),
        F.lit("\n"))), "")
    return (r.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                     F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                     F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.col3")).alias("period"),
                    F.expr("1000 * best.length div -best.col3").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))
