"""Token IDs in training order, written as fixed-stride binary shards (operator 5).

Texts become token ids of a public byte-level vocabulary (its path is a
parameter), each text closed by the end-of-text id.  A task joins its texts'
tokens and cuts them into sequences of ``length`` ids, so only the last one of
a task is padded.  Sequences are numbered 0 to N - 1 without gaps: the task
counts its own, and the tasks' totals, one row a task, give the offsets.  The
numbered table is stored before anything depends on it, so numbers stay the
same when executors are lost.

Training order: a keyed Feistel network permutes the smallest even-bit domain
that holds N, and cycle-walking (applying it again to whatever lands at N or
beyond) makes it a permutation of 0 to N - 1.  The permuted number is the
sequence's slot; ``per_shard`` neighbouring slots make a shard.  Slots are
range-partitioned by whole shards, each range written in order.  Every shard is
one sorted file of records of the same size, so slot s lies in shard
s // per_shard at byte (s % per_shard) * stride, which is all that a reader
needs to read on from any slot.  Files are written by Spark's text writer, so
they go to any store and appear only when a task has committed.

A record: number of tokens before padding (uint32), ``length`` token ids
(uint16, little-endian, padded with the end-of-text id), a line feed.

Defined cases: null and empty texts give the end-of-text id alone; strings that
look like special tokens are ordinary text; texts of any length run over as
many sequences as they need; repeated rows are written as often as they stand
there; an empty table gives no shards and an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm.common import shared_dir, shuffles_freed, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the vocabulary's merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
ROUNDS = 6
#: Sequences of a shard: some 17 MB at the default length.
PER_SHARD = 8192


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoding(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _round(half: np.ndarray, key: int, i: int, mask: np.uint64) -> np.ndarray:
    h = half + np.uint64((key + (i + 1) * 0x9E3779B97F4A7C15) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) & mask


def permute(n: np.ndarray, size: int, key: int) -> np.ndarray:
    """Slots of the numbers ``n`` under the keyed permutation of 0 to size - 1."""
    return _walk(n, size, key, range(ROUNDS))


def unpermute(slots: np.ndarray, size: int, key: int) -> np.ndarray:
    return _walk(slots, size, key, range(ROUNDS - 1, -1, -1))


def _walk(n: np.ndarray, size: int, key: int, rounds: range) -> np.ndarray:
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    out = np.asarray(n, np.uint64).copy()
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> bits, out[todo] & mask
        for i in rounds:
            if rounds.step > 0:
                left, right = right, left ^ _round(right, key, i, mask)
            else:
                left, right = right ^ _round(left, key, i, mask), left
        out[todo] = (left << bits) | right
        todo[todo] = out[todo] >= size
    return out.astype(np.int64)


def sequences(docs: DataFrame, *, vocabulary: str = VOCABULARY, length: int = 1024) -> DataFrame:
    """pid, local (number within the task) and the record of every sequence."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))   # one vocabulary file

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(shared.value)
        pid, local, rest = TaskContext.get().partitionId(), 0, np.zeros(0, "<u2")

        def rows(ids: np.ndarray, counts: list[int]) -> pa.RecordBatch:
            nonlocal local
            k = len(counts)
            table = np.empty((k, 4 + 2 * length), np.uint8)
            table[:, :4] = np.array(counts, "<u4")[:, None].view(np.uint8)
            table[:, 4:] = ids[:k * length].reshape(k, length).view(np.uint8)
            got = pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, pid, np.int32)), pa.array(np.arange(local, local + k)),
                 pa.array(list(map(bytes, table)), pa.binary())], names=["pid", "local", "record"])
            local += k
            return got

        for b in batches:
            for lo in range(0, b.num_rows, 500):
                parts = [rest]
                for t in b.column("text").slice(lo, 500):
                    parts.append(np.asarray(enc.encode_to_numpy(t.as_py() or "", disallowed_special=()), "<u2"))
                    parts.append(np.array([END], "<u2"))
                ids = np.concatenate(parts)
                k = len(ids) // length
                rest = ids[k * length:]
                if k:
                    yield rows(ids, [length] * k)
        if len(rest):
            yield rows(np.concatenate([rest, np.full(length - len(rest), END, "<u2")]), [len(rest)])

    return docs.select("text").mapInArrow(fn, "pid int, local long, record binary")


def write_shards(docs: DataFrame, path: str, *, vocabulary: str = VOCABULARY, length: int = 1024, per_shard: int = PER_SHARD,
                 key: int = 20240229, passes: int = 4) -> int:
    """Write the shards below ``path``, which must be new, in ``passes`` ranges; returns the number of sequences.

    A task takes a range of neighbouring shards, whole ones, in slot order, so it writes one file for each of them.
    """
    spark = docs.sparkSession
    numbered = stored(sequences(docs, vocabulary=vocabulary, length=length), "sequences", compression="zstd")
    # one row for each task of the scan
    totals = numbered.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).orderBy("pid").toArrow().to_pydict()
    size = sum(totals["n"])
    if not size:
        return 0
    first = np.zeros(totals["pid"][-1] + 1, np.int64)
    first[totals["pid"]] = np.cumsum([0, *totals["n"]][:-1])
    offsets = spark.sparkContext.broadcast(first)

    def slots(pid: pd.Series, local: pd.Series) -> pd.Series:
        return pd.Series(permute(offsets.value[pid.to_numpy()] + local.to_numpy(), size, key))

    # so marked, Spark computes it once a row and not again for the filter
    slot = F.pandas_udf(slots, "long").asNondeterministic()
    shards = -(-size // per_shard)
    placed = (numbered.select(slot("pid", "local").alias("slot"), "record")
              .withColumn("shard", F.floor(F.col("slot") / per_shard)))
    # a range of shards at a time, so that only its share of the corpus lies in shuffle files
    step = -(-shards // passes)
    with shuffles_freed(spark):
        for lo in range(0, shards, step):
            (placed.filter((F.col("shard") >= lo) & (F.col("shard") < lo + step))
             .repartitionByRange(step, "shard").sortWithinPartitions("shard", "slot")
             .select("shard", F.col("record").cast("string").alias("value"))
             .write.mode("append").partitionBy("shard").option("lineSep", "\n").text(path))
    return size


def read_shards(spark: SparkSession, path: str, *, length: int = 1024, per_shard: int = PER_SHARD, start: int = 0) -> DataFrame:
    """slot, shard, n_tokens and ids of every sequence from slot ``start`` on; earlier shards are not opened."""
    stride = 4 + 2 * length + 1

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content")):
                data = np.frombuffer(content.as_py(), np.uint8).reshape(-1, stride)
                n = np.ascontiguousarray(data[:, :4]).view("<u4")[:, 0]
                ids = np.ascontiguousarray(data[:, 4:-1]).view("<u2")
                slots = shard * per_shard + np.arange(len(data))
                for lo in range(0, len(data), 500):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slots[lo:lo + 500]), pa.array([shard] * len(n[lo:lo + 500]), pa.int64()),
                         pa.array(n[lo:lo + 500].astype(np.int32)),
                         pa.array([x[:k].tobytes() for x, k in zip(ids[lo:lo + 500], n[lo:lo + 500])], pa.binary())],
                        names=["slot", "shard", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").load(path).filter(F.col("shard") >= start // per_shard)
    return (files.select(F.col("shard").cast("long").alias("shard"), "content")
            .mapInArrow(fn, "slot long, shard long, n_tokens int, ids binary").filter(F.col("slot") >= start))


def tokens_digest(docs: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the shards to the shared folder and read every sequence back: slot, shard, n_tokens, digest of its ids."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/llm-shards-{uuid.uuid4().hex}"
    if not write_shards(docs, path, vocabulary=vocabulary):
        return spark.range(0).select(F.col("id").alias("slot"), F.col("id").alias("shard"),
                                     F.col("id").cast("int").alias("n_tokens"), F.lit("").alias("ids_md5"))
    return read_shards(spark, path).select("slot", "shard", "n_tokens", F.md5("ids").alias("ids_md5"))
