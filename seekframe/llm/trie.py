"""Prefix trie of conversations with subtree totals by time-forward processing (operator 12).

*Paths.*  Turns are range-partitioned and sorted by (conversation, turn), so
one long conversation spreads over many tasks.  A task numbers its turns and
chains their hashes, ``H = H * BASE + turn`` modulo a prime of 107 bits; chains
compose, so conversations that cross a border are carried on from the task
before (one small row a task).  A node of the trie is a chain value.  Rebuilding
a conversation from another one's first turns and its own rest shifts its chain
values by a known term, so no turn is chained again.

*Nodes.*  One aggregate by chain value gives each node's smallest member, which
with the depth names it, its members and its *weight*, the member turns below.

*Totals.*  A node is light if its weight is at most ``shard_rows`` and heavy
otherwise; the root is heavy.  Light nodes below one light node with a heavy
parent form a shard, which is therefore bounded.  A task sorts its shards' nodes by
falling level and hands totals up through a priority queue that spills to the
task's scratch file (:class:`SpillingQueue`): a message waits under its
recipient's place in that order, so each node finds its children's totals at
the head of the queue.  Roots of shards send theirs to heavy nodes.  Heavy nodes
of one path are summed in segments (a path's stretch within a range partition),
and the same queue takes the segments' totals, far fewer than nodes, across
segments; arrivals are then added above the places where they came in.

Member lists are hashed from sorted chunks of 4,096 ids, so a node where very
many conversations end costs one streamed digest and bounded memory.

Defined cases: null role or text is empty text; rows without conv_id belong to
no conversation; turns of equal number (null first) are ordered by a hash of
role and text, and rows that repeat entirely are so many turns; ``base_of`` floors,
also below zero; a table without conversations has no nodes; other columns are
ignored, whatever their names.  Different sequences share a chain value with a
probability of about 2 ** -100 a pair.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import stored

PRIME = 2**107 - 1
BASE = 0x5851F42D4C957F2D14057B7EF76
SIZE = 14
ROOT = (1).to_bytes(SIZE, "big")


def _number(x: bytes) -> int:
    return int.from_bytes(x, "big")


def _value(x: int) -> bytes:
    return (x % PRIME).to_bytes(SIZE, "big")


# paths

def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and chain the turns of a sorted partition; its first conversation starts from 0, the others from the root."""
    pid, conv, n, h, fresh = TaskContext.get().partitionId(), None, 0, 0, None
    for b in batches:
        at, value, before, new = [], [], [], []
        for c, x, y in zip(*(b.column(k).to_pylist() for k in ("conv_id", "h1", "h2"))):
            if c != conv:
                fresh = fresh is not None                   # only the partition's first conversation may have begun before
                conv, n, h = c, 0, int(fresh)
            at.append(n)
            before.append(_value(h))
            h = (h * BASE + ((x % 2**53) << 53 | y % 2**53)) % PRIME
            value.append(_value(h))
            new.append(fresh)
            n += 1
        size = len(at)
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), pa.array(np.full(size, pid, np.int32)), pa.array(at, pa.int64()), pa.array(new, pa.bool_()),
             pa.array(value, pa.binary()), pa.array(before, pa.binary()), b.column("bytes")],
            names=["conv_id", "pid", "at", "fresh", "node", "parent", "bytes"])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 0), node and parent (chain values after and before the turn) and bytes of every turn."""
    turns = (conversations.filter("conv_id is not null")
             .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
             .select("conv_id", "turn", F.xxhash64(F.lit(1), "role", "text").alias("h1"),
                     F.xxhash64(F.lit(2), "role", "text").alias("h2"), F.octet_length("text").cast("long").alias("bytes"),
                     F.monotonically_increasing_id().alias("row")))        # so that equal rows can be told apart
    key = ["conv_id", "turn", "h1", "h2", "row"]
    chained = stored(turns.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(
        _chain, "conv_id long, pid int, at long, fresh boolean, node binary, parent binary, bytes long"), "turns")
    # one row a task: conversations that go on from one task to the next
    edges = chained.groupBy("pid").agg(F.min("conv_id"), F.max("conv_id")).orderBy("pid").toArrow().to_pylist()
    edges = [list(e.values()) for e in edges]
    crossing = sorted({a[2] for a, b in zip(edges, edges[1:]) if a[2] == b[1]})
    carry: dict[int, tuple[int, int, int]] = {}             # by task: its first conversation, turns before, chain value
    if crossing:
        some = chained.sparkSession.createDataFrame([(c,) for c in crossing], "conv_id long")   # fewer than tasks
        parts = (chained.join(F.broadcast(some), "conv_id").groupBy("conv_id", "pid")
                 .agg(F.count(F.lit(1)).alias("n"), F.max_by("node", "at").alias("node"), F.bool_and("fresh").alias("fresh"))
                 .orderBy("conv_id", "pid").toArrow().to_pylist())
        conv, before, h = None, 0, 1
        for p in parts:
            if p["conv_id"] != conv:
                conv, before, h = p["conv_id"], 0, 1
            if not p["fresh"]:
                carry[p["pid"]] = (conv, before, h)
                h = (h * pow(BASE, p["n"], PRIME) + _number(p["node"])) % PRIME
            else:
                h = _number(p["node"])
            before += p["n"]

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, value, before = (b.column(k) for k in ("at", "node", "parent"))
            old = np.flatnonzero(~b.column("fresh").to_numpy(zero_copy_only=False))
            if len(old):
                at, value, before = at.to_numpy().copy(), value.to_pylist(), before.to_pylist()
                pid = b.column("pid").to_numpy()
                for k in old.tolist():
                    _, n, h = carry.get(int(pid[k]), (None, 0, 1))
                    i = int(at[k])
                    value[k] = _value(h * pow(BASE, i + 1, PRIME) + _number(value[k]))
                    before[k] = _value(h * pow(BASE, i, PRIME) + _number(before[k]))
                    at[k] += n
                at, value, before = pa.array(at), pa.array(value, pa.binary()), pa.array(before, pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), at, value, before, b.column("bytes")],
                                             names=["conv_id", "at", "node", "parent", "bytes"])

    return chained.mapInArrow(resolve, "conv_id long, at long, node binary, parent binary, bytes long")


def paths_of(turns: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent, bytes and length of every place of every conversation, the root included."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    places = turns.select("conv_id", (F.col("at") + 1).alias("depth"), "node", "parent", "bytes")
    return stored(places.join(sizes, "conv_id").unionByName(_roots(sizes)), "paths")


def _roots(sizes: DataFrame) -> DataFrame:
    return sizes.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"),
                         F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("bytes"), "length")


def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain values of own turns after another beginning: what the beginnings differ by, carried on turn by turn."""
    for b in batches:
        rows = [b.column(k).to_pylist() for k in ("node", "parent", "ahead", "was", "now")]
        value, before = [], []
        for node, parent, ahead, was, now in zip(*rows):
            if was != now:
                by = (_number(now) - _number(was)) * pow(BASE, ahead, PRIME)
                node, parent = _value(_number(node) + by * BASE), _value(_number(parent) + by)
            value.append(node)
            before.append(parent)
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("depth"), pa.array(value, pa.binary()),
                                          pa.array(before, pa.binary()), b.column("bytes"), b.column("length")],
                                         names=["conv_id", "depth", "node", "parent", "bytes", "length"])


def rebuilt_paths(turns: DataFrame, *, base: Column, taken: Column, most: int) -> DataFrame:
    """Paths of conversations whose first ``taken`` (at most ``most``) turns are those of conversation ``base``.

    All turns of ``base`` where it has fewer, none where it is absent; then the own
    turns from number ``taken`` on.  ``base`` and ``taken`` are expressions over conv_id.
    """
    own = (turns.groupBy("conv_id")
           .agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("at") + 1 == taken, F.col("node"))).alias("was"))
           .select("*", base.alias("base"), taken.alias("taken")))
    heads = (turns.filter(F.col("at") < most).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("at", "node", "parent", "bytes"))).alias("head"))
             .join(own.select("base").distinct(), "base", "left_semi"))
    k = F.when(F.col("head").isNull(), 0).otherwise(F.least(F.col("taken"), F.size("head")))
    info = stored(own.join(heads, "base", "left").select(
        "conv_id", "taken", k.cast("long").alias("k"), F.when(F.col("taken") == 0, F.lit(ROOT)).otherwise(F.col("was")).alias("was"),
        F.when(k == 0, F.lit(ROOT)).otherwise(F.get("head", k.cast("int") - 1)["node"]).alias("now"),
        F.when(k > 0, F.slice("head", F.lit(1), k.cast("int"))).alias("head"),
        (k + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).cast("long").alias("length")), "rebuilt")
    first = (info.select("conv_id", "length", F.inline("head"))
             .select("conv_id", (F.col("at") + 1).alias("depth"), "node", "parent", "bytes", "length"))
    rest = (turns.join(info.select("conv_id", "taken", "k", "was", "now", "length"), "conv_id").filter(F.col("at") >= F.col("taken"))
            .withColumn("ahead", F.col("at") - F.col("taken"))
            .select("conv_id", (F.col("k") + F.col("ahead") + 1).alias("depth"), "node", "parent", "bytes", "length", "ahead", "was", "now")
            .mapInArrow(_shift, "conv_id long, depth long, node binary, parent binary, bytes long, length long"))
    return stored(first.unionByName(rest).unionByName(_roots(info)), "paths")


# member lists

_IDS = 4096


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to ``_IDS`` neighbouring ids of a node as one text."""
    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1][0] for r in rows], pa.int64()),
                                           pa.array([",".join(map(str, r[1])) for r in rows])], names=["node", "low", "ids"])

    rows: list = []
    for b in batches:
        for node, c in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()):
            if not rows or rows[-1][0] != node or len(rows[-1][1]) >= _IDS:
                if len(rows) >= 1000 or rows and len(rows[-1][1]) >= _IDS:
                    yield out(rows)
                    rows = []
                rows.append((node, []))
            rows[-1][1].append(c)
    if rows:
        yield out(rows)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, which arrive sorted."""
    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1].hexdigest() for r in rows])],
                                          names=["node", "ends_sha256"])

    rows: list = []
    for b in batches:
        for node, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
            if rows and rows[-1][0] == node:
                rows[-1][1].update(b",")
            else:
                if len(rows) >= 1000:
                    yield out(rows)
                    rows = []
                rows.append((node, hashlib.sha256()))
            rows[-1][1].update(ids.encode())
    if rows:
        yield out(rows)


def member_digests(paths: DataFrame) -> DataFrame:
    """node and the digest of the conversations that end there (ids ascending, comma-joined)."""
    ends = paths.filter(F.col("depth") == F.col("length")).select("node", "conv_id")
    chunks = (ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(_chunks, "node binary, low long, ids string"))
    return (chunks.repartition("node").sortWithinPartitions("node", "low")
            .mapInArrow(_digests, "node binary, ends_sha256 string"))


# totals

class SpillingQueue:
    """Priority queue of tuples, least first; beyond ``room`` of them the later half goes to a sorted run in a scratch file."""

    def __init__(self, room: int = 200_000):
        self._heap: list[tuple] = []
        self._heads: list[tuple] = []                       # (next item, run) of every run
        self._room, self.runs = max(2, room), 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self._room:
            self._heap.sort()
            half = len(self._heap) // 2
            file = tempfile.TemporaryFile()
            for x in self._heap[half:]:
                pickle.dump(x, file)
            file.seek(0)
            del self._heap[half:]
            self.runs += 1
            heapq.heappush(self._heads, (pickle.load(file), self.runs, file))

    def peek(self) -> tuple | None:
        if self._heads and (not self._heap or self._heads[0][0] < self._heap[0]):
            return self._heads[0][0]
        return self._heap[0] if self._heap else None

    def pop(self) -> tuple:
        if self._heads and (not self._heap or self._heads[0][0] < self._heap[0]):
            item, run, file = self._heads[0]
            try:
                heapq.heapreplace(self._heads, (pickle.load(file), run, file))
            except EOFError:
                heapq.heappop(self._heads)
                file.close()
            return item
        return heapq.heappop(self._heap)


def time_forward(nodes: DataFrame, by: Column, *, room: int = 200_000) -> DataFrame:
    """Subtree totals of forests whose trees each lie in one group of ``by``.

    ``nodes`` has node, level, parent, parent_level (below level; null parent: a
    root here), leaves and saved (own values).  Gives node, leaves and saved of
    the subtree.  A recipient's messages wait under (falling level, node), the
    order in which nodes come.
    """
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(room)
        for b in batches:
            out_leaves, out_saved = [], []
            for node, level, parent, up, leaves, saved in zip(*(c.to_pylist() for c in b.columns)):
                while (m := queue.peek()) is not None and m[:2] <= (-level, node):
                    if m[:2] != (-level, node):
                        raise RuntimeError("a message has no recipient: parents must lie in their children's group")
                    queue.pop()
                    leaves += m[2]
                    saved += m[3]
                if parent is not None:
                    queue.push((-up, parent, leaves, saved))
                out_leaves.append(leaves)
                out_saved.append(saved)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out_leaves, pa.int64()), pa.array(out_saved, pa.int64())],
                                             names=["node", "leaves", "saved"])
        if queue.peek() is not None:
            raise RuntimeError("a message has no recipient: parents must lie in their children's group")

    rows = nodes.withColumn("_by", by)
    rows = rows.repartition("_by") if by is not None else rows
    return (rows.sortWithinPartitions(F.desc("level"), "node").select("node", "level", "parent", "parent_level", "leaves", "saved")
            .mapInArrow(fn, "node binary, leaves long, saved long"))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums along stretches of one path, from the deepest node up; a stretch is named after that node."""
    seg, up, leaves, saved = None, None, 0, 0
    for b in batches:
        out = []
        for node, parent, own_leaves, own_saved in zip(*(b.column(k).to_pylist() for k in ("node", "parent", "leaves", "saved"))):
            if node != up:
                seg, leaves, saved = node, 0, 0
            up, leaves, saved = parent, leaves + own_leaves, saved + own_saved
            out.append((seg, leaves, saved))
        seg_, l_, s_ = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("parent"), b.column("depth"), pa.array(seg_, pa.binary()),
                                          pa.array(l_, pa.int64()), pa.array(s_, pa.int64())],
                                         names=["node", "parent", "depth", "seg", "leaves", "saved"])


def heavy_totals(heavy: DataFrame, *, room: int = 200_000) -> DataFrame:
    """node, leaves and saved of the subtrees of heavy nodes, whose own values hold what light children sent."""
    segments = stored(heavy.repartitionByRange("conv_id", F.desc("depth")).sortWithinPartitions("conv_id", F.desc("depth"))
                      .select("node", "parent", "depth", "leaves", "saved")
                      .mapInArrow(_segments, "node binary, parent binary, depth long, seg binary, leaves long, saved long"), "segments")
    tops = segments.groupBy("seg").agg(F.min_by(F.struct("depth", "parent", "leaves", "saved"), "depth").alias("top")).select("seg", "top.*")
    above = segments.select(F.col("node").alias("parent"), F.col("seg").alias("up"))
    levels = tops.select(F.col("seg").alias("up"), F.col("depth").alias("parent_level"))
    links = stored(tops.join(above, "parent", "left").join(levels, "up", "left"), "links")
    totals = time_forward(links.select(F.col("seg").alias("node"), F.col("depth").alias("level"), F.col("up").alias("parent"),
                                       "parent_level", "leaves", "saved"), F.lit(0), room=room)
    arrived = (totals.join(links.select(F.col("seg").alias("node"), F.col("parent").alias("to")), "node")
               .filter("to is not null").groupBy(F.col("to").alias("node"))
               .agg(F.sum("leaves").alias("in_leaves"), F.sum("saved").alias("in_saved")))
    up = Window.partitionBy("seg").orderBy(F.desc("depth"))      # a segment is a part of a range partition
    rows = segments.join(arrived, "node", "left")
    return rows.select("node", *((F.col(c) + F.coalesce(F.sum(f"in_{c}").over(up), F.lit(0))).alias(c) for c in ("leaves", "saved")))


def prefix_trie(paths: DataFrame, *, shard_rows: int | None = None, room: int = 200_000) -> DataFrame:
    """One row for every node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``paths`` as :func:`paths_of` or :func:`rebuilt_paths` gives them.
    ``shard_rows`` bounds a shard (default: a 4,096th of all member turns, 1,000 at least).
    """
    seen = stored(paths.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "members")
    most = seen.agg(F.max("weight")).first()[0] or 0
    limit = shard_rows if shard_rows is not None else max(1000, most // 4096)
    heavy = (F.col("weight") > limit) | (F.col("depth") == 0)
    kids = seen.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    up = seen.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), heavy.alias("parent_heavy"))
    nodes = stored(
        seen.join(kids, "node", "left").join(member_digests(paths), "node", "left").join(up, "parent", "left")
        .select("node", "conv_id", "depth", "parent", "parent_conv_id", "parent_heavy", "n_convs", heavy.alias("heavy"),
                F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
                ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "nodes")
    own = nodes.select("*", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"))
    # a path is heavy down to some depth; the node below that is the root of its shard
    deepest = (paths.join(nodes.filter("heavy and depth > 0").select("node"), "node", "left_semi")
               .groupBy("conv_id").agg(F.max("depth").alias("last")))
    shards = (paths.filter("depth > 0").join(deepest, "conv_id", "left").filter(F.col("depth") == F.coalesce("last", F.lit(0)) + 1)
              .select("conv_id", F.col("node").alias("shard")))
    light = own.filter(~F.col("heavy")).join(shards, "conv_id")
    inner = ~F.col("parent_heavy")
    low = stored(time_forward(light.select(
        "node", F.col("depth").alias("level"), F.when(inner, F.col("parent")).alias("parent"),
        F.when(inner, F.col("depth") - 1).alias("parent_level"), "leaves", "saved", "shard"), F.col("shard"), room=room), "light")
    sent = (low.join(nodes.filter("parent_heavy and not heavy").select("node", "parent"), "node")
            .groupBy(F.col("parent").alias("node")).agg(F.sum("leaves").alias("in_leaves"), F.sum("saved").alias("in_saved")))
    high = heavy_totals(own.filter("heavy").join(sent, "node", "left").select(
        "node", "conv_id", "depth", "parent",
        *((F.col(c) + F.coalesce(f"in_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved"))), room=room)
    totals = low.unionByName(high).select("node", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    return nodes.join(totals, "node").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                             "saved_tokens", "ends_sha256")


# the contract

def base_of(c: Column) -> Column:
    return c - F.pmod(c, F.lit(5))


def conversations_digest(conversations: DataFrame, *, shard_rows: int | None = None, room: int = 200_000) -> DataFrame:
    c = F.col("conv_id")
    paths = rebuilt_paths(numbered_turns(conversations), base=base_of(c), taken=F.crc32(c.cast("string").cast("binary")) % 9, most=8)
    return prefix_trie(paths, shard_rows=shard_rows, room=room)


#: crc32 of the id's decimal digits, bit by bit, as SQL has no such function.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
    lambda s, k: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::BIGINT) ELSE s >> 1 END)), 4294967295::BIGINT)"""

TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - (conv_id % 5 + 5) % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND pos < h
  UNION ALL
  SELECT c.conv_id, 1 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos >= h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, octet_length(encode(text)) AS bytes,
         md5(string_agg(md5(role) || md5(text), '') OVER w) AS node,
         count(*) OVER (PARTITION BY conv_id) AS length
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, 0, 0, '', (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id) FROM c),
n AS (
  SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM p GROUP BY node),
u AS (
  SELECT n.*, q.node AS parent, q2.conv_id AS parent_conv_id
  FROM n LEFT JOIN p q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1 LEFT JOIN n q2 ON q2.node = q.node),
k AS (SELECT parent AS node, count(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY parent),
s AS (
  SELECT p.node, sum(u.own) AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
  FROM u LEFT JOIN k ON k.node = u.node JOIN p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.node)
SELECT u.conv_id, u.depth::BIGINT AS depth, u.parent_conv_id, u.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM u JOIN s USING (node) LEFT JOIN k USING (node)
"""
