"""Near-duplicates by HyperMinHash (operator 3).

A document's set holds its distinct ``shingle``-word shingles as 64-bit hashes.
Sets that are equal form one class (a 128-bit fingerprint tells), so exact
copies cost one row each and are never compared.  Each class gets a
HyperMinHash sketch: the hash's top bits choose one of ``REGISTERS`` buckets,
and a bucket stores, of its smallest remaining hash, the number of leading
zeros and ``MANTISSA`` bits behind them, 16 bits in all.  Empty registers are
filled from others by a fixed hash walk before banding (optimal densification),
so that short texts band as well as long ones.

Bands of compressed registers find candidates.  ``banding`` takes as many rows a
band as leave a pair at the threshold a probability below 1e-6 to miss all bands:
7 rows in 36 bands at 0.85 (9e-7), 5 rows in 51 bands at 0.8 (2e-9).  Candidates are
thinned by their sizes (exact) and by the Jaccard estimate from the registers,
corrected for accidental collisions of compressed values, at five standard
deviations below the threshold, and then confirmed on the full sets.

All pairs of a bucket are never formed.  First each class meets one class, the
most central of those that lead its buckets: the one with the fewest registers
that no other candidate shares, so in a group of edited copies the text that
they were copied from, or the least edited one.  Confirmed links give components.
Only buckets that still hold several components go on.  There, shingles that
only one class holds are counted exactly; a class with too many of them cannot
reach the threshold with any other and is done.  The rest forms clusters (a
component, and the single classes that its central class led); clusters that
share a bucket meet in blocks of about ``BLOCK`` texts, and each two blocks
report the links that join different components.  Pairs inside one component
need no comparison, as their links would add nothing to the components.

Defined cases: null and empty texts have an empty set and are linked with
nothing; a text of fewer words is one shingle; rows equal in doc_id and text
are one document (each row comes back; as a filter, one stays); null doc_ids
are smaller than none: a component's id is its smallest id that is not null;
an empty table gives an empty result; other columns are ignored or kept as
they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import packed, row_key, stored
from seekframe.llm.components import components, roots

BUCKET_BITS, MANTISSA = 8, 10
REGISTERS = 1 << BUCKET_BITS
#: Highest probability that a pair at the threshold shares no band.
MISSED = 1e-6
EMPTY = 0xFFFF
CACHE = 300_000
#: Most texts that a block of the last comparison holds on average.
BLOCK = 256
#: Shingles that a block holds, some, whatever its texts are long (but for a longer single text).
BLOCK_SHINGLES = 100_000
_LOW = np.uint64(64 - BUCKET_BITS)
_MASK = np.uint64((1 << (64 - BUCKET_BITS)) - 1)
_STARTS = np.arange(REGISTERS, dtype=np.uint64) << _LOW


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def shingle_hashes(text: str | None, cache: dict, shingle: int = 3) -> np.ndarray:
    """The set of a text: sorted, distinct 64-bit hashes of its shingles."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z and ASCII white space only
    if not ws:
        return np.zeros(0, np.uint64)
    w = np.array(list(map(cache.__getitem__, ws)), np.uint64)
    k = min(shingle, len(w))
    n = len(w) - k + 1
    h = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        h = _mix((h + w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15))
    return np.unique(h)


def registers(h: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    if not len(h):
        return out
    at = np.minimum(np.searchsorted(h, _STARTS), len(h) - 1)
    low = h[at]
    full = (low >> _LOW) == (_STARTS >> _LOW)
    v = (low & _MASK) >> np.uint64(64 - BUCKET_BITS - 53)              # 53 bits: exact as a float
    m, e = np.frexp(v.astype(np.float64))
    zeros = np.minimum(53 - e, 62).astype(np.uint16)
    mantissa = np.floor((m * 2 - 1) * (1 << MANTISSA)).clip(0).astype(np.uint16)
    out[full] = ((zeros << np.uint16(MANTISSA)) | mantissa)[full]
    return out


def _walk() -> np.ndarray:
    """For every register the order in which it looks for a filled one, the same for all sets."""
    out = np.empty((REGISTERS, REGISTERS), np.int64)
    for i in range(REGISTERS):
        keys = [xxhash.xxh3_64_intdigest(f"{i}:{j}".encode()) for j in range(REGISTERS)]
        out[i] = np.argsort(np.array(keys, np.uint64), kind="stable")
    return out


def densified(regs: np.ndarray, walk: np.ndarray) -> np.ndarray:
    """Rows of registers with the empty ones filled from the first filled one of their walk."""
    out = regs.copy()
    rows = np.flatnonzero((regs == EMPTY).any(1) & (regs != EMPTY).any(1))
    for step in walk.T:
        if not len(rows):
            break
        have, found = out[rows], regs[rows][:, step]
        have = np.where((have == EMPTY) & (found != EMPTY), found, have)
        out[rows] = have
        rows = rows[(have == EMPTY).any(1)]
    return out


def collision_table(steps: int = 24) -> np.ndarray:
    """Chance that the registers of two disjoint sets with 2**i and 2**j hashes a bucket agree by accident."""
    cell = np.arange(1 << MANTISSA) / (1 << MANTISSA)
    edges = np.concatenate([2.0 ** -(z + 1) * (1 + cell) for z in range(40, -1, -1)] + [[1.0]])
    at_most = [1 - (1 - edges) ** (2.0 ** i) for i in range(steps)]     # the minimum's distribution
    mass = np.array([np.diff(a) for a in at_most])
    return mass @ mass.T


def estimate(a: np.ndarray, b: np.ndarray, na: int, nb: int, accidents: np.ndarray) -> tuple[float, int]:
    """Collision-corrected Jaccard estimate of two register rows, and how many registers it rests on."""
    used = int(((a != EMPTY) | (b != EMPTY)).sum())
    same = int(((a == b) & (a != EMPTY)).sum())
    i, j = (min(max(round(math.log2(max(n / REGISTERS, 1))), 0), len(accidents) - 1) for n in (na, nb))
    expected = accidents[i, j] * (used - same)        # accidents among the registers that truly differ
    return max(0.0, (same - expected) / used) if used else 0.0, used


def sketches(docs: DataFrame, *, shingle: int = 3) -> DataFrame:
    """doc_id, rk, n_shingles, f1, f2 (the set's fingerprint) and registers of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHash()
        for b in batches:
            n, f1, f2, regs = [], [], [], []
            for t in b.column("text"):
                h = shingle_hashes(t.as_py(), cache, shingle)
                d = xxhash.xxh3_128_digest(h.tobytes())
                n.append(len(h))
                f1.append(int.from_bytes(d[:8], "big", signed=True))
                f2.append(int.from_bytes(d[8:], "big", signed=True))
                regs.append(registers(h).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("rk"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                 pa.array(f2, pa.int64()), pa.array(regs, pa.binary())],
                names=["doc_id", "rk", "n_shingles", "f1", "f2", "regs"])

    return docs.select("doc_id", row_key().alias("rk"), "text").mapInArrow(
        fn, f"doc_id {id_type}, rk long, n_shingles long, f1 long, f2 long, regs binary")


def banding(percent: int) -> tuple[int, int]:
    """Rows a band and bands for a threshold: the most rows that keep ``MISSED``."""
    t = percent / 100
    return next(((r, REGISTERS // r) for r in range(REGISTERS, 1, -1) if (1 - t ** r) ** (REGISTERS // r) < MISSED), (1, REGISTERS))


def _band_rows(rows_a_band: int, bands: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _walk()
        band = np.arange(bands, dtype=np.int16)
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                regs = np.stack([np.frombuffer(x.as_py(), np.uint16) for x in part.column("regs")])
                rows = densified(regs, walk)[:, :bands * rows_a_band].reshape(-1, bands, rows_a_band).astype(np.uint64)
                keys = np.zeros(rows.shape[:2], np.uint64)
                for i in range(rows_a_band):
                    keys = _mix((keys + rows[:, :, i] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                keys = keys.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column("cid").to_numpy(), bands)), pa.array(np.tile(band, len(keys))),
                     pa.array(keys.ravel())], names=["cid", "band", "key"])

    return fn


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """cid and text of the classes in ``wanted`` (cid).

    The classes asked for grow with the corpus, so this is a merge join at every size.
    """
    keys = stored(classes.join(wanted, "cid", "left_semi").select("cid", F.col("rep.doc_id").alias("k_id"),
                                                                  F.col("rep.rk").alias("k_rk")), "wanted")
    return stored(docs.select("doc_id", row_key().alias("rk"), "text")
                  .join(keys.hint("merge"), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("rk") == F.col("k_rk")))
                  .select("cid", "text").dropDuplicates(["cid"]), "texts")


def confirmed(texts: DataFrame, classes: DataFrame, pairs: DataFrame, *, percent: int, shingle: int) -> DataFrame:
    """The pairs (u, v) of classes whose sets reach ``percent``: sizes, then estimate, then the sets themselves."""
    a = classes.select(F.col("cid").alias("u"), F.col("n_shingles").alias("nu"), F.col("regs").alias("ru"))
    b = classes.select(F.col("cid").alias("v"), F.col("n_shingles").alias("nv"), F.col("regs").alias("rv"))
    sized = (pairs.join(a, "u").join(b, "v")
             .filter(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accidents, t = collision_table(), percent / 100
        for x in batches:
            keep = []
            for ru, rv, nu, nv in zip(x.column("ru"), x.column("rv"), x.column("nu").to_pylist(), x.column("nv").to_pylist()):
                j, used = estimate(np.frombuffer(ru.as_py(), np.uint16), np.frombuffer(rv.as_py(), np.uint16), nu, nv, accidents)
                keep.append(j >= t - 5 * math.sqrt(t * (1 - t) / max(used, 1)))
            yield x.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = stored(sized.select("u", "v", "nu", "nv", "ru", "rv").mapInArrow(likely, "u long, v long"), "likely")

    def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, last, known = _WordHash(), None, None
        for x in batches:
            keep = []
            for u, tu, tv in zip(x.column("u").to_pylist(), x.column("tu"), x.column("tv")):
                if u != last:                        # rows come sorted by u, so a hot u is hashed once
                    last, known = u, shingle_hashes(tu.as_py(), cache, shingle)
                other = shingle_hashes(tv.as_py(), cache, shingle)
                both = len(np.intersect1d(known, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(known) + len(other) - both))
            yield x.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    tu = texts.select(F.col("cid").alias("u"), F.col("text").alias("tu"))
    tv = texts.select(F.col("cid").alias("v"), F.col("text").alias("tv"))
    return stored(left.join(tv, "v").join(tu, "u").select("u", "v", "tu", "tv").mapInArrow(sure, "u long, v long"), "links")


def _register_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, place and value) of every fourth register."""
    place = np.arange(0, REGISTERS, 4)
    for b in batches:
        if not b.num_rows:
            continue
        regs = np.stack([np.frombuffer(x.as_py(), np.uint16) for x in b.column("regs")])[:, ::4].astype(np.int32)
        full = regs != EMPTY
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(b.column("cid").to_numpy(), full.sum(1))), pa.array(((place << 16) + regs)[full].astype(np.int32))],
            names=["cid", "value"])


def _own(rows: DataFrame, value: str) -> DataFrame:
    """cid and how many of its values no other class has."""
    once = rows.groupBy(value).agg(F.min("cid").alias("cid"), F.max("cid").alias("last"))
    return once.filter("cid = last").groupBy("cid").agg(F.count(F.lit(1)).alias("own"))


def _block_links(texts: DataFrame, classes: DataFrame, labelled: DataFrame, *, percent: int, shingle: int) -> DataFrame:
    """Links between classes of different components in the buckets of ``labelled`` (band, key, cid, component, cluster)."""
    members = stored(labelled.select("cid", "component", "cluster").distinct(), "open-members")
    texts = stored(texts.join(members.select("cid"), "cid", "left_semi"), "open-texts")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHash()
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                sets = [shingle_hashes(t.as_py(), cache, shingle) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column("cid").to_numpy(), [len(h) for h in sets])),
                     pa.array(np.concatenate(sets).view(np.int64))], names=["cid", "h"])

    own = _own(texts.mapInArrow(hashes, "cid long, h long"), "h")
    # what a class shares with any other, against what its own size asks for at least
    alive = stored(members.join(classes.select("cid", F.col("n_shingles").alias("n")), "cid").join(own, "cid", "left")
                   .withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0)))
                   .filter(100 * F.col("shared") >= percent * F.col("n"))
                   .select("cid", "component", "cluster", "n", "shared", (F.col("component") != F.col("cluster")).alias("single")),
                   "alive")
    reach = [F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("shared").alias("most")]
    # a block is bounded in texts and in the shingles that these hold
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES))
    sizes = stored(alive.groupBy("cluster", "single").agg(parts.alias("parts")), "sizes")
    blocks = stored(alive.join(sizes, ["cluster", "single"])
                    .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("parts"))).join(texts, "cid")
                    .groupBy("cluster", "single", "block")
                    .agg(F.collect_list(F.struct("cid", "component", "text")).alias("texts"), *reach), "blocks")

    def fits(x: str, y: str):
        """Sizes allow the threshold, and so does what the texts share with any other."""
        c = lambda side, name: F.col(f"{side}.{name}")
        return ((100 * c(x, "hi") >= percent * c(y, "lo")) & (100 * c(y, "hi") >= percent * c(x, "lo"))
                & ((100 + percent) * F.least(c(x, "most"), c(y, "most")) >= percent * (c(x, "lo") + c(y, "lo"))))

    in_bucket = stored(labelled.select("band", "key", "cid").join(alive.select("cid", "cluster", "n", "shared"), "cid")
                       .groupBy("band", "key", "cluster").agg(*reach), "in-bucket")
    across = (in_bucket.alias("x").join(in_bucket.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key"))
                                        & (F.col("x.cluster") < F.col("y.cluster")) & fits("x", "y"))
              .select(F.col("x.cluster").alias("k1"), F.col("y.cluster").alias("k2")).distinct())
    within = sizes.filter("single").select(F.col("cluster").alias("k1"), F.col("cluster").alias("k2"))
    near = stored(across.union(within), "cluster-pairs")
    order = lambda side: F.struct(f"{side}.cluster", f"{side}.single", f"{side}.block")

    def side(name: str, which: int):
        return F.transform(f"{name}.texts", lambda x: F.struct(F.lit(which).alias("side"), x["cid"].alias("cid"),
                                                               x["component"].alias("component"), x["text"].alias("text")))

    both = (near.alias("p").join(blocks.alias("x"), F.col("p.k1") == F.col("x.cluster"))
            .join(blocks.alias("y"), (F.col("p.k2") == F.col("y.cluster")) & fits("x", "y") & (order("x") <= order("y"))
                  & ((F.col("p.k1") != F.col("p.k2")) | F.col("x.single") | F.col("y.single")))
            .select(F.monotonically_increasing_id().alias("pair"), F.concat(side("x", 0), side("y", 1)).alias("texts"))
            .select("pair", F.inline("texts")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The texts of a pair of blocks come one after the other, a row each."""
        cache = _WordHash()

        def links(one: list, two: list) -> Iterator[tuple[int, int]]:
            joined: dict[int, int] = {}                 # components that a link of this pair of blocks has joined already

            def top(k: int) -> int:
                while k in joined:
                    k = joined[k]
                return k

            for u, ku, a in one:
                for v, kv, c in two:
                    if ku == kv or 100 * min(len(a), len(c)) < percent * max(len(a), len(c)) or top(ku) == top(kv):
                        continue
                    if (100 + percent) * len(a & c) >= percent * (len(a) + len(c)):
                        joined[top(ku)] = top(kv)
                        yield u, v

        def batch(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())],
                                              names=["u", "v"])

        last, sides = None, ([], [])
        for b in batches:
            found: list[tuple[int, int]] = []
            rows = (b.column(c).to_pylist() for c in ("pair", "side", "cid", "component"))
            for pair, which, cid, component, text in zip(*rows, b.column("text")):
                if pair != last:
                    found += links(*sides)
                    last, sides = pair, ([], [])
                sides[which].append((cid, component, set(shingle_hashes(text.as_py(), cache, shingle).tolist())))
            yield batch(found)
        yield batch(list(links(*sides)))

    return stored(both.mapInArrow(compare, "u long, v long"), "block-links")


def near_duplicates(docs: DataFrame, *, percent: int = 85, shingle: int = 3) -> DataFrame:
    """doc_id, rk, n_shingles, component_id and leads (the row's text is the one of its group that stays)."""
    rows = stored(sketches(docs, shingle=shingle), "sketches")
    classes = stored(
        rows.filter("n_shingles > 0").groupBy("f1", "f2")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rk")).alias("rep"),
             F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    bands = stored(classes.select("cid", "regs").mapInArrow(_band_rows(*banding(percent)), "cid long, band short, key long"), "bands")
    buckets = stored(bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "buckets")
    members = stored(bands.join(buckets, ["band", "key"]), "members")
    how = {"percent": percent, "shingle": shingle}

    # every class meets the most central class that leads a bucket of its own
    candidates = stored(members.select("cid").distinct(), "candidates")
    own = stored(_own(classes.select("cid", "regs").join(candidates, "cid", "left_semi").mapInArrow(
        _register_rows, "cid long, value int"), "value"), "own-registers")
    central = members.join(own, "cid", "left").withColumn("rank", F.struct(F.coalesce("own", F.lit(0)).alias("own"), "cid"))
    leads = stored(central.groupBy("band", "key").agg(F.min("rank").alias("lead")), "bucket-leads")
    pairs = (members.join(leads, ["band", "key"]).filter("cid != lead.cid")
             .groupBy(F.col("cid").alias("v")).agg(F.min("lead").alias("lead")).select(F.col("lead.cid").alias("u"), "v"))
    pairs = stored(pairs, "pairs")
    texts = _texts(docs, classes, candidates)
    links = confirmed(texts, classes, pairs, **how)

    # buckets that still hold several components
    labels = stored(roots(links), "components")         # a class has one lead, and that is more central than itself
    labelled = (members.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
                .withColumn("component", F.coalesce("component", "cid")))
    several = stored(labelled.groupBy("band", "key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
                     .filter("c1 != c2").select("band", "key"), "several")
    # a class that is still single belongs to the cluster of the class that led it
    led = (pairs.join(labels.withColumnRenamed("node", "u"), "u", "left")
           .select(F.col("v").alias("cid"), F.coalesce("component", "u").alias("led")))
    labelled = stored(labelled.join(several, ["band", "key"])
                      .join(labels.select(F.col("node").alias("cid"), F.lit(True).alias("linked")), "cid", "left")
                      .join(led, "cid", "left")
                      .withColumn("cluster", F.when(F.col("linked"), F.col("component")).otherwise(F.coalesce("led", "cid")))
                      .select("band", "key", "cid", "component", "cluster"), "open")
    # links between these components, then the components of components
    found = _block_links(texts, classes, labelled, **how)
    of = labelled.select("cid", "component").distinct()
    found = (found.join(of.select(F.col("cid").alias("u"), F.col("component").alias("cu")), "u")
             .join(of.select(F.col("cid").alias("v"), F.col("component").alias("cv")), "v").select(F.col("cu").alias("u"), F.col("cv").alias("v")))
    merged = stored(components(found), "merged").select(F.col("node").alias("component"), F.col("component").alias("whole"))

    grouped = stored(classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
                     .withColumn("component", F.coalesce("component", "cid")).join(merged, "component", "left")
                     .select("f1", "f2", "rep", F.coalesce("whole", "component").alias("component")), "grouped")
    smallest = stored(grouped.groupBy("component").agg(F.min("rep").alias("lead")), "leads")
    leads = stored(grouped.join(smallest, "component").select("f1", "f2", "lead"), "class-leads")
    none = F.col("n_shingles") == 0
    return (rows.drop("regs").join(leads, ["f1", "f2"], "left")
            .select("doc_id", "rk", "n_shingles",
                    F.when(none, F.col("doc_id")).otherwise(F.col("lead.doc_id")).alias("component_id"),
                    (none | (F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("rk") == F.col("lead.rk")))).alias("leads")))


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """One row of each group stays, columns as they were."""
    found = stored(near_duplicates(docs, **how).filter("leads").groupBy("doc_id", "rk").agg(
        F.count(F.lit(1)).alias("n")), "leading")
    again = stored(found.filter("n > 1"), "repeated-rows")

    def of(keys: DataFrame) -> DataFrame:
        return (packed(docs).alias("d").join(keys.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                                             & (F.col("d.rk") == F.col("k.rk")), "left_semi"))

    # of rows that repeat doc_id and text one stays; only those rows are compared
    once = of(found.filter("n = 1")).select("row.*")
    return once.union(of(again).dropDuplicates(["doc_id", "rk"]).select("row.*"))


def neardup_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
