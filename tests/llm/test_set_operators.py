"""Near-duplicates, line dedup, decontamination, mixing, tokens, top-k: brute force, SQL, odd rows."""

import random

import duckdb
import numpy as np
import pytest
from brute import near_duplicates as brute_near
from brute import repeated_lines as brute_repeated_lines
from pyspark.sql import functions as F

from seekframe.llm import decontaminate as dc
from seekframe.llm.components import components
from seekframe.llm.linedup import LINEDUP_SQL, deduplicate_lines, linedup_digest, repeated_lines
from seekframe.llm.mixing import document_mix, mix_documents, mix_picks, mixing_digest, mixing_sql
from seekframe.llm.neardup import REGISTERS, drop_near_duplicates, estimate, neardup_digest, registers, shingle_hashes
from seekframe.llm.tokens import END, encoding, load_ranks, permute, read_shards, sequences, tokens_digest, unpermute, write_shards
from seekframe.llm.topk import TOPK_SQL, top_k, topk_digest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def duck(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"{name}_frame", df.toArrow())
        con.sql(f"create view {name} as select * from {name}_frame")
    return con.sql(sql)


def same(spark_df, sql, **tables):
    want = duck(sql, **tables)
    assert sorted(want.columns) == sorted(spark_df.columns)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert rows(spark_df.select(*want.columns)) == sorted(want.fetchall(), key=key)


# near-duplicates

def varied(seed: int, n: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(2000)]
    out = []
    for _ in range(n):
        base = rng.choices(vocab, k=rng.choice([3, 8, 30, 120]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(w) // 12])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(" ".join(w).upper() if rng.random() < .2 else " ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


def test_near_duplicates_against_brute_force(spark):
    docs = varied(1, 200) + [(9000, ""), (9001, None), (9002, " \n"), (9003, "one two"), (9004, "One  two"), (9005, "two one")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in neardup_digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_near(docs)


def test_a_chain_and_a_large_group_are_one_component(spark):
    rng = random.Random(3)
    base = [f"a{i}" for i in range(200)]
    docs, w = [], list(base)
    for i in range(120):                       # each near the last, the ends far apart
        w = list(w)
        w[rng.randrange(200)] = f"c{i}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(f"b{j}" for j in range(150)) + f" tail{i % 40}") for i in range(400)]
    got = {r["doc_id"]: r["component_id"] for r in
           neardup_digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)).collect()}
    assert {got[i] for i, _ in docs[:120]} == {0} and {got[i] for i, _ in docs[120:]} == {1000}


def test_estimate_follows_jaccard():
    cache = type("H", (dict,), {"__missing__": lambda s, k: s.setdefault(k, hash(k) & (2**64 - 1))})()
    rng = np.random.default_rng(0)
    from seekframe.llm.neardup import collision_table
    acc = collision_table()
    for j in (0.0, 0.5, 0.9):
        a = rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
        k = int(round(4000 * 2 * j / (1 + j)))
        b = np.concatenate([a[:k], rng.integers(0, 2**63, 4000 - k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])
        got, used = estimate(registers(np.sort(a)), registers(np.sort(b)), 4000, 4000, acc)
        assert used == REGISTERS and abs(got - j) < 0.15
    assert len(shingle_hashes("a b c a b c", cache)) == 3 and len(shingle_hashes(None, cache)) == 0


def test_near_duplicates_odd_rows(spark, odd, none):
    got = neardup_digest(odd).collect()
    assert len(got) == 11
    by = {(r["doc_id"], r["n_shingles"]): r for r in got}
    assert by[(1, 0)]["component_id"] == 1 and by[(2, 0)]["kept"] and by[(7, 0)]["kept"]
    assert by[(None, 1)]["component_id"] is None and by[(None, 1)]["kept"]
    assert by[(8, 10)]["component_id"] == 5 and not by[(8, 10)]["kept"] and by[(10, 11)]["component_id"] == 5
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(x or -1 for (x,) in kept.select("doc_id").collect()) == [-1, 1, 2, 4, 5, 5, 7, 9]
    assert neardup_digest(none).count() == 0


def test_bands_meet_pairs_at_the_threshold():
    import numpy as np
    import pyarrow as pa

    from seekframe.llm.neardup import REGISTERS, _band_rows, banding
    assert banding(85) == (7, 36) and banding(80) == (5, 51) and banding(100) == (REGISTERS, 1)
    for percent in range(10, 101):
        r, n = banding(percent)
        assert (1 - (percent / 100) ** r) ** n < 1e-6 and r * n <= REGISTERS
    rng = np.random.default_rng(3)
    a = rng.integers(0, 60_000, (20_000, REGISTERS)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 60_000, a.shape)).astype(np.uint16)

    def missed(r, n):
        keys = []
        for x in (a, b):
            batch = pa.RecordBatch.from_arrays([pa.array(range(len(x))), pa.array([v.tobytes() for v in x], pa.binary())],
                                               names=["cid", "regs"])
            keys.append(np.concatenate([y.column("key").to_numpy() for y in _band_rows(r, n)([batch])]).reshape(-1, n))
        return int((~(keys[0] == keys[1]).any(1)).sum())

    assert missed(7, 36) > 0 and missed(*banding(80)) == 0        # 7 rows were taken at every threshold


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(5, 5), (None, 1), (1000, 1001), (1001, 1000)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: find(i) for i in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# line dedup

def test_line_dedup_against_sql(spark, documents):
    rng = random.Random(4)
    pool = [f"line {i} " + "w " * rng.choice([1, 5, 60]) for i in range(12)]
    docs = spark.createDataFrame([(i, "\n".join(rng.choices(pool + ["", "  "], k=rng.randint(0, 14)))) for i in range(60)]
                                 + [(100, None), (101, ""), (102, "x" * 50_000)], "doc_id long, text string")
    for frame in (docs, documents):
        same(linedup_digest(frame), LINEDUP_SQL, documents=frame)


def test_line_dedup_keeps_first_copies_and_columns(spark, odd, none):
    block = "\n".join(f"line number {i}" for i in range(5))
    docs = spark.createDataFrame([(1, block), (2, "head\n" + block + "\n\ntail"), (2, "other"), (3, block[:30])], "doc_id long, text string")
    got = {(r["doc_id"], r["text"], r["n_deleted"], r["n_runs"]) for r in deduplicate_lines(docs).collect()}
    assert got == {(1, block, 0, 0), (2, "head\n\ntail", 5, 1), (2, "other", 0, 0), (3, block[:30], 0, 0)}
    out = deduplicate_lines(odd)
    assert out.columns == odd.columns + ["n_lines", "n_deleted", "n_runs"] and out.count() == 11
    assert linedup_digest(none).count() == 0
    with pytest.raises(ValueError):
        deduplicate_lines(odd, min_lines=3)


def test_runs_that_touch_stay_two(spark):
    a, b = ([f"{k} line {i} of a passage" for i in range(5)] for k in "ab")
    docs = spark.createDataFrame([(1, "\n".join(a)), (2, "\n".join(b)), (3, "\n".join(a + b)), (4, "\n".join(a + ["own"] + b)),
                                  (5, "\n".join(a + b)), (6, "\n".join(a[:4] + b[1:]))], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_deleted"], r["n_runs"]) for r in linedup_digest(docs).collect()}
    # 5 repeats all of 3, which is one run
    assert got == {1: (0, 0), 2: (0, 0), 3: (10, 2), 4: (10, 2), 5: (10, 1), 6: (8, 2)}
    same(linedup_digest(docs), LINEDUP_SQL, documents=docs)


def test_line_dedup_of_runs_of_every_length(spark, documents):
    three = "\n".join(f"{x} " + "w " * 19 for x in "abc")               # 60 words, 40 in each pair of lines
    docs = spark.createDataFrame([(1, "x\n" + three), (2, three + "\ny"), (3, three[:85])], "doc_id long, text string")
    assert {r["doc_id"]: r["n_deleted"] for r in linedup_digest(docs).collect()} == {1: 0, 2: 3, 3: 0}
    rng = random.Random(6)
    pool = [f"line {i} " + "w " * rng.choice([1, 8, 15, 30]) for i in range(9)]
    made = spark.createDataFrame([(i, "\n".join(rng.choices(pool + [""], k=rng.randint(0, 14)))) for i in range(60)],
                                 "doc_id long, text string")
    for frame, min_lines in ((made, 4), (made, 8), (documents, 4)):
        rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
        got = {(r["doc_id"], r["i"]) for r in repeated_lines(frame, min_lines=min_lines).collect()}
        assert got == brute_repeated_lines(rows, min_lines) and got


# decontamination

def test_decontamination_against_sql(spark, odd):
    rng = random.Random(8)
    vocab = [f"t{i}" for i in range(40)] + ["the"] * 30
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 4, 10, 11, 25])))) for i in range(30)]
    items += [(100, None), (101, ""), (None, items[3][1]), (7, items[7][1]), (8, "Second text of item eight"), (102, "the " * 15)]
    docs = []
    for i in range(80):
        w = rng.choices(vocab, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            t = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(t) + 1)
            w[rng.randrange(len(w) + 1):0] = t[a:a + rng.randint(1, 20)]
        docs.append((i, rng.choice([" ", "\n", ", ", "-"]).join(w).title()))
    docs = spark.createDataFrame(docs + [(200, None), (201, ""), (None, items[0][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("rk", F.lit(2))
    for d in (docs, odd.dropDuplicates(["doc_id", "text"])):
        same(dc.decontaminate_digest(d, bench), dc.DECONTAMINATE_SQL, documents=d.select("doc_id", "text"),
             benchmark=bench.select("item_id", "text"))


def test_decontamination_blocks_and_empty_tables(spark, odd, none):
    line = "one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([(1, line), (2, "one word too many")], "item_id long, text string")
    a = rows(dc.find_matches(odd, bench)[0])
    assert a == rows(dc.find_matches(odd, bench, term_block=3)[0]) and len(a) > 0
    kept = dc.decontaminate(odd, bench)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 4, 5, 7, 9]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminate_digest(odd, empty).filter("contaminated").count() == 0
    assert dc.decontaminate_digest(none, bench).count() == 0


# mixing

def test_mixing_against_sql(spark, documents):
    same(mixing_digest(documents), mixing_sql(), documents=documents)


def test_mixing_odd_rows_and_budgets(spark, odd, none):
    same(mixing_digest(odd.dropDuplicates(["doc_id"])), mixing_sql(), documents=odd.dropDuplicates(["doc_id"]))
    out = mix_documents(odd, document_mix())
    assert out.columns == odd.columns
    assert mixing_digest(none).count() == 0 and mix_documents(none, document_mix()).count() == 0
    from seekframe.llm.mixing import Mix, leaf_budgets
    sizes = spark.createDataFrame([("x", "a", 10), ("x", "b", 1000), ("y", "c", 500), ("z", "d", 0)], "d string, s string, tokens long")
    mix = Mix((("d", F.col("d")), ("s", F.col("s"))), {"d": {"y": 0.0}}, budget=0.5, max_epochs=2)
    got = {(r["d"], r["s"]): r["budget"] for r in leaf_budgets(sizes, mix).collect()}
    # a's shortage goes to its sibling b; y has no weight, z no tokens, so x gets the whole budget of 755
    assert got == {("x", "a"): 20.0, ("x", "b"): 735.0, ("y", "c"): 0.0, ("z", "d"): 0.0}


def test_repeated_rows_are_taken_together(spark):
    docs = spark.createDataFrame([(i % 10, f"text number {i % 10}", "en", "src1", 5) for i in range(40)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    picks = mix_picks(docs, document_mix()).groupBy("doc_id", "epoch").count().collect()
    assert all(r["count"] == 4 for r in picks)
    assert mix_documents(docs, document_mix()).count() == sum(r["count"] for r in picks)


# tokens

def test_permutation_is_one():
    for n in (1, 2, 3, 10, 1000, 4097):
        p = permute(np.arange(n), n, 5)
        assert sorted(p) == list(range(n)) and (unpermute(p, n, 5) == np.arange(n)).all()
    assert (permute(np.arange(1000), 1000, 5) != permute(np.arange(1000), 1000, 6)).any()


def test_shards_round_trip_and_resume(spark, documents, odd, tmp_path):
    docs = documents.select("text").union(odd.select("text")).union(
        spark.createDataFrame([("<|endoftext|> is text",)], "text string"))
    how = {"length": 128, "per_shard": 50}
    path = f"file://{tmp_path}/shards"
    n = write_shards(docs.repartition(3), path, key=11, **how)
    got = read_shards(spark, path, **how).collect()
    assert sorted(r["slot"] for r in got) == list(range(n))
    order = unpermute(np.array([r["slot"] for r in got]), n, 11)
    ids = np.concatenate([np.frombuffer(r["ids"], "<u2") for _, r in sorted(zip(order, got), key=lambda x: x[0])])
    enc = encoding(load_ranks())
    texts = [enc.decode(x[:-1].tolist()) for x in np.split(ids, np.flatnonzero(ids == END) + 1)[:-1]]
    assert sorted(texts) == sorted(r["text"] or "" for r in docs.collect())
    later = read_shards(spark, path, start=n // 2, **how)
    assert sorted(r["slot"] for r in later.collect()) == list(range(n // 2, n))
    sizes = spark.read.format("binaryFile").load(path).select("shard", "length").collect()
    assert all(r["length"] == (4 + 2 * 128 + 1) * min(50, n - 50 * r["shard"]) for r in sizes)


def test_tokens_empty_table(none, odd):
    assert tokens_digest(none).count() == 0 and sequences(none).count() == 0
    assert tokens_digest(odd).count() > 0


# top-k

def test_top_k_against_sql(spark):
    rng = random.Random(6)
    vec = [(i, [rng.choice([-1.0, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(6)], 0) for i in range(700)]
    vec += [(700, None, 0), (701, [None] * 6, 0), (702, [float("nan")] * 6, 0), (703, [float("inf")] * 6, 1), (800, [0.0] * 6, 1),
            (900, [], 1), (-100, [0.5] * 6, 1), (None, [0.5] * 6, 1)] + [(1000 + i, [0.5] * 6, 1) for i in range(30)]
    e = spark.createDataFrame(vec, "vec_id long, embedding array<float>, label int")
    same(topk_digest(e), TOPK_SQL, embeddings=e)
    few = spark.createDataFrame(vec[:4], "vec_id long, embedding array<float>, label int")
    assert topk_digest(few).count() == 3
    assert topk_digest(e.limit(0)).count() == 0


def test_top_k_blocks_agree(spark):
    rng = random.Random(2)
    e = spark.createDataFrame([(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(500)]
                              + [(7, [0.5] * 8), (900, [0.1, 0.2]), (903, [0.3, 0.1])], "vec_id long, embedding array<float>")
    one = rows(top_k(e, F.col("vec_id") % 7 == 0, k=5))
    for block in (60, 13):
        assert rows(top_k(e, F.col("vec_id") % 7 == 0, k=5, block=block)) == one


def test_a_floor_stops_the_walk_early_and_loses_nothing():
    from seekframe.llm.topk import threshold_search
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(3000, 6)) * 100)
    ids = np.arange(3000)
    lists = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
    for _ in range(20):
        q = np.floor(rng.normal(size=6) * 100)
        full = sorted(zip(-(x @ q), ids))[:10]
        floor = -full[4][0]
        got_id, got = threshold_search(ids, x, lists, q, -1, 10, floor)
        assert [(-s, i) for i, s in zip(got_id, got) if s >= floor] == [r for r in full if -r[0] >= floor]
