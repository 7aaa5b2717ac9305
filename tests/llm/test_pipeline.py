"""Every stage of the corpus pipeline against a plain version of it, on its own input."""

from collections import Counter

import duckdb
from brute import near_duplicates

import corpus_pipeline as cp
from seekframe.llm.decontaminate import DECONTAMINATE_SQL
from seekframe.llm.mixing import mixing_sql
from seekframe.llm.tokens import encoding, load_ranks
from seekframe.llm.toxicity import fit_toxicity


def key(r):
    return r["doc_id"], r["text"]


def duck(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"{name}_frame", df.toArrow())
        con.sql(f"create view {name} as select * from {name}_frame")
    return [dict(zip(con.sql(sql).columns, r)) for r in con.sql(sql).fetchall()]


def test_stages(spark, sf, documents):
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_shards"]
    docs = documents.cache()
    model = fit_toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    got = cp.stored(stages["toxicity"](spark, docs, sf), "t1")
    assert got.columns == documents.columns
    assert sorted(map(key, got.collect())) == sorted(key(r) for r in docs.collect() if model.expected(r["text"]) < 0.5)

    docs, got = got, cp.stored(stages["near_duplicates"](spark, got, sf), "t2")
    assert got.columns == documents.columns
    want = near_duplicates([key(r) for r in docs.collect()], k=5, percent=80)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(i for i, (_, _, kept) in want.items() if kept)

    docs, got = got, cp.stored(stages["decontamination"](spark, got, sf), "t3")
    bad = {r["doc_id"] for r in duck(DECONTAMINATE_SQL, documents=docs, benchmark=spark.read.parquet(f"{sf}/benchmark.parquet"))
           if r["contaminated"]}
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in docs.collect() if r["doc_id"] not in bad)

    docs, got = got, cp.stored(stages["mixing"](spark, got, sf), "t4")
    assert got.columns == documents.columns
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r["doc_id"] for r in duck(mixing_sql(), documents=docs))

    docs, got = got, stages["token_shards"](spark, got, sf).collect()
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    texts = [r["text"] or "" for r in docs.collect()]
    enc = encoding(load_ranks())
    assert sum(r["n_tokens"] for r in got) == sum(len(enc.encode_ordinary(t)) + 1 for t in texts)


def test_run_is_the_stages(spark, sf):
    out = cp.run(spark, sf)
    assert out.columns == ["slot", "shard", "n_tokens", "ids_md5"] and out.count() > 0
    assert cp.ORACLE_SQL is None


def test_stages_take_odd_and_empty_tables(spark, odd, none, sf):
    for docs in (odd, none):
        for name, stage in cp.STAGES:
            out = cp.stored(stage(spark, docs, sf), "odd")
            if name != "token_shards":
                assert out.columns == docs.columns, name
            docs = out
