"""Batch search and postings against a brute-force BM25 on a small fixture."""

import math
from collections import Counter

from seekframe import Index, Match, Mapping, matching, query_terms
from seekframe.functions.scoring import bm25_py
from seekframe.operators.batch import batch_candidates, batch_search
from seekframe.operators.postings import build_postings, build_tables, refresh_postings, refresh_tables, scan_tables, query_term_table

TEXTS = ["the cat sat on the mat", "a dog and a cat", "the dog barked", "birds fly", "cat cat cat"]
QUERIES = ["cat mat", "dog", "fly birds cat", "zebra"]


def brute(k):
    toks = [query_terms(t) and __import__("regex").findall(r"[\p{L}\p{N}\p{M}_]+", t.lower()) for t in TEXTS]
    n = len(toks)
    avg = sum(len(t) for t in toks) / n
    df = Counter(w for t in toks for w in set(t))
    out = {}
    for qi, q in enumerate(QUERIES):
        scored = []
        for di, t in enumerate(toks):
            tf = Counter(t)
            terms = query_terms(q)
            if not any(w in tf for w in terms):
                continue
            s = sum(bm25_py(tf[w], len(t), n, df[w], avg) for w in terms if w in tf)
            scored.append((-round(s, 6), str(di)))
        out[qi] = [d for _, d in sorted(scored)[:k]]
    return out


def index(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, body string")
    return Index(df, Mapping().long("id").text("body"), id_col="id")


def test_batch_search_equals_brute_force(spark):
    ix = index(spark)
    tables = build_tables(ix, ["body"])
    qs = spark.createDataFrame([(i, q) for i, q in enumerate(QUERIES)], "qid long, q string")
    res = batch_search(tables, qs, "q", "qid", "body", k=2).collect()
    got = {}
    for r in sorted(res, key=lambda r: (r["query_id"], r["rank"] or 0)):
        got.setdefault(r["query_id"], []).append(r["_id"])
    assert got == {k: v or [None] for k, v in brute(2).items()}      # a query without hits is a row of nulls


def test_scan_and_postings_scores_agree(spark):
    ix = index(spark)
    scan = {r["_id"]: r["_score"] for r in matching(ix, Match("body", "cat dog")).collect()}
    tables = build_tables(ix, ["body"])
    qs = spark.createDataFrame([(0, "cat dog")], "qid long, q string")
    post = {r["_id"]: r["_score"] for r in batch_search(tables, qs, "q", "qid", "body", k=10).collect()}
    assert scan == post
    assert all(math.isfinite(v) for v in scan.values())


def test_refresh_equals_rebuild(spark):
    ix = index(spark)
    old = build_postings(ix, ["body"], positions=True)
    from pyspark.sql import functions as F
    new_df = ix.df.withColumn("body", F.when(F.col("_id") == "1", F.lit("new words here")).otherwise(F.col("body")))
    new_ix = ix.with_df(new_df)
    refreshed = refresh_postings(old, new_ix, new_df.filter(F.col("_id") == "1").select("_id"), ["body"])
    rebuilt = build_postings(new_ix, ["body"], positions=True)
    key = lambda r: (r["term"], r["_id"], r["tf"], tuple(r["positions"]))
    assert sorted(map(key, refreshed.collect())) == sorted(map(key, rebuilt.collect()))


def test_written_tables_and_stored_stats(spark):
    import tempfile

    from seekframe.operators.postings import write_tables

    ix = index(spark)
    path = tempfile.mkdtemp(prefix="seekframe-tables-")
    tables = write_tables(build_tables(ix, ["body"], positions=True), path)
    assert tables.postings.count() == build_postings(ix, ["body"]).count()
    scan = {r["_id"]: r["_score"] for r in matching(ix, Match("body", "cat dog")).collect()}
    stored = Index(ix.df, ix.mapping, id_col="id", stats=tables)
    from_stats = {r["_id"]: r["_score"] for r in matching(stored, Match("body", "cat dog")).collect()}
    assert scan == from_stats


def random_index(spark, n=400, seed=3):
    """Common words in nearly every text, rare ones in few."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(6)], [f"r{i}" for i in range(150)]
    rows = []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(1, 20)) + rng.choices(rare, k=rng.randint(0, 4))
        rng.shuffle(words)
        rows.append((i, " ".join(words) if i % 50 else None, rng.choice(["en", "fr", None])))
    ix = Index(spark.createDataFrame(rows, "id long, body string, lang string"), Mapping().long("id").text("body").keyword("lang"), id_col="id")
    queries = [(q, " ".join(rng.choices(common, k=rng.randint(0, 5)) + rng.choices(rare, k=rng.randint(0, 3))), rng.choice(["en", "fr", None]))
               for q in range(60)] + [(60, "", None), (61, "unknown words", "en"), (62, "c0", None), (63, None, None)]
    return ix, spark.createDataFrame(queries, "qid long, q string, lang string"), F


def full_scores(ix, tables, queries):
    """Every document that shares a term with a query, scored in plain Python."""
    docs = {r["_id"]: (r["body"] or "").split() for r in ix.df.select("_id", "body").collect()}
    n = ix.df.filter("body is not null").count()
    avg = sum(map(len, docs.values())) / n
    df = Counter(w for t in docs.values() for w in set(t))
    out = {}
    for r in queries.collect():
        terms = set((r["q"] or "").split())
        out[r["qid"]] = {i: round(sum(bm25_py(t.count(w), len(t), n, df[w], avg) for w in terms if w in t), 6)
                         for i, t in docs.items() if terms & set(t)}
    return out


def test_pruned_batch_gives_the_rows_of_full_scoring(spark):
    ix, queries, F = random_index(spark)
    scanned = scan_tables(ix, "body", query_term_table(queries, "q", "qid", "body"))
    stored = build_tables(ix, ["body"], positions=False)
    full = full_scores(ix, stored, queries)
    for tables, seeds in ((stored, 1), (scanned, 16)):
        got = {}
        for r in batch_search(tables, queries, "q", "qid", "body", k=5, seeds=seeds).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["_id"], r["_score"]))
        for qid, scores in full.items():
            want = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5]
            assert [(i, s) for _, i, s in sorted(got[qid], key=lambda x: x[0] or 0)] == (want or [(None, None)])
    pairs = sum(map(len, full.values()))
    assert batch_candidates(stored, queries, "q", "qid", "body", k=5).count() < 0.35 * pairs


def test_batch_conditions_by_query(spark):
    ix, queries, F = random_index(spark, seed=4)
    tables = build_tables(ix, ["body"], positions=False)
    lang = {r["_id"]: r["lang"] for r in ix.df.select("_id", "lang").collect()}
    full = full_scores(ix, tables, queries)
    # a choice of two: the query's language, or English for every fourth query without one
    wanted = F.coalesce("lang", F.when(F.col("qid") % 4 == 0, "en"))
    got = {}
    for r in batch_search(tables, queries, "q", "qid", "body", k=4, where={"lang": wanted}, documents=ix.df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["_id"], r["_score"]))
    for r in queries.collect():
        ask = r["lang"] or ("en" if r["qid"] % 4 == 0 else None)
        hits = {i: s for i, s in full[r["qid"]].items() if ask is None or lang[i] == ask}
        want = sorted(hits.items(), key=lambda x: (-x[1], x[0]))[:4]
        assert [(i, s) for _, i, s in sorted(got[r["qid"]], key=lambda x: x[0] or 0)] == (want or [(None, None)])


def test_refreshed_statistics_equal_rebuilt_ones(spark):
    ix, _, F = random_index(spark, seed=5)
    tables = build_tables(ix, ["body"])
    i = F.col("id")
    new = ix.with_df(ix.df.filter(i % 7 != 0).withColumn("body", F.when(i % 5 == 0, F.lit("new words r1 r1")).when(i == 3, None).otherwise(F.col("body")))
                     .unionByName(ix.df.filter("id < 4").withColumn("_id", F.concat("_id", F.lit("x")))))
    changed = new.df.filter((i % 5 == 0) | (i == 3)).select("_id").union(ix.df.filter(i % 7 == 0).select("_id")).union(
        new.df.filter(F.col("_id").endswith("x")).select("_id"))
    got, want = refresh_tables(tables, ix, new, changed), build_tables(new, ["body"])
    for name, cols in (("term_stats", ["field", "term", "df"]), ("field_stats", ["field", "n", "sum_dl"]), ("postings", ["term", "_id", "tf", "dl"])):
        a, b = (sorted(map(tuple, getattr(t, name).select(*cols).collect())) for t in (got, want))
        assert a == b
    loose = got.term_stats.alias("g").join(want.term_stats.alias("w"), ["field", "term"]).filter("g.max_tf < w.max_tf or g.min_dl_per_tf > w.min_dl_per_tf")
    assert loose.count() == 0


def counting(spark, kind="string"):
    """A function that hands on its argument, and how often it was called."""
    from pyspark.sql import functions as F

    calls = spark.sparkContext.accumulator(0)
    return F.udf(lambda x: (calls.add(1), x)[1], kind), calls


def test_written_tables_build_postings_once(spark):
    import tempfile

    from seekframe.operators.postings import write_tables

    ix = index(spark)
    seen, calls = counting(spark)
    counted = ix.with_df(ix.df.withColumn("body", seen("body")))
    tables = write_tables(build_tables(counted, ["body"]), tempfile.mkdtemp(prefix="seekframe-tables-"))
    assert calls.value == 2 * len(TEXTS)                # postings, and the statistics of the field
    want = build_tables(ix, ["body"]).term_stats
    assert sorted(map(tuple, tables.term_stats.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_postings_are_sorted_by_batch_and_whole(spark):
    """Equal ids, documents without words, one document longer than the others together, several batches."""
    import regex

    texts = [("b", "x y x"), ("a", "y"), ("a", "y y é"), ("c", None), ("d", ""), ("e", " ".join(f"w{i % 7}" for i in range(3000))), (None, "x")]
    df = spark.createDataFrame(texts * 3, "_id string, body string").coalesce(1)
    ix = Index(df, Mapping().text("body"))
    want = sorted((t, i or "", len(ws), tuple(at)) for i, x in texts * 3 for ws in [regex.findall(r"\w+", x or "")]
                  for t in set(ws) for at in [[k for k, w in enumerate(ws) if w == t]])
    for size in (4, 10000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = [(r["term"], r["_id"] or "", r["dl"], tuple(r["positions"]), r["tf"]) for r in build_postings(ix, ["body"]).collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted(x[:4] for x in got) == want and all(x[4] == len(x[3]) for x in got)
    assert [x[0] for x in got] == sorted(x[0] for x in got)


def test_refresh_finds_the_changed_documents_once(spark):
    ix = index(spark)
    tables = build_tables(ix, ["body"])
    seen, calls = counting(spark)
    changed = ix.df.filter("id < 2").select(seen("_id").alias("_id"))
    out = refresh_tables(tables, ix, ix.with_df(ix.df.filter("id <> 1")), changed)
    assert {r["term"]: r["df"] for r in out.term_stats.collect()}["cat"] == 2
    assert [tuple(r) for r in out.field_stats.select("n", "sum_dl").collect()] == [(4, 14)]
    assert calls.value == 2


def test_narrow_conditions_leave_few_candidates(spark):
    """Words that are rare only among the documents that pass: their floors and bounds count these alone."""
    import random

    rng = random.Random(6)
    common, words = [f"c{j}" for j in range(6)], [f"e{j}" for j in range(12)]
    rows = []
    for i in range(600):
        # every fifth text is French; the words that English texts hold are rare there
        own = rng.choices(words, k=4) if i % 5 else [words[i // 50]] if i % 50 == 0 else []
        rows.append((i, " ".join(common + own), "en" if i % 5 else "fr"))
    rows += [(7, "e1 c0 c0", "fr"), (7, "e2", None)]                # one document in three rows, which passes by one
    ix = Index(spark.createDataFrame(rows, "id long, body string, lang string"), Mapping().long("id").text("body").keyword("lang"), id_col="id")
    asked = [(q, " ".join(common + words[q:q + 6]), "fr" if q < 4 else "de") for q in range(5)] + [(None, "e1", "fr"), (9, "c1 e1", None)]
    queries = spark.createDataFrame(asked, "qid long, q string, lang string")
    tables = build_tables(ix, ["body"], positions=False)
    docs = {}
    for i, text, lang in rows:
        docs.setdefault(str(i), []).append((text.split(), lang))
    n, avg = len(rows), sum(len(t.split()) for _, t, _ in rows) / len(rows)
    df = Counter(w for _, t, _ in rows for w in set(t.split()))
    got, pairs = {}, 0
    args = (tables, queries, "q", "qid", "body")
    where = {"where": {"lang": queries["lang"]}, "documents": ix.df}
    for r in batch_search(*args, k=3, **where).collect():
        got.setdefault(r["query_id"], []).append((r["rank"] or 0, r["_id"], r["_score"]))
    for qid, text, lang in asked:
        full = {i: round(sum(bm25_py(t.count(w), len(t), n, df[w], avg) for t, _ in parts for w in set(text.split()) if w in t), 6)
                for i, parts in docs.items() if any(set(t) & set(text.split()) for t, _ in parts) and (lang is None or lang in [x for _, x in parts])}
        pairs += len(full) if qid in range(4) else 0
        want = sorted(full.items(), key=lambda x: (-x[1], x[0]))[:3] if qid is not None else []
        assert [(i, s) for _, i, s in sorted(got[qid])] == (want or [(None, None)])
    assert batch_candidates(*args, k=3, seeds=4, **where).filter("query_id < 4").count() < 0.2 * pairs
