"""Clauses from tables, page and total in one run, bucketed tables."""

import pytest
from pyspark.sql import functions as F

from seekframe import Bool, Index, Mapping, Match, MatchAll, MatchNone, Term, Terms, each, matching, search
from seekframe.operators.batch import each_items
from seekframe.operators.postings import build_tables
from seekframe.session import checkpoint_dir
from seekframe.sources.tables import write_bucketed


@pytest.fixture(scope="module")
def ix(spark):
    rows = [(1, "red fox", "A", ["x", "y"]), (2, "blue fox", "b", ["y"]), (3, None, None, None), (4, "red red hen", "C", [])]
    m = Mapping().long("id").text("body").keyword("kind", normalizer="lowercase").keyword("tags")
    return Index(spark.createDataFrame(rows, "id long, body string, kind string, tags array<string>"), m, id_col="id")


def ids(df):
    return sorted(r["_id"] for r in df.collect())


def test_terms_from_a_table(spark, ix):
    def values(*xs, kind="string"):
        return spark.createDataFrame([(x,) for x in xs], f"v {kind}")

    assert ids(matching(ix, Terms("id", values(1, 4, 9, None, kind="long")))) == ["1", "4"]
    assert ids(matching(ix, Terms("kind", values("a", "B", None)))) == ["1", "2"]
    assert ids(matching(ix, Terms("body", values("red", "none")))) == ["1", "4"]
    assert ids(matching(ix, Terms("tags", values("y", "z")))) == ["1", "2"]
    assert ids(matching(ix, Bool(must_not=[Terms("kind", values("a"))]))) == ["2", "3", "4"]
    either = Bool(should=[Terms("id", values(2, kind="int"), boost=3.0), Term("body", "hen")])
    assert ids(matching(ix, either)) == ["2", "4"] and matching(ix, either).filter("_id = 2").first()["_score"] == 3.0
    assert ids(matching(ix, Terms("id", values(kind="long")))) == []
    many = spark.range(100_000).select((F.col("id") * 2).alias("v"))
    assert ids(matching(ix, Terms("id", many))) == ["2", "4"]
    plan = matching(ix, Terms("id", many), with_score=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_items_from_a_table_score_like_clauses(spark, ix):
    items = spark.createDataFrame([("red", 2.0), ("fox hen", 1.0), ("red", 1.0), (None, 5.0), ("none", 1.0)], "word string, boost double")
    clauses = Bool(should=[Match("body", "red", boost=2.0), Match("body", "fox hen"), Match("body", "red"), Match("body", "none")])
    want = {r["_id"]: r["_score"] for r in matching(ix, clauses).collect()}
    stored = ix.with_df(ix.df)
    stored.stats = build_tables(ix, ["body"], positions=False)
    for index in (ix, stored):
        got = {r["_id"]: r["_score"] for r in each_items(index, items, "word", "body", boost_col="boost").collect()}
        assert got == pytest.approx(want, abs=2e-6) and len(got) == 3
    kinds = spark.createDataFrame([("A",), ("c",), ("zz",)], "k string")
    want = {r["_id"]: r["_score"] for r in matching(ix, Bool(should=each(["A", "c", "zz"], lambda k: Term("kind", k)))).collect()}
    assert {r["_id"]: r["_score"] for r in each_items(ix, kinds, "k", "kind").collect()} == pytest.approx(want, abs=2e-6)
    numbers = spark.createDataFrame([(1,), (4,), (4,)], "n int")
    assert {r["_id"]: r["_score"] for r in each_items(ix, numbers, "n", "id").collect()} == {"1": 1.0, "4": 2.0}


def test_page_and_total_in_one_run(spark, ix):
    sc = spark.sparkContext
    res = search(ix, MatchAll(), sort=[("id", "desc")], size=3)
    sc.setJobGroup("page", "page")
    page = res.page()
    assert len(sc.statusTracker().getJobIdsForGroup("page")) == 1
    sc.setJobGroup("other", "other")
    assert [r["_id"] for r in page.rows] == ["4", "3", "2"] and page.total == 4 and not page.is_empty
    rest = search(ix, MatchAll(), sort=[("id", "desc")], size=3, cursor=page.cursor).page()
    assert [r["_id"] for r in rest.rows] == ["1"] and rest.total == 4
    assert page.cursor == res.cursor and page.total == res.total
    for nothing in (MatchNone(), Term("kind", "none")):
        empty = search(ix, nothing).page()
        assert empty.is_empty and empty.total == 0 and empty.cursor is None


def test_bucketed_tables_join_without_exchange(spark):
    left = spark.range(1000).select(F.col("id").cast("string").alias("_id"), F.col("id").alias("x"))
    a = write_bucketed(left, "bucketed_a", "_id", 8, f"{checkpoint_dir(spark)}/bucketed_a")
    b = write_bucketed(left.filter("x % 3 = 0").withColumnRenamed("x", "y"), "bucketed_b", "_id", 8, f"{checkpoint_dir(spark)}/bucketed_b")
    joined = a.hint("merge").join(b, "_id").groupBy("_id").agg(F.sum("y").alias("y"))
    assert joined.count() == 334
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert len(a.inputFiles()) == 8
    for t in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE {t}")


def test_dotted_source_names_keep_their_structs(spark):
    rows = [("1", (1, "x", (True,)), [(1, "p"), (2, "q")], 9), ("2", None, None, 8)]
    df = spark.createDataFrame(rows, "_id string, meta struct<k:int,s:string,in:struct<deep:boolean>>, items array<struct<n:int,t:string>>, z int")
    ix = Index(df)

    def first(source):
        got = search(ix, None, sort=[("_id", "asc")], source=source).hits.drop("_index", "_id", "_score", "_sort")
        rows = [r.asDict(recursive=True) for r in got.collect()]
        assert len(rows) == 2 and all(v is None or k == "z" for k, v in rows[1].items())
        return rows[0]

    assert first(["meta.k", "items.t"]) == {"meta": {"k": 1}, "items": [{"t": "p"}, {"t": "q"}]}
    assert first(["z", "meta.in"]) == {"z": 9, "meta": {"in": {"deep": True}}}
    assert first(["meta.*"]) == {"meta": {"k": 1, "s": "x", "in": {"deep": True}}}
    assert first({"excludes": ["meta.in.deep", "items"]}) == {"meta": {"k": 1, "s": "x"}, "z": 9}
    assert first({"includes": ["meta", "z"], "excludes": ["meta.s"]}) == {"meta": {"k": 1, "in": {"deep": True}}, "z": 9}
    with pytest.raises(ValueError, match="unknown source field"):
        search(ix, None, source=["nothing"])
