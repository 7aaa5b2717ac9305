"""Search-service and document-service cases: several indices, fetch by id."""

from seekframe import Index, Mapping, Match, count, get_by_ids, search


def test_multi_index_search_keeps_index_name(spark):
    a = Index(spark.createDataFrame([("1", "hello world")], "_id string, title string"),
              Mapping().text("title"), name="index-a")
    b = Index(spark.createDataFrame([("1", "hello there"), ("2", "nothing")], "_id string, title string"),
              Mapping().text("title"), name="index-b")
    u = Index.union([a, b])
    hits = {(r["_index"], r["_id"]) for r in search(u, Match("title", "hello")).hits.collect()}
    assert hits == {("index-a", "1"), ("index-b", "1")}
    assert count(u) == 3


def test_get_by_ids_absent_gives_null(spark):
    ix = Index(spark.createDataFrame([("1", "a"), ("2", "b")], "_id string, title string"), name="t")
    ids = spark.createDataFrame([("2",), ("9",)], "k string")
    got = {r["_id"]: (r["found"], r["title"]) for r in get_by_ids(ix, ids, "k").collect()}
    assert got == {"2": (True, "b"), "9": (False, None)}
