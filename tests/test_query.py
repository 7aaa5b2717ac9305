"""Query semantics, modelled on the reference's integration cases (2-4 documents each)."""

import pytest
from pyspark.sql import functions as F

from seekframe import (Bool, Exists, Highlight, Match, MatchAll, MultiMatch, Range, Term, Terms, Wildcard,
                       Index, Mapping, count, each, from_dict, get_highlight_first, get_highlight_sentence, search, when,
                       when_else)
from seekframe.operators.clauses import merge_multi_match, resolve_msm


def ids(res):
    return [r["_id"] for r in res.hits.collect()]


def test_match_all_when_no_query(docs):
    assert sorted(ids(search(docs, None))) == ["1", "2", "3", "4"]


def test_term_keyword_and_exact_subfield(docs):
    assert sorted(ids(search(docs, Term("type", "TEST_A")))) == ["1", "3"]
    assert ids(search(docs, Term("title.exact", "exact match title"))) == ["3"]
    # term on text compares to single (lower-cased) tokens
    assert ids(search(docs, Term("title", "exact"))) == ["3"]
    assert ids(search(docs, Term("title", "Exact"))) == []


def test_match_or_and(docs):
    assert sorted(ids(search(docs, Match("title", "hello world")))) == ["1", "2"]
    assert sorted(ids(search(docs, Match("title", "hello title")))) == ["1", "2", "3", "4"]
    assert ids(search(docs, Match("title", "exact title", operator="and"))) == ["3"]


def test_wildcard_text_tokens_vs_keyword(docs):
    assert sorted(ids(search(docs, Wildcard("title", "hel*")))) == ["1", "2"]
    assert ids(search(docs, Wildcard("title.exact", "exact*"))) == ["3"]
    assert ids(search(docs, Wildcard("type", "TEST_?"))) != []


def test_range_date_only_upper_bound_covers_day(docs):
    q = Range("createdAt", gte="2025-01-01", lte="2025-01-15")
    assert sorted(ids(search(docs, q))) == ["1", "2"]
    q = Range("createdAt", gt="2025-01-15")
    assert sorted(ids(search(docs, q))) == ["3", "4"]


def test_exists_and_must_not_keeps_nulls(docs):
    assert sorted(ids(search(docs, Exists("body")))) == ["1", "2", "3"]
    assert sorted(ids(search(docs, Bool(must_not=[Term("body", "body")])))) == ["3", "4"]


def test_bool_rules(docs):
    assert len(ids(search(docs, Bool()))) == 4
    assert len(ids(search(docs, Bool(filter=[])))) == 4
    # should only: at least one must match
    assert sorted(ids(search(docs, Bool(should=[Term("type", "TEST_B")])))) == ["2", "4"]
    # should beside filter only boosts
    assert len(ids(search(docs, Bool(filter=[MatchAll()], should=[Term("type", "TEST_B")])))) == 4
    # pure negative: complement, or nothing when adjust_pure_negative is false
    assert sorted(ids(search(docs, Bool(must_not=[Term("type", "TEST_A")])))) == ["2", "4"]
    assert ids(search(docs, Bool(must_not=[Term("type", "TEST_A")], adjust_pure_negative=False))) == []
    q = Bool(should=[Match("title", "hello"), Match("title", "world"), Match("title", "title")],
             minimum_should_match=2)
    assert sorted(ids(search(docs, q))) == ["1", "2"]


def test_minimum_should_match_strings():
    assert resolve_msm("75%", 4) == 3
    assert resolve_msm("-1", 4) == 3
    assert resolve_msm("-25%", 4) == 3
    assert resolve_msm(2, 4) == 2


def test_conditional_builders(docs):
    q = Bool(filter=[when(False, Term("type", "TEST_A"))])
    assert len(ids(search(docs, q))) == 4
    q = Bool(filter=[when_else(True, Term("type", "TEST_A"), Term("type", "TEST_B"))])
    assert sorted(ids(search(docs, q))) == ["1", "3"]
    q = Bool(should=each(["keyword1", "exact"], lambda w: Term("title", w)))
    assert sorted(ids(search(docs, q))) == ["3", "4"]
    assert each(None, lambda w: Term("title", w)) == []


def test_multi_match_merge_rule():
    mm = MultiMatch("x", ["title"])
    assert merge_multi_match(None, mm) is mm
    b = merge_multi_match(Bool(filter=[Term("type", "A")]), mm)
    assert b.must == [mm] and b.filter
    w = merge_multi_match(Term("type", "A"), mm)
    assert isinstance(w, Bool) and len(w.must) == 2


def test_multi_match_types(docs):
    for t in ("best_fields", "most_fields", "cross_fields"):
        assert sorted(ids(search(docs, MultiMatch("hello", ["title^2", "body"], type=t)))) == ["1", "2"]
    assert ids(search(docs, MultiMatch("match title", ["title", "body"], type="phrase"))) == ["3"]
    assert ids(search(docs, MultiMatch("exact ma", ["title"], type="phrase_prefix"))) == ["3"]


def test_dict_form(docs):
    q = from_dict({"bool": {"must": [{"match": {"title": {"query": "hello"}}}],
                            "filter": [{"term": {"type": {"value": "TEST_B"}}}]}})
    assert ids(search(docs, q)) == ["2"]
    with pytest.raises(ValueError):
        from_dict({"term": {"a": 1}, "match": {"b": "x"}})


def test_dict_form_expands_fuzzy_terms_to_all(spark):
    words = [f"hell{chr(97 + i)}" for i in range(26)] + [f"hel{chr(97 + i)}o" for i in range(26)] + ["h" + chr(97 + i) + "llo" for i in range(26)]
    words = sorted(set(words))
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, title string")
    ix = Index(df, Mapping().long("id").text("title"), name="fuzzy", id_col="id")
    body = {"query": "hello", "fuzziness": 1}
    assert len(words) > 50 and count(ix, from_dict({"match": {"title": body}})) == len(words)
    assert from_dict({"match": {"title": body | {"max_expansions": 5}}}).max_expansions == 5


def test_score_sort_default_desc_and_tie_break(docs):
    res = search(docs, Match("title", "hello world title"))
    scores = [r["_score"] for r in res.hits.collect()]
    assert scores == sorted(scores, reverse=True)
    res = search(docs, None, sort="createdAt")
    assert ids(res) == ["4", "3", "2", "1"]


def test_boost_zero_is_kept(docs):
    res = search(docs, Bool(should=[Match("title", "hello", boost=0.0)]))
    assert {r["_score"] for r in res.hits.collect()} == {0.0}


def test_total_ignores_paging(docs):
    res = search(docs, MatchAll(), size=1, from_=1)
    assert res.total == 4 and len(res.rows()) == 1
    assert count(docs, Term("type", "TEST_A")) == 2
    assert search(docs, Term("type", "nope")).is_empty


def test_cursor_paging_concatenates_to_full_sort(docs):
    sort = [("type", "asc"), ("createdAt", "desc")]
    full = ids(search(docs, None, sort=sort, size=10))
    seen, cursor = [], None
    while True:
        res = search(docs, None, sort=sort, size=1, cursor=cursor)
        page = ids(res)
        if not page:
            break
        seen += page
        cursor = res.cursor
    assert seen == full


def test_invalid_cursor(docs):
    with pytest.raises(ValueError, match="Invalid cursor format"):
        search(docs, None, cursor="not json")
    assert len(ids(search(docs, None, cursor=""))) == 4


def test_source_projection(docs):
    res = search(docs, None, source=["title"], size=1)
    assert res.hits.columns == ["_index", "_id", "_score", "title", "_sort"]
    res = search(docs, None, source=False, size=1)
    assert res.hits.columns == ["_index", "_id", "_score", "_sort"]


def test_highlight_and_sentence(docs):
    hl = Highlight().tags(["<mark>"], ["</mark>"]).field("body")
    res = search(docs, Match("body", "bodyB"), highlight=hl)
    row = res.hits.select(get_highlight_first(F.col("_highlight"), "body").alias("f"),
                          get_highlight_sentence(F.col("_highlight"), "body").alias("s")).first()
    assert row["f"] == "bodyA.\n <mark>bodyB</mark>"
    assert row["s"] == "<mark>bodyB</mark>"
    res = search(docs, Match("title", "hello"), highlight=Highlight().field("title"))
    vals = {r["_id"]: r["h"] for r in res.hits.select("_id", get_highlight_first(F.col("_highlight"), "title").alias("h")).collect()}
    assert vals["1"] == "<em>hello</em> world"


def test_terms_and_nested(spark):
    from seekframe import Index, Nested
    df = spark.createDataFrame(
        [("a", [{"author": "x", "n": 1}, {"author": "y", "n": 5}]), ("b", [{"author": "x", "n": 5}])],
        "_id string, comments array<struct<author:string,n:int>>")
    ix = Index(df)
    q = Nested("comments", Bool(must=[Term("comments.author", "x"), Range("comments.n", gte=5)]))
    assert ids(search(ix, q)) == ["b"]
    # flattened (non-nested) reading matches both
    q = Bool(must=[Term("comments.author", "x"), Range("comments.n", gte=5)])
    assert sorted(ids(search(ix, q))) == ["a", "b"]
    assert sorted(ids(search(ix, Terms("comments.author", ["y"])))) == ["a"]


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_paging_over_microseconds_nulls_and_ties(spark, order):
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1, 0, 0, 0, 17)
    rows = [(str(i), t0 + timedelta(microseconds=100 * (i // 2))) for i in range(9)] + [("n1", None), ("n2", None)]
    for kind in ("timestamp", "timestamp_ntz"):
        ix = Index(spark.createDataFrame(rows, f"_id string, at {kind}"), Mapping().date("at"), name="t")
        seen, cursor = [], None
        for _ in range(20):
            res = search(ix, None, sort=[("at", order)], size=3, cursor=cursor)
            page = [r["_id"] for r in res.hits.collect()]
            if not page:
                break
            seen += page
            cursor = res.cursor
        assert sorted(seen) == sorted(r[0] for r in rows)
        assert seen == [r["_id"] for r in search(ix, None, sort=[("at", order)], size=50).hits.collect()]


def test_too_many_cursor_values(docs):
    with pytest.raises(ValueError, match="cursor values"):
        search(docs, None, sort=[("createdAt", "asc")], search_after=[1, "1", "extra"])


def test_undeclared_fields_are_not_searchable_without_dynamic(spark):
    df = spark.createDataFrame([("1", "a", "b")], "_id string, title string, other string")
    with pytest.raises(ValueError, match="not searchable"):
        search(Index(df, Mapping().keyword("title").dynamic(False)), Term("other", "b")).hits.collect()


def test_building_queries_starts_no_job(spark):
    from seekframe.plans.catalog import all_queries
    # searches over stored tables write these first
    plans = [n for n in all_queries() if not n.startswith("batch_search") and not n.endswith("_stored")
             and n not in ("stats_refresh", "each_items_table", "page_and_total", "bucketed_join", "index_lifecycle")]
    sc = spark.sparkContext
    for name in plans:
        sc.setJobGroup(name, name)
        all_queries()[name](spark, "/root/testdata/sf0.001")
        jobs = sc.statusTracker().getJobIdsForGroup(name)
        # reading a Parquet schema is one job a table
        assert all(len(sc.statusTracker().getJobInfo(j).stageIds) == 1 for j in jobs) and len(jobs) <= 3, name
    sc.setJobGroup("", "")
