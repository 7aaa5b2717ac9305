"""Mapping emission, conform (ingest) and analysers."""

import pytest

from seekframe import Bool, Exists, Index, Mapping, Nested, Range, Term, matching, query_terms, tokenize
from seekframe.functions.analysis import analyzer_from_settings


def test_text_keyword_subfield_and_index_flag():
    m = Mapping().text("title", keyword=True, index=False)
    d = m.to_dict()["mappings"]["properties"]["title"]
    assert d == {"type": "text", "fields": {"exact": {"type": "keyword", "index": False}}}
    d = Mapping().keyword("k", index=False, null_value=0).to_dict()["mappings"]["properties"]["k"]
    assert d == {"type": "keyword", "index": False, "null_value": 0}


def test_ngram_diff_checked():
    with pytest.raises(ValueError):
        Mapping().settings(analysis={"tokenizer": {"g": {"type": "ngram", "min_gram": 2, "max_gram": 5}}},
                           max_ngram_diff=2)


def test_conform_coerce_and_strict(spark):
    m = Mapping().keyword("id").integer("n").integer("m", coerce=False).dynamic("strict")
    df = spark.createDataFrame([("a", "1", None, None), ("b", "x", None, None), ("c", "2", "3", None),
                                ("d", "4", None, "extra")], "id string, n string, m string, other string")
    good, bad = m.conform(df)
    assert sorted(r["id"] for r in good.collect()) == ["a"]
    reasons = {r["id"]: r["_errors"] for r in bad.collect()}
    assert set(reasons) == {"b", "c", "d"}
    assert "coerce" in reasons["c"][0] and "unknown" in reasons["d"][0]


def test_analyzer_python_and_spark_agree(spark):
    texts = ["Héllo wörld_1 it's 3.5", "The QUICK brown fox", "", "naïve café"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name in ("standard", "simple", "whitespace", "stop"):
        got = [r[0] for r in df.select(tokenize("t", name)).collect()]
        from seekframe.functions.analysis import DEFAULT_ANALYZERS
        want = [DEFAULT_ANALYZERS.get(name).terms(t) for t in texts]
        assert got == want, name
    assert query_terms("The the cat", "stop") == ["cat"]


def test_ngram_analyzer(spark):
    an = analyzer_from_settings("g", {"tokenizer": "g", "filter": ["lowercase"]},
                                {"g": {"type": "ngram", "min_gram": 2, "max_gram": 3}})
    df = spark.createDataFrame([("Abcd",), ("a",)], "t string")
    got = [r[0] for r in df.select(an.column(df.t)).collect()]
    assert got == [an.terms("Abcd"), []]
    assert an.terms("Abcd") == ["ab", "abc", "bc", "bcd", "cd"]


JSON = [(1, '{"a":7,"z":5,"o":{"b":"x","y":true}}'), (2, '{"a":"abc"}'), (3, "[1]"), (4, None), (5, "nope"), (6, '{"a":null,"z":"five"}'),
        (7, '{"a":"8"}'), (8, "{}")]


def json_rows(spark, rows=JSON):
    return spark.createDataFrame(rows, "id long, doc string")


def test_undeclared_fields_of_json_objects_stay(spark):
    m = Mapping().long("id").object("doc", lambda o: o.integer("a").object("o", lambda i: i.keyword("b")))
    good, bad = m.conform(json_rows(spark))
    rows = {r["id"]: r["doc"] for r in good.collect()}
    assert set(rows) == {1, 4, 6, 7, 8} and rows[4] is None and rows[1]["a"] == 7 and rows[7]["a"] == 8 and rows[1]["o"]["b"] == "x"
    assert rows[1]["_more"].toJson() == '{"z":5}' and rows[1]["o"]["_more"].toJson() == '{"y":true}' and rows[7]["_more"] is None
    assert {r["id"]: r["_errors"] for r in bad.collect()} == {2: ["doc.a: not an integer"], 3: ["doc: not an object"], 5: ["doc: not an object"]}
    ix = Index(good, m, id_col="id")

    def found(q):
        return sorted(int(r["_id"]) for r in matching(ix, q, with_score=False).collect())

    assert found(Term("doc.z", 5)) == [1] and found(Term("doc.z", "five")) == [6] and found(Range("doc.z", gt=4.5)) == [1]
    assert found(Term("doc.o.y", True)) == [1] and found(Exists("doc.z")) == [1, 6] and found(Term("doc.none", 1)) == []


def test_policies_at_every_level(spark):
    inner = lambda i: i.keyword("b")
    strict = Mapping().long("id").object("doc", lambda o: o.keyword("a").object("o", inner, dynamic="strict").keyword("z"))
    good, bad = strict.conform(json_rows(spark))
    assert {r["id"] for r in bad.filter("exists(_errors, e -> e like '%unknown%')").collect()} == {1}
    outer = Mapping().long("id").object("doc", lambda o: o.keyword("a").object("o", inner, dynamic=True), dynamic="strict")
    _, bad = outer.conform(json_rows(spark))
    assert {r["id"]: r["_errors"] for r in bad.collect() if "unknown" in str(r["_errors"])} \
        == {1: ["doc: unknown field"], 6: ["doc: unknown field"]}
    quiet = Mapping().long("id").object("doc", lambda o: o.keyword("a"), dynamic=False)
    good, _ = quiet.conform(json_rows(spark))
    assert {r["id"]: r["doc"]["_more"] and r["doc"]["_more"].toJson() for r in good.collect() if r["doc"]}[6] == '{"z":"five"}'
    with pytest.raises(ValueError, match="not searchable"):
        matching(Index(good, quiet, id_col="id"), Term("doc.z", 5))
    inherited = Mapping().long("id").dynamic("strict").object("doc", lambda o: o.keyword("a"))
    assert {r["id"] for r in inherited.conform(json_rows(spark))[1].collect()} == {1, 3, 5, 6}


def test_nested_elements_keep_or_reject_undeclared_fields(spark):
    rows = [(1, '[{"a":1,"q":"x"},{"a":2}]'), (2, '[{"a":"no"},{"a":"no"}]'), (3, '{"a":3,"q":"y"}'), (4, "[1]"), (5, "[]"), (6, None)]
    m = Mapping().long("id").nested("doc", lambda o: o.integer("a"))
    good, bad = m.conform(json_rows(spark, rows))
    assert {r["id"]: r["_errors"] for r in bad.collect()} == {2: ["doc.a: not an integer"], 4: ["doc: not a list of objects"]}
    ix = Index(good, m, id_col="id")
    both = Nested("doc", Bool(must=[Term("doc.q", "x"), Term("doc.a", 1)]))
    neither = Nested("doc", Bool(must=[Term("doc.q", "x"), Term("doc.a", 2)]))
    assert [r["_id"] for r in matching(ix, both).collect()] == ["1"] and matching(ix, neither).count() == 0
    strict = Mapping().long("id").nested("doc", lambda o: o.integer("a"), dynamic="strict")
    assert {r["id"] for r in strict.conform(json_rows(spark, rows))[1].collect()} == {1, 2, 3, 4}
    structs = spark.sql("select 1L as id, array(named_struct('a', '1', 'q', 'x')) as doc union all select 2L, array(named_struct('a', 'n', 'q', null))")
    good, bad = m.conform(structs)
    assert good.first()["doc"][0].asDict() == {"a": 1, "q": "x"} and bad.first()["_errors"] == ["doc.a: not a integer"]
    assert [r["id"] for r in strict.conform(structs)[1].orderBy("id").collect()] == [1, 2]


def test_runtime_fields_are_read_by_predicates_alone(spark):
    m = Mapping().long("id").dynamic("runtime")
    df = spark.createDataFrame([(1, "red", 2.5), (2, "blue", None)], "id long, colour string, size double")
    good, _ = m.conform(df)
    assert good.columns == ["id", "_more"]
    ix = Index(good, m, id_col="id")
    assert [r["_id"] for r in matching(ix, Bool(filter=[Term("colour", "red"), Range("size", gte=2)])).collect()] == ["1"]


def test_conform_parses_json_once(spark):
    """Neither the split into good and rejected rows nor the declared fields repeat the conversion."""
    from pyspark.sql import functions as F

    m = Mapping().object("doc", lambda o: o.keyword("kind").object("in", lambda i: i.integer("k").integer("l"), dynamic="strict"))
    rows = [('{"kind":"a","in":{"k":1,"l":"2"}}',), ('{"kind":"b","in":{"k":"x","z":1}}',), ("nothing",), (None,), ('{"in":7}',), ('{"more":[1]}',)]
    df = spark.createDataFrame(rows, "doc string")
    good, rejected = m.conform(df.select(F.concat("doc", F.lit(" ")).alias("doc")))
    for out in (good, rejected):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parse_json(doc") + plan.count("ParseJson(doc") <= 1 and plan.count("map_filter") + plan.count("mapfilter") <= 2
    got = {(r["doc"]["kind"], r["doc"]["in"] and tuple(r["doc"]["in"])) if r["doc"] else None for r in good.select("doc").collect()}
    assert got == {("a", (1, 2)), None, (None, None)}
    assert sorted("; ".join(r["_errors"]) for r in rejected.collect()) == [
        "doc.in.k: not an integer; doc.in: unknown field", "doc.in: not an object", "doc: not an object"]
