"""Bulk mutation and document tables (document/index service cases)."""

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from seekframe import Mapping, Term
from seekframe.operators import mutate
from seekframe.sources.tables import DocumentTable


@pytest.fixture()
def base(spark):
    return spark.createDataFrame([("1", "a", 1), ("2", "b", 2), ("3", "c", 3)], "_id string, title string, n int")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_update_last_setter_wins_and_explicit_null(spark, base):
    ch = spark.createDataFrame(
        [(1, "1", ["title"], "x", None), (2, "1", ["title"], "y", None), (3, "1", ["n"], None, None),
         (4, "9", ["title"], "z", None)],
        "seq long, _id string, _set array<string>, title string, n int")
    mut = mutate.bulk_update(base, ch)
    assert rows(mut.new, "_id", "title", "n") == [("1", "y", None), ("2", "b", 2), ("3", "c", 3)]
    st = {r["_id"]: r["status"] for r in mut.status.collect()}
    assert st["9"] == 404 and st["1"] == 200
    assert mut.errors().first()["errors"] is True


def test_upsert_inserts_missing(spark, base):
    ch = mutate.changes_frame(spark, [{"_id": "2", "doc": {"title": "B"}}, {"_id": "new", "doc": {"title": "N"}}],
                              "seq long, _id string, _set array<string>, title string")
    mut = mutate.bulk_upsert(base, ch)
    assert rows(mut.new, "_id", "title") == [("1", "a"), ("2", "B"), ("3", "c"), ("new", "N")]
    assert sorted(r["status"] for r in mut.status.collect()) == [200, 201]


def test_delete_missing_is_noop(spark, base):
    ids = spark.createDataFrame([(1, "2"), (2, "404")], "seq long, _id string")
    mut = mutate.bulk_delete(base, ids)
    assert rows(mut.new, "_id") == [("1",), ("3",)]
    assert mut.errors().first()["errors"] is False


def test_create_keeps_duplicates_with_new_ids(spark, base):
    docs = spark.createDataFrame([("same", 7), ("same", 7)], "title string, n int")
    new = mutate.bulk_create(base, docs).new.cache()
    assert new.count() == 5 and new.select("_id").distinct().count() == 5


@pytest.fixture()
def table(spark):
    t = DocumentTable(spark, "docs_" + uuid.uuid4().hex, buckets=8, location="file://" + tempfile.mkdtemp(prefix="seekframe-table-"))
    yield t
    t.drop()


def test_table_lifecycle(spark, table):
    m = Mapping().keyword("title").integer("n")
    assert table.create(m) is True and table.create(m) is False
    st = table.bulk_create(spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "title string, n int"))
    written = table.read()
    assert written.count() == 3
    assert sorted(r["_id"] for r in st.collect()) == sorted(r["_id"] for r in written.collect())
    some = written.filter(F.col("title") == "b").first()["_id"]
    table.update(some, {"n": 20})
    assert table.get(some)["n"] == 20
    with pytest.raises(KeyError):
        table.update("missing", {"n": 1})
    assert table.delete_by_query(Term("title", "a"), m) == 2
    assert table.read().count() == 1
    table.put_mapping(Mapping().keyword("extra"))
    r = table.read().first()
    assert r["extra"] is None and r["n"] == 20
    table.delete("nope")
    table.delete(some)
    assert table.read().count() == 0
    assert table.drop() is True and table.drop() is False and not table.exists()


def test_writes_leave_other_files_alone(spark, table):
    table.create(Mapping().keyword("title"))
    ids = spark.range(200).select(F.col("id").cast("string").alias("_id"), F.lit("x").alias("title"))
    table.bulk_create(ids)
    files = lambda: {r["f"] for r in spark.table(table.name).select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    table.bulk_create(spark.createDataFrame([("new", "y")], "_id string, title string"))
    assert before < files()                      # an append adds files
    before = files()
    table.update("7", {"title": "seven"})
    gone = before - files()
    assert gone and all(f.rsplit("/", 2)[1] == next(iter(gone)).rsplit("/", 2)[1] for f in gone)     # one bucket rewritten
    assert table.read().count() == 201 and table.get("7")["title"] == "seven"


def test_two_upserts_keep_both_rows(spark, table):
    table.create(Mapping().keyword("title"))
    for k in ("a", "b"):
        table.bulk_upsert(spark.createDataFrame([(0, k, k)], "seq long, _id string, title string"))
    assert {r["_id"] for r in table.read().collect()} == {"a", "b"}


def test_mixed_changes_follow_seq(spark, table):
    table.create(Mapping().keyword("title").integer("n"))
    schema = "seq long, _id string, op string, _set array<string>, title string, n int"
    table.bulk_mixed(spark.createDataFrame([(0, "a", "upsert", ["title", "n"], "A", 1), (1, "b", "upsert", ["title"], "B", None)], schema))
    table.bulk_mixed(spark.createDataFrame([(0, "a", "delete", None, None, None), (1, "a", "upsert", ["n"], None, 5),
                                            (2, "b", "upsert", ["n"], None, 9), (3, "b", "delete", None, None, None)], schema))
    assert rows(table.read(), "_id", "title", "n") == [("a", None, 5)]


def test_update_keeps_what_a_struct_change_does_not_name(spark):
    base = spark.createDataFrame([("1", (1, "x")), ("2", None)], "_id string, meta struct<a:int,b:string>")
    ch = spark.createDataFrame([(0, "1", ["meta.a"], (9, None)), (1, "2", ["meta"], (3, "y"))],
                               "seq long, _id string, _set array<string>, meta struct<a:int,b:string>")
    got = {r["_id"]: tuple(r["meta"]) for r in mutate.bulk_update(base, ch).new.collect()}
    assert got == {"1": (9, "x"), "2": (3, "y")}
    with pytest.raises(ValueError, match="seq"):
        mutate.bulk_update(base, ch.drop("seq"))


def test_the_plain_table_holds_documents_only(spark, table):
    table.create(Mapping().keyword("title"))
    table.bulk_create(spark.range(50).select(F.col("id").cast("string").alias("_id"), F.lit("x").alias("title")))
    table.bulk_delete(spark.range(49).select(F.lit(0).cast("long").alias("seq"), F.col("id").cast("string").alias("_id")))
    assert [r["_id"] for r in spark.table(table.name).collect()] == ["49"]      # no rows but documents, for any reader
    assert spark.sql(f"SHOW PARTITIONS {table.name}").count() == 1
    table.delete("49")
    assert spark.table(table.name).count() == 0 and table.get("49") is None
    table.bulk_upsert(spark.createDataFrame([(0, "49", "back")], "seq long, _id string, title string"))
    assert table.get("49")["title"] == "back"


def test_buckets_follow_the_expected_size(spark, table):
    from seekframe.sources.tables import BUCKET_BYTES, DocumentTable

    table.create(Mapping().keyword("title"), expected_bytes=int(9.5 * BUCKET_BYTES))
    assert table.buckets == 10 and DocumentTable(spark, table.name).buckets == 10       # a property of the table
    table.bulk_create(spark.range(500).select(F.col("id").cast("string").alias("_id"), F.lit("x").alias("title")))
    assert spark.sql(f"SHOW PARTITIONS {table.name}").count() == 10


def test_a_large_bucket_is_written_by_several_tasks(spark, table):
    table.create(Mapping().keyword("title"), expected_bytes=1)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.files.openCostInBytes": "1",
             "spark.sql.files.maxPartitionBytes": "100k"}
    was = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        table.bulk_create(spark.range(40_000).repartition(8).select(F.col("id").cast("string").alias("_id"), F.md5(F.col("id").cast("string")).alias("title")))
        files = spark.table(table.name).select(F.input_file_name().alias("f")).distinct().count()
        table.bulk_upsert(spark.createDataFrame([(0, "1", "one")], "seq long, _id string, title string"))
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert files > 2 and table.read().count() == 40_000 and table.get("1")["title"] == "one"
