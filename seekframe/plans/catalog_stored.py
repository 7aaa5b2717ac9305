"""Registered queries: exact paging, sorts, offsets, nested and mixed mutation,
rejected rows, and searches over stored tokens and statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import mutate
from ..functions.highlight import Highlight, get_highlight_first
from ..operators.clauses import Bool, FunctionScore, Match, MatchPhrase, Nested, Range, ScoreFunction, Term, Terms
from ..operators.batch import batch_search, each_items
from ..operators.dictionary import (build_dictionary, fuzzy_stored, phrase_prefix_stored, phrase_stored, wildcard_stored,
                                    write_dictionary)
from ..operators.postings import build_tables, refresh_tables, write_tables
from ..operators.search import matching, search
from ..session import checkpoint_dir, gone_at_exit
from ..sources.index import Index
from ..sources.mapping import Mapping
from ..sources.tables import DocumentTable, write_bucketed
from .catalog import FLAGSHIP_TEXT, documents_index, events_index, part_index, register, table
from .catalog_more import W1, docs_with_labels, hits, ids_scores

#: Cursor values between and on events of the driver table, in milliseconds with microseconds behind the point.
TS_ASC, TS_DESC = "1704067207179.575", "1706659032194.062"


@register("cursor_page_ts")
def cursor_page_ts(spark, d):
    res = search(events_index(spark, d), None, sort=[("ts", "asc")], size=50, cursor=f'[{TS_ASC}, "0"]', source=["ts"])
    return hits(res, keep_sort=True)


@register("search_after_ts")
def search_after_ts(spark, d):
    res = search(events_index(spark, d), None, sort=[("ts", "desc"), ("event_type", "asc")], size=50,
                 search_after=[float(TS_DESC), "view", "0"], source=["ts", "event_type"])
    return hits(res)


@register("range_date_offset")
def range_date_offset(spark, d):
    q = Range("ts", gte="2024-01-10T05:30:00+05:00", lt="2024-01-12T03:00:00Z")
    return ids_scores(matching(events_index(spark, d), q))


@register("sort_subfield")
def sort_subfield(spark, d):
    return hits(search(part_index(spark, d), None, sort=[("p_name.exact", "asc"), ("p_size", "desc")], size=40, source=["p_name", "p_size"]))


@register("sort_null_value")
def sort_null_value(spark, d):
    m = (Mapping().long("doc_id").text("text").keyword("lang").keyword("source").long("n_chars")
         .integer("quality", null_value=1).integer("toxic"))
    return hits(search(docs_with_labels(spark, d, m), None, sort=[("quality", "asc"), ("n_chars", "desc")], size=120,
                       source=["quality", "n_chars"]))


def _grams(spark, d, name, rows) -> Index:
    m = (Mapping().settings(analysis={"analyzer": {"grams": {"tokenizer": "g", "filter": ["lowercase"]}},
                                      "tokenizer": {"g": {"type": "ngram", "min_gram": 2, "max_gram": 3}}})
         .long("p_partkey").text("p_name", analyzer="grams"))
    return Index(table(spark, d, "part").filter(rows).select("p_partkey", "p_name"), m, name=name, id_col="p_partkey")


@register("multi_index_custom_analyzer")
def multi_index_custom_analyzer(spark, d):
    ix = Index.union([_grams(spark, d, "small", F.col("p_size") < 25), _grams(spark, d, "large", F.col("p_size") >= 25)])
    return matching(ix, Match("p_name", "ri"), with_score=False).select("_index", "_id")


@register("bulk_update_nested")
def bulk_update_nested(spark, d):
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    base = ev.select(F.col("event_id").cast("string").alias("_id"), F.struct(k.alias("k"), F.col("event_type").alias("kind")).alias("meta"))
    one = ev.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("_id"), F.array(F.lit("meta.k")).alias("_set"),
        F.struct((k + 1000).alias("k"), F.lit(None).cast("string").alias("kind"), F.lit("late").alias("note")).alias("meta"))
    two = ev.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("_id"),
        F.array(F.lit("meta.note"), F.lit("meta.kind")).alias("_set"),
        F.struct(F.lit(-1).alias("k"), F.lit(None).cast("string").alias("kind"), F.lit("seen").alias("note")).alias("meta"))
    new = mutate.bulk_update(base, one.unionByName(two)).new
    return new.select("_id", F.col("meta.k").alias("k"), F.col("meta.kind").alias("kind"), F.col("meta.note").alias("note"))


@register("bulk_mixed")
def bulk_mixed(spark, d):
    o = table(spark, d, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    base = o.withColumn("_id", key.cast("string")).select("_id", "o_orderstatus", "o_orderpriority")

    def change(rows, seq, op, priority):
        return o.filter(rows).select(seq.alias("seq"), key.cast("string").alias("_id"), F.lit(op).alias("op"),
                                     F.array(F.lit("o_orderpriority")).alias("_set"), F.lit(priority).alias("o_orderpriority"))

    changes = (change(status == "F", key * 2, "delete", None)
               .unionByName(change((status == "F") & (key % 2 == 0), key * 2 + 1, "upsert", "NEW"))
               .unionByName(change(status == "P", key * 2, "upsert", "UPD"))
               .unionByName(change((status == "P") & (key % 3 == 0), key * 2 + 1, "delete", None)))
    return mutate.bulk_mixed(base, changes).new


@register("conform_rejects")
def conform_rejects(spark, d):
    ev = table(spark, d, "events")
    kind = F.col("event_type")
    src = ev.select("event_id",
                    F.when(kind == "error", F.concat(F.lit("x"), F.col("value").cast("string"))).otherwise(F.lit("1.5")).alias("v"),
                    F.when(kind == "view", F.col("event_id") + 2 ** 40).otherwise(F.col("event_id")).alias("big"),
                    F.when(kind == "click", F.lit('{"a":"abc","z":5}')).otherwise(F.lit('{"a":7}')).alias("obj"))
    m = Mapping().long("event_id").double("v").integer("big").object("obj", lambda o: o.integer("a"), dynamic="strict")
    good, rejected = m.conform(src)
    return (good.select("event_id", F.concat_ws("/", F.col("v").cast("string"), F.col("obj.a").cast("string")).alias("outcome"))
            .unionByName(rejected.select("event_id", F.array_join("_errors", "; ").alias("outcome"))))


@register("dynamic_object")
def dynamic_object(spark, d):
    src = table(spark, d, "events").select("event_id", F.struct(
        F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("more")).alias("props"))
    good, _ = Mapping().long("event_id").object("props", lambda o: o.integer("k")).conform(src)
    return good.select("event_id", F.col("props.k").alias("k"), F.col("props.more").alias("more"))


def _event_json(spark, d):
    """Events with a JSON object: event_type under ``kind``, value, and the number of ``props`` under ``k``."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, d, "events").select("event_id", F.to_json(F.struct(
        F.col("event_type").alias("kind"), "value", F.struct(k.alias("k"), F.array(k, k + 1).alias("pair")).alias("in"))).alias("doc"))


@register("dynamic_object_json")
def dynamic_object_json(spark, d):
    """One sub-field is declared; the others are kept, found and read back."""
    m = Mapping().long("event_id").object("doc", lambda o: o.keyword("kind"), dynamic=True)
    ix = Index(m.conform(_event_json(spark, d))[0], m, name="events", id_col="event_id")
    q = Bool(filter=[Term("doc.kind", "view"), Range("doc.value", gte=40.0), Range("doc.in.k", lt=60)])
    return matching(ix, q, with_score=False).select(
        "_id", F.col("doc.kind").alias("kind"), F.try_variant_get("doc._more", "$.in.pair[1]", "int").alias("second"))


@register("dynamic_object_strict")
def dynamic_object_strict(spark, d):
    """The inner object declares its own policy: rows with fields that it does not declare are rejected."""
    m = Mapping().long("event_id").object("doc", lambda o: o.keyword("kind").object("in", lambda i: i.integer("k"), dynamic="strict"))
    view = F.when(F.get_json_object("doc", "$.kind") == "view", F.regexp_replace("doc", r',"pair":\[[^\]]*\]', "")).otherwise(F.col("doc"))
    good, rejected = m.conform(_event_json(spark, d).withColumn("doc", view))
    return (good.select("event_id", F.concat_ws("/", "doc.kind", F.col("doc.in.k").cast("string")).alias("outcome"))
            .unionByName(rejected.select("event_id", F.array_join("_errors", "; ").alias("outcome"))))


@register("dynamic_nested")
def dynamic_nested(spark, d):
    """Items from JSON, only their number declared: the query's fields are undeclared."""
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.to_json(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_returnflag"))).alias("items"))
    m = Mapping().long("l_orderkey").nested("items", lambda o: o.integer("l_linenumber"))
    ix = Index(m.conform(items)[0], m, name="order_items", id_col="l_orderkey")
    q = Nested("items", Bool(must=[Term("items.l_returnflag", "R"), Range("items.l_quantity", gte=45)]))
    return ids_scores(matching(ix, q))


@register("dynamic_runtime")
def dynamic_runtime(spark, d):
    """Undeclared columns become no columns; predicates read them when asked."""
    m = Mapping().long("event_id").dynamic("runtime")
    good, _ = m.conform(table(spark, d, "events").select("event_id", "event_type", "value", "user_id"))
    ix = Index(good, m, name="events", id_col="event_id")
    q = Bool(filter=[Term("event_type", "click"), Range("value", gte=50), Terms("user_id", [1, 2, 3, 5, 8, 13, 21, 34])])
    return matching(ix, q, with_score=False).select("_id", F.concat_ws(",", F.array(*map(F.lit, good.columns))).alias("columns"))


@register("highlight_phrase")
def highlight_phrase(spark, d):
    """Only words of the phrase's own occurrences are tagged."""
    res = search(documents_index(spark, d), MatchPhrase("text", "of the"), sort=[("n_chars", "desc")], size=30, source=False,
                 highlight=Highlight(number_of_fragments=0).field("text"))
    return res.hits.select("_id", get_highlight_first(F.col("_highlight"), "text").alias("text_hl"))


def stored_documents(spark, d, positions=False) -> Index:
    """Documents as ingest leaves them in the shared folder: tokens, postings and statistics are written once."""
    root = f"{checkpoint_dir(spark)}/search-{uuid.uuid4().hex}"
    m = Mapping().long("doc_id").text("text").keyword("lang").keyword("source").long("n_chars")
    good, _ = m.conform(table(spark, d, "documents"))
    good.write.parquet(f"{root}/documents")
    gone_at_exit(spark, root)
    ix = Index(spark.read.parquet(f"{root}/documents"), m, name="documents", id_col="doc_id")
    ix.stats = write_tables(build_tables(ix, ["text"], positions=positions), f"{root}/tables")
    return ix


def stored_dictionary(tables):
    spark = tables.postings.sparkSession
    root = f"{checkpoint_dir(spark)}/search-{uuid.uuid4().hex}"
    out = write_dictionary(build_dictionary(tables.term_stats), root)
    gone_at_exit(spark, root)
    return out


@register("search_stored")
def search_stored(spark, d):
    q = Bool(must=[Match("text", FLAGSHIP_TEXT)], filter=[Term("lang", "en")])
    return hits(search(stored_documents(spark, d), q, sort=[("_score", "desc")], size=10, source=["doc_id", "lang", "n_chars"]))


@register("batch_search_stored")
def batch_search_stored(spark, d):
    return batch_search(stored_documents(spark, d).stats, table(spark, d, "benchmark"), "text", "item_id", "text", k=3)


@register("batch_search_filtered")
def batch_search_filtered(spark, d):
    """A third of the queries ask for English, the others for French where the item is even; every fifth also for one source."""
    ix = stored_documents(spark, d)
    item = F.col("item_id")
    where = {"lang": F.when(item % 3 == 0, "en").when(item % 2 == 0, "fr"), "source": F.when(item % 5 == 0, "src1")}
    return batch_search(ix.stats, table(spark, d, "benchmark"), "text", "item_id", "text", k=3, where=where, documents=ix.df)


@register("phrase_stored")
def phrase_stored_q(spark, d):
    return phrase_stored(stored_documents(spark, d, positions=True).stats, "text", "of the")


@register("phrase_prefix_stored")
def phrase_prefix_stored_q(spark, d):
    tables = stored_documents(spark, d, positions=True).stats
    return phrase_prefix_stored(tables, stored_dictionary(tables), "text", "of the th")


@register("fuzzy_stored")
def fuzzy_stored_q(spark, d):
    tables = stored_documents(spark, d).stats
    return fuzzy_stored(tables, stored_dictionary(tables), "text", "licnese permision gnu")


@register("wildcard_stored")
def wildcard_stored_q(spark, d):
    tables = stored_documents(spark, d).stats
    return wildcard_stored(tables, stored_dictionary(tables), "text", "*ering?h*")


@register("stats_refresh")
def stats_refresh(spark, d):
    """Term statistics after one source's texts changed and another source went, from signed counts of these documents."""
    old = stored_documents(spark, d)
    docs = old.df
    source = F.col("source")
    new = old.with_df(docs.filter(source != "src5").withColumn(
        "text", F.when(source == "src3", F.concat(F.substring("text", 1, 200), F.lit(" refreshed words"))).otherwise(F.col("text")))
        .drop("text__tokens"))
    changed = docs.filter(source.isin("src3", "src5")).select("_id")
    tables = refresh_tables(old.stats, old, new, changed)
    return tables.term_stats.select("term", "df").unionByName(tables.field_stats.select(
        F.lit(None).cast("string").alias("term"), F.expr("n * 1000000000 + sum_dl").alias("df")))


# ---- clauses from tables, page and total in one run, layout that joins use ----

@register("terms_table")
def terms_table(spark, d):
    """Orders of the customers of one segment, without those that hold a returned item of full quantity."""
    buyers = table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    full = table(spark, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49)).select("l_orderkey")
    m = Mapping().long("o_orderkey").long("o_custkey").keyword("o_orderstatus")
    ix = Index(table(spark, d, "orders"), m, name="orders", id_col="o_orderkey")
    return ids_scores(matching(ix, Bool(must=[Terms("o_custkey", buyers, boost=2.0)], must_not=[Terms("o_orderkey", full)])))


@register("terms_table_text")
def terms_table_text(spark, d):
    """Documents that hold any word of the short benchmark items, French ones aside."""
    words = table(spark, d, "benchmark").filter(F.col("item_id") % 7 == 0).select(F.explode(F.split(F.lower("text"), " ")).alias("word"))
    return ids_scores(matching(documents_index(spark, d), Bool(filter=[Terms("text", words)], must_not=[Term("lang", "fr")])))


@register("each_items_table")
def each_items_table(spark, d):
    """A should-clause for every benchmark item: its first three words, boosted by its number."""
    items = table(spark, d, "benchmark").select(F.array_join(F.slice(F.split("text", " "), 1, 3), " ").alias("words"),
                                                (F.col("item_id") % 3 + 1).alias("boost"))
    return each_items(documents_index(spark, d), items, "words", "text", boost_col="boost")


@register("page_and_total")
def page_and_total(spark, d):
    """Rows, total, cursor and empty flag of a page from one run."""
    res = search(documents_index(spark, d), Bool(must=[Match("text", FLAGSHIP_TEXT)], filter=[Term("lang", "en")]),
                 sort=[("n_chars", "desc")], size=25, source=["n_chars"])
    page = res.page()
    rows = [(r["_id"], r["n_chars"], page.total, r["_sort"] == page.cursor, page.is_empty) for r in page.rows]
    return spark.createDataFrame(rows, "_id string, n_chars long, total long, last boolean, empty boolean")


@register("bucketed_join")
def bucketed_join(spark, d):
    """Orders and items in buckets by order: neither side of the join nor the sums by order are exchanged."""
    run = uuid.uuid4().hex
    tables = []
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        path = f"{checkpoint_dir(spark)}/search-{name}-{run}"
        keyed = table(spark, d, name).withColumn("_id", F.col(key).cast("string"))
        tables.append(write_bucketed(keyed, f"bucketed_{name}_{run}", "_id", 16, path))
        gone_at_exit(spark, path)
    orders, items = tables
    return (orders.select("_id", "o_orderstatus").join(items.select("_id", "l_linenumber"), "_id")
            .groupBy("_id", "o_orderstatus").agg(F.count("l_linenumber").alias("n_items")))


@register("source_dotted")
def source_dotted(spark, d):
    """Dotted names give structs with the named sub-fields."""
    k = F.get_json_object("props", "$.k").cast("int")
    ev = table(spark, d, "events").select("event_id", F.struct(k.alias("k"), F.struct("event_type", "value").alias("of")).alias("meta"))
    ix = Index(ev, Mapping().long("event_id"), name="events", id_col="event_id")
    res = search(ix, None, sort=[("event_id", "asc")], size=500, source=["meta.of.event_type", "meta.k"])
    return res.hits.select("_id", F.to_json("meta").alias("meta"))


@register("function_score_modes")
def function_score_modes(spark, d):
    """Every way to combine functions with one way to combine them with the query, and the other way round."""
    ix = documents_index(spark, d)
    out = None
    modes = [(m, "multiply") for m in ("multiply", "sum", "avg", "max", "min", "first")] \
        + [("sum", m) for m in ("replace", "sum", "avg", "max", "min")]
    for score_mode, boost_mode in modes:
        q = FunctionScore(Match("text", W1), [ScoreFunction(2.0, Term("lang", "en")), ScoreFunction(3.0, Range("n_chars", gte=2000))],
                          score_mode=score_mode, boost_mode=boost_mode)
        part = ids_scores(matching(ix, q)).select(F.lit(f"{score_mode}/{boost_mode}").alias("modes"), "_id", "_score")
        out = part if out is None else out.unionByName(part)
    return out


@register("deleted_count")
def deleted_count(spark, d):
    """How many documents a deletion by query removes, and their ids, from its status rows."""
    status = mutate.delete_by_query(events_index(spark, d), Term("event_type", "error")).status
    return status.agg(F.count_if(F.col("status") == 200).alias("deleted"), F.count_distinct("_id").alias("ids"))


@register("index_lifecycle")
def index_lifecycle(spark, d):
    """Create twice, write, read what was written, delete by query, drop twice: what each call replies."""
    run = uuid.uuid4().hex
    path = f"{checkpoint_dir(spark)}/search-table-{run}"
    t = DocumentTable(spark, f"lifecycle_{run}", location=path)
    m = Mapping().long("c_custkey").keyword("c_name").keyword("c_mktsegment")
    steps = [("create", t.create(m, expected_bytes=1 << 30)), ("create again", t.create(m))]
    gone_at_exit(spark, path)
    docs = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("_id"), "c_custkey", "c_name", "c_mktsegment")
    written = t.bulk_create(docs)
    read = t.read()                                    # a read right after the write sees it
    replied = written.filter("status = 201").select("_id").join(read.select("_id"), "_id", "left_semi").count()
    steps += [("read after write", read.count()), ("ids replied and read", replied),
              ("deleted by query", t.delete_by_query(Term("c_mktsegment", "BUILDING"), m)), ("left", t.read().count()),
              ("drop", t.drop()), ("drop again", t.drop())]
    return spark.createDataFrame([(i, name, int(v)) for i, (name, v) in enumerate(steps)], "step int, call string, reply long")
