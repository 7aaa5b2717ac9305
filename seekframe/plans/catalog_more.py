"""Registered queries: predicates, scoring, paging, projection, counts,
highlighting, ingest, mutation and search tables.  Keys match
:mod:`seekframe.plans.oracle_more`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.highlight import Highlight, get_highlight, get_highlight_first, get_highlight_sentence
from ..operators import mutate
from ..operators.clauses import (Bool, Exists, FunctionScore, Match, MatchAll, MatchPhrase, MultiMatch,
                                 Nested, Range, Raw, ScoreFunction, Term, Terms, Wildcard, each,
                                 merge_multi_match, when, when_else)
from ..operators.batch import batch_search
from ..operators.postings import (build_postings, build_term_stats, query_term_table,
                                  refresh_postings, scan_tables)
from ..operators.search import count_frame, get_by_ids, matching, search
from ..sources.index import Index
from ..sources.mapping import Mapping
from ..sources.tables import add_columns
from .catalog import (benchmark_index, documents_index, events_index, lineitem_index, orders_index,
                      pages_index, part_index, register, table)

# Fixed query words (present in the driver corpus at every scale).
W1, W2, W3 = "ering", "oning", "retion"


def ids_scores(df):
    return df.select("_id", "_score")


def hits(res, keep_sort=False):
    return res.hits if keep_sort else res.hits.drop("_sort")


# ---------------------------------------------------------------------------
# P1-P12 leaves
# ---------------------------------------------------------------------------

@register("term_keyword")
def term_keyword(spark, d):
    return ids_scores(matching(events_index(spark, d), Term("event_type", "click")))


@register("term_number")
def term_number(spark, d):
    return ids_scores(matching(lineitem_index(spark, d), Term("l_linenumber", 1)))


@register("term_token")
def term_token(spark, d):
    return ids_scores(matching(documents_index(spark, d), Term("text", W1)))


@register("terms")
def terms(spark, d):
    return ids_scores(matching(orders_index(spark, d), Terms("o_orderpriority", ["1-URGENT", "2-HIGH"])))


@register("match_or")
def match_or(spark, d):
    return ids_scores(matching(documents_index(spark, d), Match("text", f"{W1} {W2} {W3}")))


@register("match_and")
def match_and(spark, d):
    return ids_scores(matching(documents_index(spark, d), Match("text", f"{W1} {W2}", operator="and")))


@register("match_analyzer")
def match_analyzer(spark, d):
    q = Match("text", f"The {W1} of {W2}", analyzer="stop")
    return ids_scores(matching(documents_index(spark, d), q))


@register("match_fuzzy")
def match_fuzzy(spark, d):
    q = Match("p_name", "widgit gizmo", fuzziness="AUTO")
    return ids_scores(matching(part_index(spark, d), q))


@register("match_phrase")
def match_phrase(spark, d):
    return ids_scores(matching(documents_index(spark, d), MatchPhrase("text", "of the")))


@register("match_all")
def match_all(spark, d):
    ix = Index(table(spark, d, "customer"), name="customer", id_col="c_custkey")
    return ids_scores(matching(ix, MatchAll()))


@register("wildcard_keyword")
def wildcard_keyword(spark, d):
    return ids_scores(matching(part_index(spark, d), Wildcard("p_brand", "Brand#1?")))


@register("wildcard_text")
def wildcard_text(spark, d):
    return ids_scores(matching(documents_index(spark, d), Wildcard("text", "erin*")))


@register("range_numeric")
def range_numeric(spark, d):
    q = Bool(filter=[Range("l_quantity", gte=10, lt=20), Range("l_discount", gt=0.05)])
    return ids_scores(matching(lineitem_index(spark, d), q))


@register("range_date")
def range_date(spark, d):
    q = Range("o_orderdate", gte="1996-01-01", lte="1996-03-31")
    return ids_scores(matching(orders_index(spark, d), q))


@register("range_date_tz")
def range_date_tz(spark, d):
    q = Range("o_orderdate", gte="1996-01-01 00:00:00", lt="1996-02-01 00:00:00",
              format="yyyy-MM-dd HH:mm:ss", time_zone="+05:00")
    return ids_scores(matching(orders_index(spark, d), q))


def docs_with_labels(spark, d, mapping: Mapping | None = None) -> Index:
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return Index(df, mapping, name="documents", id_col="doc_id", text=("text",))


@register("exists")
def exists(spark, d):
    return ids_scores(matching(docs_with_labels(spark, d), Exists("quality")))


# ---------------------------------------------------------------------------
# P13-P34 compound
# ---------------------------------------------------------------------------

@register("bool_must")
def bool_must(spark, d):
    q = Bool(must=[Match("text", W1), Match("text", W2)])
    return ids_scores(matching(documents_index(spark, d), q))


@register("bool_filter")
def bool_filter(spark, d):
    q = Bool(must=[Match("text", W1)], filter=[Term("lang", "en"), Range("n_chars", gte=1000)])
    return ids_scores(matching(documents_index(spark, d), q))


@register("bool_should")
def bool_should(spark, d):
    q = Bool(should=[Match("text", W1), Term("source", "src3")])
    return ids_scores(matching(documents_index(spark, d), q))


@register("bool_must_not")
def bool_must_not(spark, d):
    q = Bool(must=[Match("text", W1)], must_not=[Term("source", "src3")])
    return ids_scores(matching(documents_index(spark, d), q))


@register("min_should_match")
def min_should_match(spark, d):
    q = Bool(should=[Match("text", W1), Match("text", W2), Match("text", W3), Term("lang", "de")],
             minimum_should_match=2)
    return ids_scores(matching(documents_index(spark, d), q))


@register("pure_negative")
def pure_negative(spark, d):
    return ids_scores(matching(documents_index(spark, d), Bool(must_not=[Term("lang", "en")])))


@register("bool_nested")
def bool_nested(spark, d):
    q = Bool(must=[Bool(should=[Match("text", W1), Match("text", W3)])],
             filter=[Bool(must_not=[Term("source", "src1")])])
    return ids_scores(matching(documents_index(spark, d), q))


MM_FIELDS = ["url", "html^2"]


@register("mm_best_fields")
def mm_best_fields(spark, d):
    return ids_scores(matching(pages_index(spark, d), MultiMatch("org blog", MM_FIELDS)))


@register("mm_most_fields")
def mm_most_fields(spark, d):
    return ids_scores(matching(pages_index(spark, d), MultiMatch("org blog", MM_FIELDS, type="most_fields")))


@register("mm_cross_fields")
def mm_cross_fields(spark, d):
    return ids_scores(matching(pages_index(spark, d), MultiMatch("org blog", MM_FIELDS, type="cross_fields")))


@register("mm_phrase")
def mm_phrase(spark, d):
    return ids_scores(matching(pages_index(spark, d), MultiMatch("example com", ["url", "html"], type="phrase")))


@register("mm_phrase_prefix")
def mm_phrase_prefix(spark, d):
    q = MultiMatch("example co", ["url", "html"], type="phrase_prefix")
    return ids_scores(matching(pages_index(spark, d), q))


@register("mm_bool_prefix")
def mm_bool_prefix(spark, d):
    q = MultiMatch("utm blo", ["url", "html"], type="bool_prefix")
    return ids_scores(matching(pages_index(spark, d), q))


@register("mm_merge_bool")
def mm_merge_bool(spark, d):
    q = merge_multi_match(Bool(filter=[Term("lang", "en")]), MultiMatch(f"{W1} {W2}", ["text"]))
    return ids_scores(matching(documents_index(spark, d), q))


@register("dotted_path")
def dotted_path(spark, d):
    ev = table(spark, d, "events").withColumn("props", F.from_json("props", "k INT"))
    m = (Mapping().long("event_id").date("ts").long("user_id").keyword("event_type").double("value")
         .object("props", lambda o: o.integer("k")))
    ix = Index(ev, m, name="events", id_col="event_id")
    return ids_scores(matching(ix, Bool(filter=[Range("props.k", gte=50), Term("event_type", "view")])))


def orders_with_items(spark, d) -> Index:
    items = (table(spark, d, "lineitem").groupBy("l_orderkey")
             .agg(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_returnflag")).alias("items")))
    return Index(items, name="order_items", id_col="l_orderkey")


@register("nested_exists")
def nested_exists(spark, d):
    q = Nested("items", Bool(must=[Term("items.l_returnflag", "R"), Range("items.l_quantity", gte=45)]))
    return ids_scores(matching(orders_with_items(spark, d), q))


@register("function_score")
def function_score(spark, d):
    q = FunctionScore(Match("text", W1), [ScoreFunction(2.0, Term("lang", "en")),
                                          ScoreFunction(3.0, Range("n_chars", gte=2000))],
                      score_mode="sum", boost_mode="multiply")
    return ids_scores(matching(documents_index(spark, d), q))


@register("raw_column_clause")
def raw_column_clause(spark, d):
    q = Bool(must=[Match("text", W1), Raw(F.length("source") == 4)])
    return ids_scores(matching(documents_index(spark, d), q))


@register("optional_filter")
def optional_filter(spark, d):
    ix = documents_index(spark, d)
    out = None
    for label, source in (("with_source", "src1"), ("without_source", None)):
        q = Bool(must=[Match("text", W1)], filter=[when(source is not None, lambda: Term("source", source))])
        part = count_frame(ix, q).select(F.lit(label).alias("variant"), F.col("count"))
        out = part if out is None else out.unionByName(part)
    return out


@register("either_filter")
def either_filter(spark, d):
    ix = documents_index(spark, d)
    out = None
    for flag in (True, False):
        q = Bool(must=[Match("text", W1)],
                 filter=[when_else(flag, Term("source", "src1"), Range("n_chars", lt=500))])
        part = count_frame(ix, q).select(F.lit(flag).alias("flag"), F.col("count"))
        out = part if out is None else out.unionByName(part)
    return out


@register("each_items")
def each_items(spark, d):
    q = Bool(should=each([W1, W2, W3], lambda w: Match("text", w)))
    return ids_scores(matching(documents_index(spark, d), q))


# ---------------------------------------------------------------------------
# R1-R3 scoring
# ---------------------------------------------------------------------------

@register("bm25")
def bm25_query(spark, d):
    return ids_scores(matching(documents_index(spark, d), Match("text", f"{W1} {W3}")))


@register("boosted_should")
def boosted_should(spark, d):
    q = Bool(should=[Match("text", W1, boost=2.0), Match("text", W2, boost=0.0), Term("lang", "fr", boost=0.5)])
    return ids_scores(matching(documents_index(spark, d), q))


@register("term_stats")
def term_stats(spark, d):
    post = build_postings(documents_index(spark, d), ["text"], positions=False)
    return build_term_stats(post).select("field", "term", "df")


# ---------------------------------------------------------------------------
# O1-O8 sort and paging
# ---------------------------------------------------------------------------

@register("sort_multi")
def sort_multi(spark, d):
    res = search(orders_index(spark, d), Range("o_totalprice", gte=100000),
                 sort=[("o_orderpriority", "asc"), ("o_totalprice", "desc")], size=50,
                 source=["o_orderpriority", "o_totalprice"])
    return hits(res)


@register("sort_by")
def sort_by(spark, d):
    res = search(orders_index(spark, d), None, sort="o_totalprice", size=20, source=["o_orderkey", "o_totalprice"])
    return hits(res)


@register("sort_score")
def sort_score(spark, d):
    res = search(documents_index(spark, d), Match("text", W1), sort=[("_score", "desc"), ("n_chars", "asc")],
                 size=20, source=["n_chars"])
    return hits(res)


@register("top_k")
def top_k(spark, d):
    res = search(documents_index(spark, d), Match("text", f"{W1} {W3}"), size=5, source=False)
    return hits(res)


@register("offset_page")
def offset_page(spark, d):
    res = search(documents_index(spark, d), Match("text", f"{W1} {W3}"), from_=10, size=10, source=False)
    return hits(res)


@register("search_after")
def search_after(spark, d):
    res = search(orders_index(spark, d), None, sort=[("o_totalprice", "desc")], size=10,
                 search_after=[300000.0, "0"], source=["o_totalprice"])
    return hits(res)


@register("cursor_page")
def cursor_page(spark, d):
    res = search(orders_index(spark, d), None, sort=[("o_orderpriority", "asc"), ("o_totalprice", "desc")],
                 size=10, cursor='["2-HIGH", 150000.5, "777"]', source=["o_orderpriority", "o_totalprice"])
    return hits(res)


@register("hit_sort_values")
def hit_sort_values(spark, d):
    res = search(orders_index(spark, d), Term("o_orderstatus", "P"),
                 sort=[("o_orderpriority", "asc"), ("o_custkey", "desc")], size=15, source=False)
    return hits(res, keep_sort=True)


# ---------------------------------------------------------------------------
# J1-J4 projection, A1-A3 counts
# ---------------------------------------------------------------------------

@register("source_fields")
def source_fields(spark, d):
    return hits(search(documents_index(spark, d), Match("text", W1), size=10, source=["doc_id", "lang"]))


@register("source_none")
def source_none(spark, d):
    return hits(search(documents_index(spark, d), Match("text", W1), size=10, source=False))


@register("hit_shape")
def hit_shape(spark, d):
    res = search(documents_index(spark, d), Match("text", W1), sort=[("n_chars", "desc")], size=10,
                 source=["lang"], track_scores=True)
    return hits(res, keep_sort=True)


@register("source_excludes")
def source_excludes(spark, d):
    m = (Mapping().long("doc_id").text("text").keyword("lang").keyword("source").long("n_chars")
         .source(excludes=["te*", "n_*"]))
    ix = Index(table(spark, d, "documents"), m, name="documents", id_col="doc_id")
    return hits(search(ix, Match("text", W1), size=10))


@register("count_all")
def count_all(spark, d):
    return count_frame(documents_index(spark, d))


@register("count_query")
def count_query(spark, d):
    return count_frame(documents_index(spark, d), Match("text", W1))


@register("search_total")
def search_total(spark, d):
    q = Bool(must=[Match("text", W1)], filter=[Term("lang", "en")])
    return search(documents_index(spark, d), q, size=3).total_frame()


@register("is_empty")
def is_empty(spark, d):
    ix = documents_index(spark, d)
    out = None
    for label, q in (("no_hits", Term("lang", "xx")), ("hits", Term("lang", "de"))):
        res = search(ix, q, size=10)
        part = res.hits.agg((F.count(F.lit(1)) == 0).alias("is_empty")).select(F.lit(label).alias("case"), "is_empty")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------------------
# H1-H11 highlight
# ---------------------------------------------------------------------------

EN_QUERY = Bool(must=[Match("text", f"{W1} {W3}")], filter=[Term("lang", "en")])


def _hl_search(spark, d, query, hl, index=None, sort=None, size=10):
    ix = index or documents_index(spark, d)
    return search(ix, query, sort=sort, size=size, source=False, highlight=hl).hits


@register("highlight_field")
def highlight_field(spark, d):
    h = _hl_search(spark, d, EN_QUERY, Highlight().field("text", number_of_fragments=0))
    return h.select("_id", "_score", get_highlight_first(F.col("_highlight"), "text").alias("text_hl"))


@register("highlight_fields")
def highlight_fields(spark, d):
    q = Bool(must=[Match("text", W1)], should=[Term("source", "src1")], filter=[Term("lang", "en")])
    hl = Highlight().add_fields([{"name": "text", "number_of_fragments": 0},
                                 {"name": "source", "number_of_fragments": 0}])
    h = _hl_search(spark, d, q, hl, size=20)
    return h.select("_id", "_score", get_highlight_first(F.col("_highlight"), "text").alias("text_hl"),
                    get_highlight_first(F.col("_highlight"), "source").alias("source_hl"))


@register("highlight_tags")
def highlight_tags(spark, d):
    hl = Highlight().tags(["<mark>"], ["</mark>"]).field("text", number_of_fragments=0)
    h = _hl_search(spark, d, EN_QUERY, hl)
    return h.select("_id", get_highlight_first(F.col("_highlight"), "text").alias("text_hl"))


@register("highlight_query")
def highlight_query(spark, d):
    hl = Highlight().query(Match("text", W3)).field("text", number_of_fragments=0)
    h = _hl_search(spark, d, Bool(must=[Match("text", W1)], filter=[Term("lang", "en")]), hl)
    return h.select("_id", get_highlight_first(F.col("_highlight"), "text").alias("text_hl"))


@register("highlight_fragments")
def highlight_fragments(spark, d):
    hl = Highlight().field("text", fragment_size=80, number_of_fragments=3)
    h = _hl_search(spark, d, EN_QUERY, hl)
    frags = get_highlight(F.col("_highlight"), "text")
    return h.select("_id", F.size(frags).cast("bigint").alias("n_fragments"), F.array_join(frags, " | ").alias("text_hl"))


@register("highlight_boundary")
def highlight_boundary(spark, d):
    hl = Highlight().field("text", boundary_scanner="sentence", number_of_fragments=2)
    h = _hl_search(spark, d, EN_QUERY, hl)
    return h.select("_id", F.array_join(get_highlight(F.col("_highlight"), "text"), " | ").alias("text_hl"))


@register("highlight_order")
def highlight_order(spark, d):
    hl = Highlight().field("text", fragment_size=60, number_of_fragments=2, order="score")
    h = _hl_search(spark, d, EN_QUERY, hl)
    return h.select("_id", F.array_join(get_highlight(F.col("_highlight"), "text"), " | ").alias("text_hl"))


@register("highlight_no_match")
def highlight_no_match(spark, d):
    hl = Highlight().field("source", no_match_size=3)
    h = _hl_search(spark, d, EN_QUERY, hl)
    return h.select("_id", get_highlight_first(F.col("_highlight"), "source").alias("source_hl"))


def english_subfield_index(spark, d) -> Index:
    m = (Mapping().long("doc_id").text("text", fields={"english": {"type": "text", "analyzer": "english"}})
         .keyword("lang").keyword("source").long("n_chars"))
    good, _ = m.conform(table(spark, d, "documents"))
    return Index(good, m, name="documents", id_col="doc_id")


@register("highlight_matched_fields")
def highlight_matched_fields(spark, d):
    ix = english_subfield_index(spark, d)
    q = Bool(should=[Match("text", W1), Match("text.english", W3)], filter=[Term("lang", "en")])
    hl = Highlight().field("text", number_of_fragments=0, matched_fields=["text.english"])
    h = _hl_search(spark, d, q, hl, index=ix, sort=[("n_chars", "desc")])
    return h.select("_id", get_highlight_first(F.col("_highlight"), "text").alias("text_hl"))


@register("highlight_first")
def highlight_first(spark, d):
    hl = Highlight().add_fields([{"name": "text", "number_of_fragments": 0}, {"name": "source"}])
    h = _hl_search(spark, d, EN_QUERY, hl, sort=[("n_chars", "desc")])
    return h.select("_id", get_highlight_first(F.col("_highlight"), "text").alias("text_first"),
                    get_highlight_first(F.col("_highlight"), "source").alias("source_first"))


@register("highlight_sentence")
def highlight_sentence_q(spark, d):
    hl = Highlight().tags(["<mark>"], ["</mark>"]).field("text", number_of_fragments=0)
    h = _hl_search(spark, d, EN_QUERY, hl)
    return h.select("_id", get_highlight_sentence(F.col("_highlight"), "text").alias("sentence"))


# ---------------------------------------------------------------------------
# M1-M14 mapping and ingest
# ---------------------------------------------------------------------------

@register("conform_text")
def conform_text(spark, d):
    m = Mapping().long("doc_id").text("text").keyword("lang")
    good, _ = m.conform(table(spark, d, "documents").select("doc_id", "text", "lang"))
    return good.select("doc_id", F.size("text__tokens").cast("bigint").alias("n_tokens"), "lang")


@register("conform_keyword")
def conform_keyword(spark, d):
    m = (Mapping().long("event_id").keyword("event_type", normalizer="lowercase", ignore_above=5))
    good, _ = m.conform(table(spark, d, "events").select("event_id", "event_type"))
    ix = Index(good, m, name="events", id_col="event_id")
    return ids_scores(matching(ix, Terms("event_type", ["CLICK", "Purchase"])))


@register("conform_date")
def conform_date(spark, d):
    src = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    good, _ = Mapping().long("o_orderkey").date("d", format="yyyy-MM-dd").conform(src)
    return good.select("o_orderkey", F.date_format("d", "yyyy-MM-dd HH:mm:ss").alias("d"))


@register("conform_bool")
def conform_bool(spark, d):
    src = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    good, _ = Mapping().long("doc_id").boolean("quality").conform(src)
    return good


@register("conform_numeric")
def conform_numeric(spark, d):
    src = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))
    good, _ = Mapping().long("event_id").integer("k").conform(src)
    return good


@register("conform_nested")
def conform_nested(spark, d):
    src = (table(spark, d, "lineitem").groupBy("l_orderkey")
           .agg(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_returnflag")).alias("items")))
    m = Mapping().long("l_orderkey").nested(
        "items", lambda n: n.integer("l_linenumber").double("l_quantity").keyword("l_returnflag"))
    good, _ = m.conform(src)
    return good.select("l_orderkey", F.size("items").cast("bigint").alias("n_items"),
                       F.aggregate("items", F.lit(0.0), lambda a, e: a + e["l_quantity"]).alias("qty"))


@register("conform_object")
def conform_object(spark, d):
    m = Mapping().long("event_id").object("props", lambda o: o.integer("k"))
    good, _ = m.conform(table(spark, d, "events").select("event_id", "props"))
    return good.select("event_id", F.col("props.k").alias("k"))


@register("conform_disabled")
def conform_disabled(spark, d):
    m = Mapping().long("event_id").disabled("props")
    good, _ = m.conform(table(spark, d, "events").select("event_id", "props"))
    return good


@register("conform_custom")
def conform_custom(spark, d):
    src = table(spark, d, "supplier").select(
        "s_suppkey", F.to_json(F.struct((F.col("s_acctbal") / 100.0).alias("lat"),
                                        F.col("s_nationkey").cast("double").alias("lon"))).alias("loc"))
    good, _ = Mapping().long("s_suppkey").custom("loc", {"type": "geo_point"}).conform(src)
    return good.select("s_suppkey", F.col("loc.lat").alias("lat"), F.col("loc.lon").alias("lon"))


@register("null_value")
def null_value(spark, d):
    m = (Mapping().long("doc_id").text("text").keyword("lang").keyword("source").long("n_chars")
         .integer("quality", null_value=0).integer("toxic"))
    return ids_scores(matching(docs_with_labels(spark, d, m), Term("quality", 0)))


@register("copy_to")
def copy_to(spark, d):
    m = (Mapping().long("doc_id").keyword("lang", copy_to="all").keyword("source", copy_to="all").text("all"))
    good, _ = m.conform(table(spark, d, "documents").select("doc_id", "lang", "source"))
    ix = Index(good, m, name="documents", id_col="doc_id")
    return ids_scores(matching(ix, Match("all", "en src3")))


@register("multi_field")
def multi_field(spark, d):
    ix = english_subfield_index(spark, d)
    return ids_scores(matching(ix, Match("text.english", f"The {W1} is {W2}")))


def _dynamic_input(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", "event_type",
                     F.when(F.col("event_type") == "click", F.col("props")).alias("extra"))


def _outcome(good, rejected):
    return (good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("outcome"), "n")
            .unionByName(rejected.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("outcome"), "n")))


@register("dynamic_strict")
def dynamic_strict(spark, d):
    m = Mapping().long("event_id").keyword("event_type").dynamic("strict")
    return _outcome(*m.conform(_dynamic_input(spark, d)))


@register("dynamic_false")
def dynamic_false(spark, d):
    m = Mapping().long("event_id").keyword("event_type").dynamic(False)
    return _outcome(*m.conform(_dynamic_input(spark, d)))


@register("ngram_terms")
def ngram_terms(spark, d):
    m = (Mapping().settings(analysis={"analyzer": {"grams": {"tokenizer": "g", "filter": ["lowercase"]}},
                                      "tokenizer": {"g": {"type": "ngram", "min_gram": 2, "max_gram": 3}}})
         .long("p_partkey").text("p_name", analyzer="grams"))
    good, _ = m.conform(table(spark, d, "part").select("p_partkey", "p_name"))
    return good.select("p_partkey", F.size("p_name__tokens").cast("bigint").alias("n_grams"),
                       F.array_join("p_name__tokens", "|").alias("grams"))


@register("conform_full")
def conform_full(spark, d):
    src = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")
    m = (Mapping().long("o_orderkey").keyword("o_orderstatus").double("o_totalprice")
         .date("o_orderdate", format="yyyy-MM-dd").keyword("o_orderpriority", normalizer="lowercase"))
    good, _ = m.conform(src)
    return good.select("o_orderkey", "o_orderstatus", "o_totalprice",
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")


@register("write_layout")
def write_layout(spark, d):
    m = Mapping().long("o_orderkey").keyword("o_orderstatus").settings(number_of_shards=4)
    good, _ = m.conform(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"))
    shards = m.index_settings["number_of_shards"]
    laid = good.withColumn("_id", F.col("o_orderkey").cast("string")).repartition(shards, "_id")
    return laid.select("_id", F.spark_partition_id().alias("shard"))


# ---------------------------------------------------------------------------
# S2-S12 sources, sinks and mutation
# ---------------------------------------------------------------------------

@register("multi_index_search")
def multi_index_search(spark, d):
    ix = Index.union([documents_index(spark, d), benchmark_index(spark, d)])
    res = search(ix, Match("text", f"{W1} {W3}"), size=20, source=False)
    return hits(res)


@register("get_by_ids")
def get_by_ids_q(spark, d):
    b = table(spark, d, "benchmark")
    ids = b.select("item_id").unionByName(b.select((F.col("item_id") + 1000000).alias("item_id")))
    return get_by_ids(documents_index(spark, d), ids, "item_id").select("_id", "found", "lang")


@register("bulk_create")
def bulk_create(spark, d):
    base = documents_index(spark, d).df.drop("_index")
    docs = table(spark, d, "benchmark").select(
        "text", F.lit("xx").alias("lang"), F.lit("benchmark").alias("source"),
        F.length("text").cast("bigint").alias("n_chars"))
    new = mutate.bulk_create(base, docs).new
    return new.select("doc_id", "lang", "source", "n_chars")


def _order_changes(spark, d):
    o = table(spark, d, "orders").filter(F.col("o_orderstatus") == "P")
    key = F.col("o_orderkey")
    a = o.select((key * 2).alias("seq"), key.cast("string").alias("_id"), F.array(F.lit("o_orderpriority")).alias("_set"),
                 F.lit("5-LOW").alias("o_orderpriority"), F.lit(None).cast("double").alias("o_totalprice"))
    b = o.select((key * 2 + 1).alias("seq"), key.cast("string").alias("_id"), F.array(F.lit("o_totalprice")).alias("_set"),
                 F.lit(None).cast("string").alias("o_orderpriority"), (F.col("o_totalprice") + 1000.0).alias("o_totalprice"))
    missing = o.select((key * 2 + 10 ** 9).alias("seq"), (key + 10 ** 9).cast("string").alias("_id"),
                       F.array(F.lit("o_orderpriority")).alias("_set"), F.lit("9-NONE").alias("o_orderpriority"),
                       F.lit(None).cast("double").alias("o_totalprice"))
    return a.unionByName(b).unionByName(missing)


@register("bulk_update")
def bulk_update(spark, d):
    base = orders_index(spark, d).df.drop("_index")
    new = mutate.bulk_update(base, _order_changes(spark, d)).new
    return new.select("_id", "o_orderstatus", "o_orderpriority", "o_totalprice")


@register("bulk_status")
def bulk_status(spark, d):
    base = orders_index(spark, d).df.drop("_index")
    return mutate.bulk_update(base, _order_changes(spark, d)).status


@register("bulk_upsert")
def bulk_upsert(spark, d):
    c = table(spark, d, "customer")
    base = c.withColumn("_id", F.col("c_custkey").cast("string"))
    key = F.col("c_custkey")
    upd = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        key.alias("seq"), key.cast("string").alias("_id"), F.array(F.lit("c_acctbal")).alias("_set"),
        (F.col("c_acctbal") + 100.0).alias("c_acctbal"), F.lit(None).cast("string").alias("c_name"),
        F.lit(None).cast("string").alias("c_mktsegment"))
    ins = c.filter(F.col("c_mktsegment") == "AUTOMOBILE").select(
        (key + 10 ** 6).alias("seq"), (key + 10 ** 6).cast("string").alias("_id"),
        F.array(F.lit("c_name"), F.lit("c_mktsegment")).alias("_set"), F.lit(None).cast("double").alias("c_acctbal"),
        F.concat(F.lit("new "), F.col("c_name")).alias("c_name"), F.lit("NEW").alias("c_mktsegment"))
    new = mutate.bulk_upsert(base, upd.unionByName(ins)).new
    return new.select("_id", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("bulk_delete")
def bulk_delete(spark, d):
    o = table(spark, d, "orders")
    base = o.withColumn("_id", F.col("o_orderkey").cast("string"))
    f = o.filter(F.col("o_orderstatus") == "F")
    ids = f.select(F.col("o_orderkey").alias("seq"), F.col("o_orderkey").cast("string").alias("_id")).unionByName(
        f.select((F.col("o_orderkey") + 10 ** 9).alias("seq"), (F.col("o_orderkey") + 10 ** 9).cast("string").alias("_id")))
    return mutate.bulk_delete(base, ids).new.select("_id", "o_orderstatus")


@register("delete_by_query")
def delete_by_query(spark, d):
    mut = mutate.delete_by_query(events_index(spark, d), Term("event_type", "error"))
    return mut.new.select("_id", "event_type")


@register("schema_evolution")
def schema_evolution(spark, d):
    c = table(spark, d, "customer")
    evolved = add_columns(c, Mapping().keyword("c_comment").integer("c_priority").keyword("c_name"))
    return evolved.select("c_custkey", "c_name", "c_comment", "c_priority")


# ---------------------------------------------------------------------------
# X2-X4 search tables
# ---------------------------------------------------------------------------

@register("postings")
def postings(spark, d):
    return build_postings(documents_index(spark, d), ["text"], positions=False)


@register("postings_refresh")
def postings_refresh(spark, d):
    ix = documents_index(spark, d)
    old = build_postings(ix, ["text"], positions=False)
    docs = ix.df
    changed = docs.filter(F.col("source") == "src3").select(
        F.col("doc_id").alias("seq"), "_id", F.array(F.lit("text")).alias("_set"),
        F.concat("text", F.lit(" refreshed words")).alias("text"))
    new_docs = mutate.bulk_update(docs, changed).new
    return refresh_postings(old, ix.with_df(new_docs), changed.select("_id"), ["text"], positions=False)


@register("batch_search")
def batch_search_q(spark, d):
    queries = table(spark, d, "benchmark")
    terms = query_term_table(queries, "text", "item_id", "text")
    tables = scan_tables(documents_index(spark, d), "text", terms)
    return batch_search(tables, queries, "text", "item_id", "text", k=3)
