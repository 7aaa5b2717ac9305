"""DuckDB oracles of the queries in :mod:`seekframe.plans.catalog_more`.

The shard layout (``write_layout``) has no oracle: DuckDB has no Spark partition
hash.  Its regex engine has no look-around either, so fragments are cut by
patterns that take the blank after a fragment along.
"""

from __future__ import annotations

from ..functions.analysis import ENGLISH_STOP_WORDS
from .catalog_more import W1, W2, W3
from .oracle import SQL, docs_cte, sql
from .sqlgen import (all_terms, any_term, bm25, dbl, idf, match_score, padded, q, stats_cte, tf_norm, tok,
                     total)

D = docs_cte()
ONE = dbl(1.0)
ZERO = dbl(0.0)


def sc(expr: str, matched: str) -> str:
    return f"(CASE WHEN {matched} THEN {expr} ELSE {ZERO} END)"


def has(t: str, tokens: str = "tok") -> str:
    return f"list_contains({tokens}, {q(t)})"


def doc_id() -> str:
    return "CAST(doc_id AS VARCHAR) AS _id"


# ---- leaves ---------------------------------------------------------------

sql("term_keyword", f"""
WITH st AS (SELECT count(event_type) AS n, count(*) FILTER (WHERE event_type = 'click') AS df FROM events)
SELECT CAST(event_id AS VARCHAR) AS _id, round({idf('n', 'df')} * {ONE}, 6) AS _score
FROM events, st WHERE event_type = 'click'""")

sql("term_number", f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS _id, {ONE} AS _score
FROM lineitem WHERE l_linenumber = 1""")

sql("term_token", f"""
WITH {D}, {stats_cte('st', 'd', 'tok', [W1])}
SELECT {doc_id()}, round({match_score('tok', [W1])}, 6) AS _score FROM d, st WHERE {has(W1)}""")

sql("terms", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS _id, {ONE} AS _score FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")


def match_query(terms: list[str], match: str) -> str:
    return f"""
WITH {D}, {stats_cte('st', 'd', 'tok', terms)}
SELECT {doc_id()}, round({match_score('tok', terms)}, 6) AS _score FROM d, st WHERE {match}"""


sql("match_or", match_query([W1, W2, W3], any_term("tok", [W1, W2, W3])))
sql("match_and", match_query([W1, W2], all_terms("tok", [W1, W2])))
sql("match_analyzer", match_query([W1, W2], any_term("tok", [W1, W2])))
sql("bm25", match_query([W1, W3], any_term("tok", [W1, W3])))


def fuzzy_query(rows: str, words: list[tuple[str, int]]) -> str:
    """Every expansion scored like a term; ``rows`` is a relation of _id and tok, ``words`` are words and edits."""
    found = " UNION ALL ".join(f"SELECT {i} AS w, term, df FROM v WHERE abs(length(term) - {len(t)}) <= {k} AND levenshtein(term, {q(t)}) <= {k}"
                               for i, (t, k) in enumerate(words))
    return f"""
WITH p AS ({rows}),
st AS (SELECT count(*) FILTER (WHERE tok IS NOT NULL) AS n, CAST(sum(len(tok)) AS DOUBLE) AS sdl FROM p),
t AS (SELECT _id, term, count(*) AS tf, len(tok) AS dl FROM (SELECT _id, tok, unnest(tok) AS term FROM p) GROUP BY ALL),
v AS (SELECT term, count(*) AS df FROM t GROUP BY term),
e AS ({found})
SELECT _id, round(sum({bm25('t.tf', 't.dl', 'st.n', 'e.df', '(st.sdl / CAST(st.n AS DOUBLE))')}), 6) AS _score
FROM t JOIN e USING (term), st GROUP BY _id"""


sql("match_fuzzy", fuzzy_query(f"SELECT CAST(p_partkey AS VARCHAR) AS _id, {tok('p_name')} AS tok FROM part", [("widgit", 2), ("gizmo", 1)]))


def phrase_parts(tokens: str, seq: list[str], prefix: str, n: str, avg: str) -> tuple[str, str, str]:
    """(matched, score) of a phrase, stats columns ``{prefix}df{i}`` for distinct terms."""
    needle = "".join(f" {t} " for t in seq)
    p = padded(tokens)
    freq = f"floor(CAST(length({p}) - length(replace({p}, {q(needle)}, '')) AS DOUBLE) / {len(needle)})"
    distinct = list(dict.fromkeys(seq))
    w = total([idf(n, f"{prefix}df{i}") for i in range(len(distinct))])
    score = f"(CASE WHEN {freq} > 0 THEN {w} * {tf_norm(freq, f'len({tokens})', avg)} ELSE {ZERO} END)"
    return f"contains({p}, {q(needle)})", score, needle


_pm, _ps, _ = phrase_parts("tok", ["of", "the"], "", "n", "(sdl / CAST(n AS DOUBLE))")
sql("match_phrase", f"""
WITH {D}, {stats_cte('st', 'd', 'tok', ['of', 'the'])}
SELECT {doc_id()}, round({_ps} * {ONE}, 6) AS _score FROM d, st WHERE {_pm}""")

sql("match_all", f"SELECT CAST(c_custkey AS VARCHAR) AS _id, {ONE} AS _score FROM customer")

sql("wildcard_keyword", f"SELECT CAST(p_partkey AS VARCHAR) AS _id, {ONE} AS _score FROM part WHERE p_brand LIKE 'Brand#1_'")

sql("wildcard_text", f"""
WITH {D} SELECT {doc_id()}, {ONE} AS _score FROM d WHERE len(list_filter(tok, lambda x: x LIKE 'erin%')) > 0""")

sql("range_numeric", f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS _id, {ZERO} AS _score FROM lineitem
WHERE l_quantity >= {dbl(10)} AND l_quantity < {dbl(20)} AND l_discount > {dbl(0.05)}""")

sql("range_date", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS _id, {ONE} AS _score FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-04-01 00:00:00'""")

sql("range_date_tz", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS _id, {ONE} AS _score FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-12-31 19:00:00' AND o_orderdate < TIMESTAMP '1996-01-31 19:00:00'""")

sql("exists", f"""
SELECT {doc_id()}, {ONE} AS _score FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL""")

# ---- compound ---------------------------------------------------------------


def multi_stats(groups: dict[str, list[str]]) -> str:
    return ",\n".join(stats_cte(f"st_{p}", "d", "tok", terms, prefix=f"{p}_") for p, terms in groups.items())


def ms(p: str, terms: list[str], boost: float = 1.0) -> str:
    return match_score("tok", terms, prefix=f"{p}_", boost=boost)


def kw_stats(name: str, col: str, value: str, source: str = "documents") -> str:
    return f"{name} AS (SELECT count({col}) AS n, count(*) FILTER (WHERE {col} = {q(value)}) AS df FROM {source})"


sql("bool_must", f"""
WITH {D}, {multi_stats({'a': [W1], 'b': [W2]})}
SELECT {doc_id()}, round(({ms('a', [W1])} + {ms('b', [W2])}) * {ONE}, 6) AS _score
FROM d, st_a, st_b WHERE {has(W1)} AND {has(W2)}""")

sql("bool_filter", f"""
WITH {D}, {multi_stats({'a': [W1]})}
SELECT {doc_id()}, round({ms('a', [W1])} * {ONE}, 6) AS _score
FROM d, st_a WHERE {has(W1)} AND lang = 'en' AND n_chars >= 1000""")

sql("bool_should", f"""
WITH {D}, {multi_stats({'a': [W1]})}, {kw_stats('ks', 'source', 'src3')}
SELECT {doc_id()}, round(({sc(ms('a', [W1]), has(W1))} + {sc(idf('ks.n', 'ks.df') + ' * ' + ONE, "source = 'src3'")}) * {ONE}, 6) AS _score
FROM d, st_a, ks WHERE {has(W1)} OR source = 'src3'""")

sql("bool_must_not", f"""
WITH {D}, {multi_stats({'a': [W1]})}
SELECT {doc_id()}, round({ms('a', [W1])} * {ONE}, 6) AS _score
FROM d, st_a WHERE {has(W1)} AND NOT coalesce(source = 'src3', false)""")

_msm_hits = (f"((CASE WHEN {has(W1)} THEN 1 ELSE 0 END) + (CASE WHEN {has(W2)} THEN 1 ELSE 0 END)"
             f" + (CASE WHEN {has(W3)} THEN 1 ELSE 0 END) + (CASE WHEN lang = 'de' THEN 1 ELSE 0 END))")
sql("min_should_match", f"""
WITH {D}, {multi_stats({'a': [W1], 'b': [W2], 'c': [W3]})}, {kw_stats('ks', 'lang', 'de')}
SELECT {doc_id()}, round({total([sc(ms('a', [W1]), has(W1)), sc(ms('b', [W2]), has(W2)), sc(ms('c', [W3]), has(W3)),
                                 sc(idf('ks.n', 'ks.df') + ' * ' + ONE, "lang = 'de'")])} * {ONE}, 6) AS _score
FROM d, st_a, st_b, st_c, ks WHERE {_msm_hits} >= 2""")

sql("pure_negative", f"""
SELECT {doc_id()}, {ONE} AS _score FROM documents WHERE NOT coalesce(lang = 'en', false)""")

_inner = f"(({sc(ms('a', [W1]), has(W1))} + {sc(ms('c', [W3]), has(W3))}) * {ONE})"
sql("bool_nested", f"""
WITH {D}, {multi_stats({'a': [W1], 'c': [W3]})}
SELECT {doc_id()}, round({_inner} * {ONE}, 6) AS _score
FROM d, st_a, st_c WHERE ({has(W1)} OR {has(W3)}) AND NOT coalesce(source = 'src1', false)""")

# ---- multi_match over pages(url, html^2) ------------------------------------

PG = f"pg AS (SELECT *, {tok('url')} AS tu, {tok('html')} AS th FROM pages)"
MMT = ["org", "blog"]


def pstats(field_tok: str, p: str, terms: list[str]) -> str:
    return stats_cte(f"st_{p}", "pg", field_tok, terms, prefix=f"{p}_")


def pscore(field_tok: str, p: str, terms: list[str]) -> str:
    return match_score(field_tok, terms, prefix=f"{p}_")


_u = sc(pscore("tu", "u", MMT), any_term("tu", MMT))
_h = sc(pscore("th", "h", MMT), any_term("th", MMT))
_mm_from = f"FROM pg, st_u, st_h WHERE {any_term('tu', MMT)} OR {any_term('th', MMT)}"
_mm_with = f"WITH {PG}, {pstats('tu', 'u', MMT)}, {pstats('th', 'h', MMT)}"

sql("mm_best_fields", f"""{_mm_with}
SELECT CAST(page_id AS VARCHAR) AS _id, round(greatest({_u} * {dbl(1.0)}, {_h} * {dbl(2.0)}) * {ONE}, 6) AS _score {_mm_from}""")

sql("mm_most_fields", f"""{_mm_with}
SELECT CAST(page_id AS VARCHAR) AS _id, round(({_u} * {dbl(1.0)} + {_h} * {dbl(2.0)}) * {ONE}, 6) AS _score {_mm_from}""")


def _cross_term(i: int, t: str) -> str:
    avg_u, avg_h = "(u_sdl / CAST(u_n AS DOUBLE))", "(h_sdl / CAST(h_n AS DOUBLE))"
    from .sqlgen import tf as tf_
    su = bm25(tf_("tu", t), "len(tu)", "u_n", f"u_df{i}", avg_u)
    sh = bm25(tf_("th", t), "len(th)", "h_n", f"h_df{i}", avg_h)
    return f"greatest({su} * {dbl(1.0)}, {sh} * {dbl(2.0)})"


sql("mm_cross_fields", f"""{_mm_with}
SELECT CAST(page_id AS VARCHAR) AS _id, round({total([_cross_term(i, t) for i, t in enumerate(MMT)])} * {ONE}, 6) AS _score
{_mm_from}""")

_PH = ["example", "com"]
_pmu, _psu, _ = phrase_parts("tu", _PH, "u_", "u_n", "(u_sdl / CAST(u_n AS DOUBLE))")
_pmh, _psh, _ = phrase_parts("th", _PH, "h_", "h_n", "(h_sdl / CAST(h_n AS DOUBLE))")
sql("mm_phrase", f"""
WITH {PG}, {pstats('tu', 'u', _PH)}, {pstats('th', 'h', _PH)}
SELECT CAST(page_id AS VARCHAR) AS _id,
       round(greatest({sc(_psu + ' * ' + ONE, _pmu)} * {ONE}, {sc(_psh + ' * ' + ONE, _pmh)} * {ONE}) * {ONE}, 6) AS _score
FROM pg, st_u, st_h WHERE {_pmu} OR {_pmh}""")

_ppu = f"contains({padded('tu')}, ' example  co')"
_pph = f"contains({padded('th')}, ' example  co')"
sql("mm_phrase_prefix", f"""
WITH {PG}
SELECT CAST(page_id AS VARCHAR) AS _id,
       round(greatest({sc(ONE, _ppu)} * {ONE}, {sc(ONE, _pph)} * {ONE}) * {ONE}, 6) AS _score
FROM pg WHERE {_ppu} OR {_pph}""")


def _bp(field_tok: str) -> tuple[str, str]:
    hits = [f"(len(list_filter({field_tok}, lambda x: starts_with(x, {q(t)}))) > 0)" for t in ("utm", "blo")]
    n = total([f"(CASE WHEN {h} THEN {ONE} ELSE {ZERO} END)" for h in hits])
    return "(" + " OR ".join(hits) + ")", n


_bpu, _bpun = _bp("tu")
_bph, _bphn = _bp("th")
sql("mm_bool_prefix", f"""
WITH {PG}
SELECT CAST(page_id AS VARCHAR) AS _id,
       round(greatest({sc(_bpun, _bpu)} * {ONE}, {sc(_bphn, _bph)} * {ONE}) * {ONE}, 6) AS _score
FROM pg WHERE {_bpu} OR {_bph}""")

sql("mm_merge_bool", f"""
WITH {D}, {multi_stats({'a': [W1, W2]})}
SELECT {doc_id()}, round(({sc(ms('a', [W1, W2]), any_term('tok', [W1, W2]))} * {ONE}) * {ONE} * {ONE}, 6) AS _score
FROM d, st_a WHERE {any_term('tok', [W1, W2])} AND lang = 'en'""")

sql("dotted_path", f"""
SELECT CAST(event_id AS VARCHAR) AS _id, {ZERO} AS _score FROM events
WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 AND event_type = 'view'""")

sql("nested_exists", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS _id, {dbl(2.0)} AS _score FROM lineitem GROUP BY l_orderkey
HAVING count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity >= {dbl(45)}) > 0""")

_fs = (f"(CASE WHEN lang = 'en' OR n_chars >= 2000 THEN ((CASE WHEN lang = 'en' THEN {dbl(2.0)} ELSE {ZERO} END)"
       f" + (CASE WHEN n_chars >= 2000 THEN {dbl(3.0)} ELSE {ZERO} END)) ELSE {ONE} END)")
sql("function_score", f"""
WITH {D}, {multi_stats({'a': [W1]})}
SELECT {doc_id()}, round({ms('a', [W1])} * {_fs} * {ONE}, 6) AS _score FROM d, st_a WHERE {has(W1)}""")

sql("raw_column_clause", f"""
WITH {D}, {multi_stats({'a': [W1]})}
SELECT {doc_id()}, round(({ms('a', [W1])} + {ONE}) * {ONE}, 6) AS _score
FROM d, st_a WHERE {has(W1)} AND length(source) = 4""")

sql("optional_filter", f"""
WITH {D}
SELECT 'with_source' AS variant, count(*) AS count FROM d WHERE {has(W1)} AND source = 'src1'
UNION ALL
SELECT 'without_source' AS variant, count(*) AS count FROM d WHERE {has(W1)}""")

sql("either_filter", f"""
WITH {D}
SELECT true AS flag, count(*) AS count FROM d WHERE {has(W1)} AND source = 'src1'
UNION ALL
SELECT false AS flag, count(*) AS count FROM d WHERE {has(W1)} AND n_chars < 500""")

sql("each_items", f"""
WITH {D}, {multi_stats({'a': [W1], 'b': [W2], 'c': [W3]})}
SELECT {doc_id()}, round({total([sc(ms('a', [W1]), has(W1)), sc(ms('b', [W2]), has(W2)), sc(ms('c', [W3]), has(W3))])} * {ONE}, 6) AS _score
FROM d, st_a, st_b, st_c WHERE {any_term('tok', [W1, W2, W3])}""")

sql("boosted_should", f"""
WITH {D}, {multi_stats({'a': [W1], 'b': [W2]})}, {kw_stats('ks', 'lang', 'fr')}
SELECT {doc_id()}, round({total([sc(ms('a', [W1], 2.0), has(W1)), sc(ms('b', [W2], 0.0), has(W2)),
                                 sc(idf('ks.n', 'ks.df') + ' * ' + dbl(0.5), "lang = 'fr'")])} * {ONE}, 6) AS _score
FROM d, st_a, st_b, ks WHERE {has(W1)} OR {has(W2)} OR lang = 'fr'""")

sql("term_stats", f"""
WITH {D}
SELECT 'text' AS field, term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(tok) AS term FROM d) GROUP BY term""")

# ---- sort and paging --------------------------------------------------------

NULL_SCORE = "CAST(NULL AS DOUBLE) AS _score"

sql("sort_multi", f"""
SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, {NULL_SCORE}, o_orderpriority, o_totalprice
FROM orders WHERE o_totalprice >= {dbl(100000)}
ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS LAST, _id ASC LIMIT 50""")

sql("sort_by", f"""
SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, {NULL_SCORE}, o_orderkey, o_totalprice
FROM orders ORDER BY o_totalprice DESC NULLS LAST, _id ASC LIMIT 20""")


def scored_docs(terms: list[str], extra_cols: str = "", where: str | None = None) -> str:
    return f"""WITH {D}, {stats_cte('st', 'd', 'tok', terms)},
s AS (SELECT 'documents' AS _index, {doc_id()}, round({match_score('tok', terms)} * {ONE}, 6) AS _score{extra_cols}
      FROM d, st WHERE {where or any_term('tok', terms)})"""


sql("sort_score", f"""{scored_docs([W1], ', n_chars')}
SELECT * FROM s ORDER BY _score DESC, n_chars ASC, _id ASC LIMIT 20""")

sql("top_k", f"""{scored_docs([W1, W3])}
SELECT * FROM s ORDER BY _score DESC, _id ASC LIMIT 5""")

sql("offset_page", f"""{scored_docs([W1, W3])}
SELECT * FROM s ORDER BY _score DESC, _id ASC LIMIT 10 OFFSET 10""")

sql("search_after", f"""
WITH o AS (SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, {NULL_SCORE}, o_totalprice FROM orders)
SELECT * FROM o WHERE o_totalprice < {dbl(300000)} OR (o_totalprice = {dbl(300000)} AND _id > '0')
ORDER BY o_totalprice DESC, _id ASC LIMIT 10""")

sql("cursor_page", f"""
WITH o AS (SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, {NULL_SCORE}, o_orderpriority, o_totalprice
           FROM orders)
SELECT * FROM o
WHERE o_orderpriority > '2-HIGH'
   OR (o_orderpriority = '2-HIGH' AND o_totalprice < {dbl(150000.5)})
   OR (o_orderpriority = '2-HIGH' AND o_totalprice = {dbl(150000.5)} AND _id > '777')
ORDER BY o_orderpriority ASC, o_totalprice DESC, _id ASC LIMIT 10""")

sql("hit_sort_values", f"""
WITH o AS (SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, {NULL_SCORE}, o_orderpriority, o_custkey
           FROM orders WHERE o_orderstatus = 'P')
SELECT _index, _id, _score,
       '[' || CAST(to_json(o_orderpriority) AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ','
           || CAST(to_json(_id) AS VARCHAR) || ']' AS _sort
FROM o ORDER BY o_orderpriority ASC, o_custkey DESC, _id ASC LIMIT 15""")

# ---- projection and counts ----------------------------------------------------

sql("source_fields", f"""{scored_docs([W1], ', doc_id, lang')}
SELECT * FROM s ORDER BY _score DESC, _id ASC LIMIT 10""")

sql("source_none", f"""{scored_docs([W1])}
SELECT * FROM s ORDER BY _score DESC, _id ASC LIMIT 10""")

sql("hit_shape", f"""{scored_docs([W1], ', lang, n_chars')}
SELECT _index, _id, _score, lang, '[' || CAST(n_chars AS VARCHAR) || ',' || CAST(to_json(_id) AS VARCHAR) || ']' AS _sort
FROM s ORDER BY n_chars DESC, _id ASC LIMIT 10""")

sql("source_excludes", f"""{scored_docs([W1], ', doc_id, lang, source')}
SELECT * FROM s ORDER BY _score DESC, _id ASC LIMIT 10""")

sql("count_all", "SELECT count(*) AS count FROM documents")
sql("count_query", f"WITH {D} SELECT count(*) AS count FROM d WHERE {has(W1)}")
sql("search_total", f"WITH {D} SELECT count(*) AS total FROM d WHERE {has(W1)} AND lang = 'en'")
sql("is_empty", """
SELECT 'no_hits' AS "case", (SELECT count(*) FROM documents WHERE lang = 'xx') = 0 AS is_empty
UNION ALL
SELECT 'hits' AS "case", (SELECT count(*) FROM documents WHERE lang = 'de') = 0 AS is_empty""")

# ---- highlight ------------------------------------------------------------------


def hl(expr: str, terms: list[str], pre: str = "<em>", post: str = "</em>") -> str:
    rx = r"\b(?:" + "|".join(terms) + r")\b"
    return f"regexp_replace({expr}, {q(rx)}, {q(pre + chr(92) + '0' + post)}, 'gi')"


def hl_or_null(expr: str, terms: list[str], pre: str = "<em>", post: str = "</em>") -> str:
    rx = r"\b(?:" + "|".join(terms) + r")\b"
    return f"(CASE WHEN regexp_matches({expr}, {q(rx)}, 'i') THEN {hl(expr, terms, pre, post)} ELSE NULL END)"


EN = [W1, W3]
sql("highlight_field", f"""{scored_docs(EN, ', text', any_term('tok', EN) + " AND lang = 'en'")}
SELECT _id, _score, {hl('text', EN)} AS text_hl FROM s ORDER BY _score DESC, _id ASC LIMIT 10""")

sql("highlight_fields", f"""
WITH {D}, {multi_stats({'a': [W1]})}, {kw_stats('ks', 'source', 'src1')},
s AS (SELECT {doc_id()}, text, source,
             round(({ms('a', [W1])} + {sc(idf('ks.n', 'ks.df') + ' * ' + ONE, "source = 'src1'")}) * {ONE}, 6) AS _score
      FROM d, st_a, ks WHERE {has(W1)} AND lang = 'en')
SELECT _id, _score, {hl('text', [W1])} AS text_hl, {hl_or_null('source', ['src1'])} AS source_hl
FROM s ORDER BY _score DESC, _id ASC LIMIT 20""")

sql("highlight_tags", f"""{scored_docs(EN, ', text', any_term('tok', EN) + " AND lang = 'en'")}
SELECT _id, {hl('text', EN, '<mark>', '</mark>')} AS text_hl FROM s ORDER BY _score DESC, _id ASC LIMIT 10""")

sql("highlight_query", f"""{scored_docs([W1], ', text', has(W1) + " AND lang = 'en'")}
SELECT _id, {hl_or_null('text', [W3])} AS text_hl FROM s ORDER BY _score DESC, _id ASC LIMIT 10""")

sql("highlight_no_match", f"""{scored_docs(EN, ', source', any_term('tok', EN) + " AND lang = 'en'")}
SELECT _id, substr(source, 1, 3) AS source_hl FROM s ORDER BY _score DESC, _id ASC LIMIT 10""")

_stops = "[" + ", ".join(q(w) for w in ENGLISH_STOP_WORDS) + "]"
ETOK = f"list_filter(tok, lambda x: NOT list_contains({_stops}, x))"

sql("highlight_matched_fields", f"""
WITH {D}
SELECT {doc_id()}, {hl_or_null('text', [W1, W3])} AS text_hl FROM d
WHERE lang = 'en'
ORDER BY n_chars DESC, _id ASC LIMIT 10""")

sql("highlight_first", f"""
WITH {D}
SELECT {doc_id()}, {hl('text', EN)} AS text_first, CAST(NULL AS VARCHAR) AS source_first FROM d
WHERE {any_term('tok', EN)} AND lang = 'en'
ORDER BY n_chars DESC, _id ASC LIMIT 10""")

_h = hl('text', EN, '<mark>', '</mark>')
sql("highlight_sentence", f"""{scored_docs(EN, ', text', any_term('tok', EN) + " AND lang = 'en'")},
h AS (SELECT _id, _score, {_h} AS h FROM s)
SELECT _id, coalesce(list_filter(string_split_regex(h, '\\.\\s*'), lambda x: trim(x) <> '' AND contains(x, '<mark>'))[1], h) AS sentence
FROM h ORDER BY _score DESC, _id ASC LIMIT 10""")

# ---- mapping and ingest ----------------------------------------------------------

sql("conform_text", f"SELECT doc_id, CAST(len({tok('text')}) AS BIGINT) AS n_tokens, lang FROM documents")

sql("conform_keyword", f"""
SELECT CAST(event_id AS VARCHAR) AS _id, {ONE} AS _score FROM events
WHERE length(event_type) <= 5 AND lower(event_type) IN ('click', 'purchase')""")

sql("conform_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS d FROM orders")
sql("conform_bool", "SELECT doc_id, CAST(quality AS BOOLEAN) AS quality FROM labels")
sql("conform_numeric", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
sql("conform_nested", """
SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey""")
sql("conform_object", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
sql("conform_disabled", "SELECT event_id, props FROM events")
sql("conform_custom", "SELECT s_suppkey, s_acctbal / CAST(100.0 AS DOUBLE) AS lat, CAST(s_nationkey AS DOUBLE) AS lon FROM supplier")

sql("null_value", f"""
SELECT {doc_id()}, {ONE} AS _score FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 0) = 0""")

_CT = ["en", "src3"]
sql("copy_to", f"""
WITH d AS (SELECT doc_id, list_concat({tok('lang')}, {tok('source')}) AS tok FROM documents),
{stats_cte('st', 'd', 'tok', _CT)}
SELECT {doc_id()}, round({match_score('tok', _CT)}, 6) AS _score FROM d, st WHERE {any_term('tok', _CT)}""")

sql("multi_field", f"""
WITH d0 AS (SELECT doc_id, {tok('text')} AS tok FROM documents),
d AS (SELECT doc_id, {ETOK} AS tok FROM d0),
{stats_cte('st', 'd', 'tok', [W1, W2])}
SELECT {doc_id()}, round({match_score('tok', [W1, W2])}, 6) AS _score FROM d, st WHERE {any_term('tok', [W1, W2])}""")

sql("dynamic_strict", """
SELECT 'good' AS outcome, count(*) FILTER (WHERE event_type <> 'click') AS n FROM events
UNION ALL
SELECT 'rejected' AS outcome, count(*) FILTER (WHERE event_type = 'click') AS n FROM events""")

sql("dynamic_false", """
SELECT 'good' AS outcome, count(*) AS n FROM events
UNION ALL
SELECT 'rejected' AS outcome, CAST(0 AS BIGINT) AS n""")

_G = ("flatten([[substr(s, i, k) FOR k IN range(2, 4) IF i + k - 1 <= length(s)] "
      "FOR i IN range(1, length(s) + 1)])")
sql("ngram_terms", f"""
WITH p AS (SELECT p_partkey, {_G} AS g FROM (SELECT p_partkey, lower(p_name) AS s FROM part))
SELECT p_partkey, CAST(len(g) AS BIGINT) AS n_grams, array_to_string(g, '|') AS grams FROM p""")

sql("conform_full", """
SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders""")

# ---- sources, sinks, mutation --------------------------------------------------------

sql("multi_index_search", f"""
WITH u AS (SELECT 'documents' AS _index, CAST(doc_id AS VARCHAR) AS _id, {tok('text')} AS tok FROM documents
           UNION ALL
           SELECT 'benchmark' AS _index, CAST(item_id AS VARCHAR) AS _id, {tok('text')} AS tok FROM benchmark),
{stats_cte('st', 'u', 'tok', EN)}
SELECT _index, _id, round({match_score('tok', EN)} * {ONE}, 6) AS _score FROM u, st WHERE {any_term('tok', EN)}
ORDER BY _score DESC, _id ASC LIMIT 20""")

sql("get_by_ids", """
WITH i AS (SELECT item_id AS k FROM benchmark UNION ALL SELECT item_id + 1000000 AS k FROM benchmark)
SELECT CAST(k AS VARCHAR) AS _id, d.doc_id IS NOT NULL AS found, d.lang FROM i LEFT JOIN documents d ON d.doc_id = i.k""")

sql("bulk_create", """
SELECT doc_id, lang, source, n_chars FROM documents
UNION ALL
SELECT CAST(NULL AS BIGINT) AS doc_id, 'xx' AS lang, 'benchmark' AS source, CAST(length(text) AS BIGINT) AS n_chars FROM benchmark""")

sql("bulk_update", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice + {dbl(1000.0)} ELSE o_totalprice END AS o_totalprice
FROM orders""")

sql("bulk_status", """
SELECT o_orderkey * 2 AS seq, 'update' AS op, CAST(o_orderkey AS VARCHAR) AS _id, 200 AS status, CAST(NULL AS VARCHAR) AS error
FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT o_orderkey * 2 + 1, 'update', CAST(o_orderkey AS VARCHAR), 200, CAST(NULL AS VARCHAR) FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT o_orderkey * 2 + 1000000000, 'update', CAST(o_orderkey + 1000000000 AS VARCHAR), 404, 'document_missing_exception'
FROM orders WHERE o_orderstatus = 'P'""")

sql("bulk_upsert", f"""
SELECT CAST(c_custkey AS VARCHAR) AS _id, c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + {dbl(100.0)} ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
UNION ALL
SELECT CAST(c_custkey + 1000000 AS VARCHAR), CAST(NULL AS BIGINT), 'new ' || c_name, CAST(NULL AS INTEGER),
       CAST(NULL AS DOUBLE), 'NEW'
FROM customer WHERE c_mktsegment = 'AUTOMOBILE'""")

sql("bulk_delete", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
sql("delete_by_query", "SELECT CAST(event_id AS VARCHAR) AS _id, event_type FROM events WHERE event_type <> 'error'")
sql("schema_evolution", """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_comment, CAST(NULL AS INTEGER) AS c_priority FROM customer""")

# ---- search tables -------------------------------------------------------------------


def postings_sql(source: str) -> str:
    return f"""
SELECT 'text' AS field, term, CAST(doc_id AS VARCHAR) AS _id, CAST(len(tok) AS BIGINT) AS dl, count(*) AS tf
FROM (SELECT doc_id, tok, unnest(tok) AS term FROM {source}) GROUP BY ALL"""


sql("postings", f"WITH {D} {postings_sql('d')}")

sql("postings_refresh", f"""
WITH d AS (SELECT doc_id, {tok("CASE WHEN source = 'src3' THEN text || ' refreshed words' ELSE text END")} AS tok
           FROM documents)
{postings_sql('d')}""")


def batch_query(met: str = "") -> str:
    return f"""
WITH {D},
st AS (SELECT count(*) FILTER (WHERE tok IS NOT NULL) AS n, CAST(sum(len(tok)) AS DOUBLE) AS sdl FROM d),
p AS (SELECT CAST(doc_id AS VARCHAR) AS _id, lang, source, term, count(*) AS tf, len(tok) AS dl
      FROM (SELECT doc_id, lang, source, tok, unnest(tok) AS term FROM d) GROUP BY ALL),
ts AS (SELECT term, count(*) AS df FROM p GROUP BY term),
qt AS (SELECT DISTINCT item_id AS query_id, unnest({tok('text')}) AS term FROM benchmark),
c AS (SELECT qt.query_id, p._id, round(sum({bm25('p.tf', 'p.dl', 'st.n', 'ts.df', '(st.sdl / CAST(st.n AS DOUBLE))')}), 6) AS _score
      FROM qt JOIN p USING (term) JOIN ts USING (term), st {met} GROUP BY qt.query_id, p._id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY _score DESC, _id ASC) AS rank FROM c)
SELECT i.query_id, _id, _score, rank FROM (SELECT DISTINCT item_id AS query_id FROM benchmark) i
LEFT JOIN (SELECT * FROM r WHERE rank <= 3) r USING (query_id)"""


sql("batch_search", batch_query())
sql("batch_search_filtered", batch_query("""
      WHERE (CASE WHEN query_id % 3 = 0 THEN p.lang = 'en' WHEN query_id % 2 = 0 THEN p.lang = 'fr' ELSE true END)
        AND (query_id % 5 <> 0 OR p.source = 'src1')"""))
sql("fuzzy_stored", fuzzy_query(f"SELECT {doc_id()}, {tok('text')} AS tok FROM documents", [("licnese", 2), ("permision", 2), ("gnu", 1)]))
sql("wildcard_stored", f"""
WITH {D} SELECT {doc_id()}, {ONE} AS _score FROM d WHERE len(list_filter(tok, lambda x: x LIKE '%ering_h%')) > 0""")
sql("phrase_stored", SQL["match_phrase"])
sql("phrase_prefix_stored", f"WITH {D} SELECT {doc_id()}, {ONE} AS _score FROM d WHERE contains({padded('tok')}, ' of  the  th')")
sql("stats_refresh", f"""
WITH t AS (SELECT {tok("CASE WHEN source = 'src3' THEN substring(text, 1, 200) || ' refreshed words' ELSE text END")} AS tok
           FROM documents WHERE source <> 'src5'),
u AS (SELECT unnest(list_distinct(tok)) AS term FROM t)
SELECT term, count(*) AS df FROM u GROUP BY term
UNION ALL SELECT NULL, CAST(count(*) FILTER (WHERE tok IS NOT NULL) * 1000000000 + sum(len(tok)) AS BIGINT) FROM t""")

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
sql("dynamic_object_json", f"""
SELECT CAST(event_id AS VARCHAR) AS _id, event_type AS kind, {K} + 1 AS second FROM events
WHERE event_type = 'view' AND value >= 40 AND {K} < 60""")
sql("dynamic_object_strict", f"""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'view/' || {K} ELSE 'doc.in: unknown field' END AS outcome FROM events""")
sql("dynamic_nested", SQL["nested_exists"])
sql("dynamic_runtime", """
SELECT CAST(event_id AS VARCHAR) AS _id, 'event_id,_more' AS columns FROM events
WHERE event_type = 'click' AND value >= 50 AND user_id IN (1, 2, 3, 5, 8, 13, 21, 34)""")

_PIECE = r"[\p{L}\p{N}\p{M}_]+|[^\p{L}\p{N}\p{M}_]+"
sql("highlight_phrase", f"""
WITH {D},
h AS (SELECT *, regexp_extract_all(text, {q(_PIECE)}) AS p FROM d WHERE contains({padded('tok')}, ' of  the ')
      ORDER BY n_chars DESC, CAST(doc_id AS VARCHAR) LIMIT 30)
SELECT {doc_id()}, array_to_string(list_transform(p, lambda x, i: CASE
  WHEN lower(x) = 'of' AND lower(p[i + 2]) = 'the' OR lower(x) = 'the' AND i > 2 AND lower(p[i - 2]) = 'of' THEN '<em>' || x || '</em>'
  ELSE x END), '') AS text_hl FROM h""")

sql("terms_table", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS _id, {dbl(2.0)} AS _score FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49)""")
sql("terms_table_text", f"""
WITH {D}, w AS (SELECT list(DISTINCT word) AS ws FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM benchmark WHERE item_id % 7 = 0))
SELECT {doc_id()}, {ZERO} AS _score FROM d, w WHERE list_has_any(tok, ws) AND lang <> 'fr'""")
sql("each_items_table", f"""
WITH {D},
st AS (SELECT count(*) FILTER (WHERE tok IS NOT NULL) AS n, CAST(sum(len(tok)) AS DOUBLE) AS sdl FROM d),
p AS (SELECT CAST(doc_id AS VARCHAR) AS _id, term, count(*) AS tf, len(tok) AS dl FROM (SELECT doc_id, tok, unnest(tok) AS term FROM d) GROUP BY ALL),
ts AS (SELECT term, count(*) AS df FROM p GROUP BY term),
i AS (SELECT term, CAST(sum(item_id % 3 + 1) AS DOUBLE) AS boost
      FROM (SELECT item_id, unnest(list_distinct({tok("array_to_string(string_split(text, ' ')[1:3], ' ')")})) AS term FROM benchmark) GROUP BY term)
SELECT p._id, round(sum(i.boost * {bm25('p.tf', 'p.dl', 'st.n', 'ts.df', '(st.sdl / CAST(st.n AS DOUBLE))')}), 6) AS _score
FROM i JOIN p USING (term) JOIN ts USING (term), st GROUP BY p._id""")
sql("page_and_total", f"""
WITH {D}, m AS (SELECT *, CAST(doc_id AS VARCHAR) AS _id, count(*) OVER () AS total FROM d WHERE {any_term('tok', ['ering', 'retion'])} AND lang = 'en'),
r AS (SELECT * FROM m ORDER BY n_chars DESC, _id LIMIT 25)
SELECT _id, n_chars, total, row_number() OVER (ORDER BY n_chars DESC, _id) = (SELECT count(*) FROM r) AS last, false AS empty FROM r""")
sql("bucketed_join", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus, count(*) AS n_items
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")

sql("source_dotted", f"""
SELECT CAST(event_id AS VARCHAR) AS _id, '{{"k":' || {K} || ',"of":{{"event_type":"' || event_type || '"}}}}' AS meta
FROM events ORDER BY event_id LIMIT 500""")


def chunks(text: str, size: int) -> str:
    """Fragments of at most ``size`` characters that end where a word ends, as the default fragmenter cuts them."""
    found = f"regexp_extract_all({text}, {q(rf'(?s)(?:[^ \t\n\f\r](?:.{{0,{size - 2}}}[^ \t\n\f\r])?(?:[ \t\n\f\r]|$)|[^ \t\n\f\r]{{1,{size}}})')})"
    return f"list_transform({found}, lambda f: regexp_replace(f, '[ \\t\\n\\f\\r]$', ''))"


def sentences(text: str) -> str:
    parts = f"string_split(regexp_replace({text}, '([.!?])[ \\t\\n\\f\\r]+', '\\1' || chr(1), 'g'), chr(1))"
    return f"list_filter({parts}, lambda f: length(trim(f)) > 0)"


def n_hits(f: str, terms: list[str]) -> str:
    return f"len(list_filter({tok(f)}, lambda w: list_contains([{', '.join(map(q, terms))}], w)))"


def fragment_query(frags: str, n: int, by_score: bool = False) -> str:
    kept = f"list_filter(frags, lambda f: {n_hits('f', EN)} > 0)"
    if by_score:      # most hits first, then by place
        ranked = f"list_sort(list_transform({kept}, lambda f, i: {{'k': -{n_hits('f', EN)}, 'i': i, 'f': f}}))"
        kept = f"list_transform({ranked}, lambda r: r.f)"
    return f"""{scored_docs(EN, ', text', any_term('tok', EN) + " AND lang = 'en'")},
t AS (SELECT _id, _score, {frags} AS frags FROM s ORDER BY _score DESC, _id ASC LIMIT 10),
k AS (SELECT _id, list_transform(({kept})[1:{n}], lambda f: {hl('f', EN)}) AS kept FROM t)
"""


sql("highlight_fragments", fragment_query(chunks("text", 80), 3) + """
SELECT _id, CAST(len(kept) AS BIGINT) AS n_fragments, array_to_string(kept, ' | ') AS text_hl FROM k""")
sql("highlight_boundary", fragment_query(sentences("text"), 2) + "SELECT _id, array_to_string(kept, ' | ') AS text_hl FROM k")
sql("highlight_order", fragment_query(chunks("text", 60), 2, by_score=True) + "SELECT _id, array_to_string(kept, ' | ') AS text_hl FROM k")

sql("deleted_count", "SELECT count(*) AS deleted, count(DISTINCT event_id) AS ids FROM events WHERE event_type = 'error'")

_both = "(CASE WHEN lang = 'en' AND n_chars >= 2000 THEN {both} WHEN lang = 'en' THEN {first} WHEN n_chars >= 2000 THEN {second} ELSE CAST(1 AS DOUBLE) END)"
_SCORE = {"multiply": 6.0, "sum": 5.0, "avg": 2.5, "max": 3.0, "min": 2.0, "first": 2.0}
_BOOST = {"multiply": "{q} * {f}", "replace": "{f}", "sum": "{q} + {f}", "avg": "({q} + {f}) / CAST(2 AS DOUBLE)",
          "max": "greatest({q}, {f})", "min": "least({q}, {f})"}


def mode_row(score_mode: str, boost_mode: str) -> str:
    f = _both.format(both=dbl(_SCORE[score_mode]), first=dbl(2), second=dbl(3))
    return (f"SELECT '{score_mode}/{boost_mode}' AS modes, {doc_id()}, round(({_BOOST[boost_mode].format(q=ms('a', [W1]), f=f)}) * {ONE}, 6) AS _score "
            f"FROM d, st_a WHERE {has(W1)}")


sql("function_score_modes", f"WITH {D}, {multi_stats({'a': [W1]})}\n" + "\nUNION ALL\n".join(
    [mode_row(m, "multiply") for m in _SCORE] + [mode_row("sum", m) for m in _BOOST if m != "multiply"]))

sql("index_lifecycle", """
WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS b FROM customer)
SELECT step, call, CAST(reply AS BIGINT) AS reply FROM c, LATERAL (VALUES (0, 'create', 1), (1, 'create again', 0), (2, 'read after write', n),
  (3, 'ids replied and read', n), (4, 'deleted by query', b), (5, 'left', n - b), (6, 'drop', 1), (7, 'drop again', 0)) v(step, call, reply)""")
