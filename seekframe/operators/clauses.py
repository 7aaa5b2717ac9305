"""Query clauses and their compilation to Spark Columns.

A clause is a tiny driver-side dataclass.  ``compile_clause(clause, ctx)``
turns it into two native expressions over the index rows:

* ``matched`` - BOOLEAN (null counts as not matched; negation uses
  ``~coalesce(m, false)`` so null rows are kept by ``must_not``);
* ``score``   - DOUBLE relevance, meaningful where ``matched``.

No data is touched while compiling.  Corpus statistics (N, average length,
document frequency) are scalar subqueries over the unfiltered index; Catalyst
merges all of them into one aggregate, so scoring costs one extra scan with a
single-row result and no join.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from typing import Any, Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.analysis import query_terms
from ..functions.highlight import Phrase
from ..functions.scoring import bm25, idf, tf_norm
from ..sources.index import Index, ResolvedField

# ---------------------------------------------------------------------------
# clause dataclasses
# ---------------------------------------------------------------------------


@dataclass
class Clause:
    pass


@dataclass
class Term(Clause):
    field: str
    value: Any
    boost: float | None = None
    case_insensitive: bool = False


@dataclass
class Terms(Clause):
    """Any of the values: a list, or a DataFrame of one column where there are many."""

    field: str
    values: list | DataFrame
    boost: float | None = None


@dataclass
class Match(Clause):
    field: str
    query: Any
    operator: str = "or"
    analyzer: str | None = None
    fuzziness: Any = None
    prefix_length: int = 0
    max_expansions: int | None = None
    minimum_should_match: Any = None
    boost: float | None = None


@dataclass
class MatchPhrase(Clause):
    field: str
    query: str
    analyzer: str | None = None
    boost: float | None = None


@dataclass
class MatchPhrasePrefix(Clause):
    field: str
    query: str
    analyzer: str | None = None
    boost: float | None = None


@dataclass
class MatchAll(Clause):
    boost: float | None = None


@dataclass
class MatchNone(Clause):
    pass


@dataclass
class Wildcard(Clause):
    field: str
    value: str
    boost: float | None = None
    case_insensitive: bool = False


@dataclass
class Range(Clause):
    field: str
    gte: Any = None
    gt: Any = None
    lte: Any = None
    lt: Any = None
    format: str | None = None
    time_zone: str | None = None
    boost: float | None = None


@dataclass
class Exists(Clause):
    field: str
    boost: float | None = None


@dataclass
class Bool(Clause):
    must: list = field(default_factory=list)
    should: list = field(default_factory=list)
    filter: list = field(default_factory=list)
    must_not: list = field(default_factory=list)
    minimum_should_match: Any = None
    adjust_pure_negative: bool = True
    boost: float | None = None


@dataclass
class MultiMatch(Clause):
    query: str
    fields: list
    type: str = "best_fields"
    operator: str = "or"
    tie_breaker: float = 0.0
    analyzer: str | None = None
    fuzziness: Any = None
    boost: float | None = None


@dataclass
class Nested(Clause):
    path: str
    query: Clause
    score_mode: str = "avg"
    boost: float | None = None


@dataclass
class ScoreFunction:
    weight: float
    filter: Clause | None = None


@dataclass
class FunctionScore(Clause):
    query: Clause | None = None
    functions: list = field(default_factory=list)
    score_mode: str = "multiply"
    boost_mode: str = "multiply"
    boost: float | None = None


@dataclass
class Raw(Clause):
    """Any boolean Column (and optionally a score Column) as a clause."""

    matched: Column
    score: Column | None = None
    boost: float | None = None


@dataclass
class Compiled:
    matched: Column
    score: Column


# ---------------------------------------------------------------------------
# conditional helpers (when / when_else / each)
# ---------------------------------------------------------------------------


def when(condition: bool, clause: Clause | Callable[[], Clause]) -> Clause | None:
    """The clause if ``condition`` holds, else nothing (dropped from bool lists)."""
    if not condition:
        return None
    return clause() if callable(clause) else clause


def when_else(condition: bool, if_true, if_false) -> Clause | None:
    chosen = if_true if condition else if_false
    return chosen() if callable(chosen) else chosen


def each(items: Iterable | None, fn: Callable[[Any], Clause]) -> list[Clause]:
    """One clause per item; ``None`` or empty gives no clause."""
    if not items:
        return []
    return [fn(it) for it in items]


def merge_multi_match(query: Clause | None, mm: "MultiMatch") -> Clause:
    """Root-level multi_match: set it when there is no query, append it to the
    ``must`` of an existing bool, else wrap both in a new bool's ``must``."""
    if query is None:
        return mm
    if isinstance(query, Bool):
        return Bool(list(_flat(query.must)) + [mm], query.should, query.filter, query.must_not,
                    query.minimum_should_match, query.adjust_pure_negative, query.boost)
    return Bool(must=[query, mm])


def _flat(items) -> list[Clause]:
    out: list[Clause] = []
    if items is None:
        return out
    if isinstance(items, Clause):
        return [items]
    for it in items:
        if it is None:
            continue
        if isinstance(it, (list, tuple)):
            out.extend(_flat(it))
        else:
            out.append(it)
    return out


# ---------------------------------------------------------------------------
# compile context
# ---------------------------------------------------------------------------


class Context:
    """Field resolution + statistics for one index (optionally inside a nested element)."""

    def __init__(self, index: Index, element: Column | None = None, element_path: str | None = None):
        self.index = index
        self.element = element
        self.element_path = element_path
        self._stats: dict[tuple, Column] = {}

    @property
    def scoring(self) -> bool:
        # inside a nested element there are no corpus statistics: constant scores
        return self.element is None

    def field(self, path: str, like: Any = None) -> ResolvedField:
        return self.index.field(path, self.element, self.element_path, like)

    def for_element(self, path: str, var: Column) -> "Context":
        return Context(self.index, var, path)

    # ---- statistics as scalar subqueries (merged into one aggregate) ----
    def _scalar(self, key: tuple, agg: Column) -> Column:
        if key not in self._stats:
            self._stats[key] = self.index.df.agg(agg).scalar()
        return self._stats[key]

    def n_docs(self, rf: ResolvedField) -> Column:
        stored = self._stored("n_docs", rf.path)
        if stored is not None:
            return stored
        present = rf.tokens.isNotNull() if rf.tokens is not None else rf.value.isNotNull()
        return self._scalar(("n", rf.path), F.count_if(present))

    def avgdl(self, rf: ResolvedField) -> Column:
        stored = self._stored("avgdl", rf.path)
        if stored is not None:
            return stored
        total = self._scalar(("sdl", rf.path), F.sum(F.size(rf.tokens)).cast("double"))
        return total / self.n_docs(rf).cast("double")

    def df(self, rf: ResolvedField, term: Any, on_tokens: bool = True) -> Column:
        stored = self._stored("df", rf.path, term) if on_tokens else None
        if stored is not None:
            return stored
        if on_tokens and rf.tokens is not None:
            pred = F.array_contains(rf.tokens, F.lit(term))
        elif rf.is_array:
            pred = F.array_contains(rf.predicate_value, F.lit(term))
        else:
            pred = rf.predicate_value == F.lit(term)
        return self._scalar(("df", rf.path, term, on_tokens), F.count_if(pred))

    def _stored(self, kind: str, path: str, term: Any = None) -> Column | None:
        tables = self.index.stats
        if tables is None or not hasattr(tables, "scalar"):
            return None
        return tables.scalar(kind, path, term)


def _boost(c: Clause) -> float:
    b = getattr(c, "boost", None)
    return 1.0 if b is None else float(b)


def _lit_for(rf: ResolvedField, value):
    v = rf.normalise_literal(value)
    et = rf.element_type
    if isinstance(et, (T.TimestampType, T.TimestampNTZType)):
        return _date_literal(v, None, None, et, rf)[0]
    return F.lit(v).cast(et) if not isinstance(et, T.StringType) else F.lit(v if isinstance(v, str) else str(v))


def _any(rf: ResolvedField, pred: Callable[[Column], Column]) -> Column:
    v = rf.predicate_value
    return F.exists(v, pred) if rf.is_array else pred(v)


def _text_term_score(ctx: Context, rf: ResolvedField, terms: list[str], boost: float):
    """tf, per-term BM25 and their sum for analysed terms against a text field."""
    tokens = rf.tokens
    tfs = [F.size(F.filter(tokens, _eq(t))) for t in terms]
    if ctx.scoring:
        dl = F.size(tokens)
        n, avg = ctx.n_docs(rf), ctx.avgdl(rf)
        parts = [bm25(tf, dl, n, ctx.df(rf, t), avg) for tf, t in zip(tfs, terms)]
    else:
        parts = [F.when(tf > 0, F.lit(1.0)).otherwise(F.lit(0.0)) for tf in tfs]
    return tfs, parts


def _eq(t: str):
    lit = F.lit(t)
    return lambda x: x == lit


def _sum(cols: list[Column]) -> Column:
    if not cols:
        return F.lit(0.0)
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def _and(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out & c
    return out


def _or(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out | c
    return out


def _scored(c: Compiled) -> Column:
    return F.when(c.matched, c.score).otherwise(F.lit(0.0))


def resolve_msm(spec: Any, n_optional: int) -> int:
    """minimum_should_match: ``n``, ``-n``, ``n%``, ``-n%`` (percent rounded down)."""
    if spec is None:
        return 0
    if isinstance(spec, (int, float)) and not isinstance(spec, bool):
        n = int(spec)
    else:
        s = str(spec).strip()
        if s.endswith("%"):
            pct = float(s[:-1])
            n = int(math.floor(n_optional * abs(pct) / 100.0))
            n = n_optional - n if pct < 0 else n
        else:
            n = int(s)
    if n < 0:
        n = n_optional + n
    return max(0, min(n, n_optional)) if n_optional else max(0, n)


# ---------------------------------------------------------------------------
# date literals
# ---------------------------------------------------------------------------

_TIME_LETTERS = set("HhKkmsSaA")


def _is_date_only(value, fmt: str | None) -> bool:
    if isinstance(value, datetime):
        return False
    if isinstance(value, date):
        return True
    if fmt:
        if fmt in ("epoch_millis", "epoch_second"):
            return False
        return not any(ch in _TIME_LETTERS for ch in fmt.replace("'T'", ""))
    return isinstance(value, str) and re.fullmatch(r"\d{4}-\d{2}-\d{2}", value.strip()) is not None


def _instant(value, fmt: str | None) -> datetime | None:
    """UTC wall time of a literal that names its own offset (``Z``, ``+05:00``); else None.  An offset beats a time zone."""
    if isinstance(value, str) and not fmt and re.search(r"T?\d{2}:\d{2}.*([zZ]|[+-]\d{2}:?\d{2})$", value.strip()):
        try:
            value = datetime.fromisoformat(value.strip())
        except ValueError:
            return None
    if isinstance(value, datetime) and value.tzinfo is not None:
        return value.astimezone(timezone.utc).replace(tzinfo=None)
    return None


def _date_literal(value, fmt, tz, target: T.DataType, rf=None) -> tuple[Column, bool]:
    """Foldable timestamp literal of the column's type, and whether it is date-only.

    The conversion is kept on the literal side so the comparison stays a plain
    ``column op literal`` that Catalyst pushes into the parquet scan.
    """
    date_only = _is_date_only(value, fmt)
    if isinstance(value, (int, float)) and not isinstance(value, bool) or fmt == "epoch_millis":
        ms = int(value)
        wall = (datetime(1970, 1, 1) + timedelta(milliseconds=ms)).isoformat(sep=" ")
        ntz = F.to_timestamp_ntz(F.lit(wall))
    elif fmt == "epoch_second":
        wall = (datetime(1970, 1, 1) + timedelta(seconds=int(value))).isoformat(sep=" ")
        ntz = F.to_timestamp_ntz(F.lit(wall))
    elif (instant := _instant(value, fmt)) is not None:
        ntz, tz = F.to_timestamp_ntz(F.lit(instant.isoformat(sep=" "))), None
    elif isinstance(value, datetime):
        ntz = F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))
    elif isinstance(value, date):
        ntz = F.to_timestamp_ntz(F.lit(value.isoformat()))
    elif fmt:
        ntz = F.to_timestamp_ntz(F.lit(str(value)), F.lit(fmt))
    else:
        ntz = F.to_timestamp_ntz(F.lit(str(value)))
    if tz:
        # the literal is wall time in ``tz``; stored NTZ values are UTC wall time
        ntz = F.convert_timezone(F.lit(tz), F.lit("UTC"), ntz)
    if isinstance(target, T.TimestampType):
        # LTZ column: shift the UTC wall time to session wall time, then cast
        return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ntz).cast("timestamp"), date_only
    if isinstance(target, T.DateType):
        return ntz.cast("date"), date_only
    return ntz, date_only


# ---------------------------------------------------------------------------
# leaves
# ---------------------------------------------------------------------------


def _wildcard_to_like(pattern: str) -> str:
    out = []
    for ch in pattern:
        if ch == "*":
            out.append("%")
        elif ch == "?":
            out.append("_")
        elif ch in "%_\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def _c_term(c: Term, ctx: Context) -> Compiled:
    rf = ctx.field(c.field, c.value)
    boost = _boost(c)
    if rf.is_text:
        v = str(c.value)
        if c.case_insensitive:
            matched = F.exists(rf.tokens, lambda x: F.lower(x) == F.lit(v.lower()))
            return Compiled(matched, F.lit(boost))
        matched = F.array_contains(rf.tokens, F.lit(v))
        _, parts = _text_term_score(ctx, rf, [v], boost)
        return Compiled(matched, parts[0] * F.lit(boost))
    lit = _lit_for(rf, c.value)
    if c.case_insensitive and isinstance(rf.element_type, T.StringType):
        low = F.lit(str(c.value).lower())
        matched = _any(rf, lambda x: F.lower(x) == low)
    else:
        matched = _any(rf, lambda x: x == lit)
    if isinstance(rf.element_type, T.StringType) and ctx.scoring:
        # keyword: BM25 with tf = 1 and no length normalisation = idf
        score = idf(ctx.n_docs(rf), ctx.df(rf, rf.normalise_literal(c.value), on_tokens=False)) * F.lit(boost)
    else:
        score = F.lit(boost)
    return Compiled(matched, score)


def _c_terms(c: Terms, ctx: Context) -> Compiled:
    if isinstance(c.values, DataFrame):
        return _c_terms_of(c, ctx)
    vals = list(c.values or [])
    rf = ctx.field(c.field, vals[0] if vals else None)
    if not vals:
        return Compiled(F.lit(False), F.lit(0.0))
    if rf.is_text:
        arr = F.array(*[F.lit(str(v)) for v in vals])
        return Compiled(F.arrays_overlap(rf.tokens, arr), F.lit(_boost(c)))
    lits = [_lit_for(rf, v) for v in vals]
    if rf.is_array:
        matched = F.arrays_overlap(rf.predicate_value, F.array(*lits))
    else:
        matched = rf.predicate_value.isin(*lits)
    return Compiled(matched, F.lit(_boost(c)))


def _c_terms_of(c: Terms, ctx: Context) -> Compiled:
    """Values from a table, as a subquery that Spark plans as a semi join (or an existence join inside other clauses)."""
    name = c.values.columns[0]
    sample = {"double": 0.0, "float": 0.0, "bigint": 0, "int": 0, "boolean": True}.get(c.values.dtypes[0][1], "")
    rf = ctx.field(c.field, sample)
    value = F.col(f"`{name}`").cast("string" if rf.is_text else rf.element_type)
    if rf.spec.normalizer in ("lowercase", "lower"):
        value = F.lower(value)
    values = c.values.select(value.alias("_value")).filter("_value is not null").distinct()
    if not rf.is_text and not rf.is_array:
        return Compiled(rf.predicate_value.isin(values), F.lit(_boost(c)))
    if ctx.element is not None:
        raise ValueError(f"{c.field}: a table of values needs one value a row or element")
    # documents by the terms they hold: no subquery goes into a row's array
    held = ctx.index.df.select("_id", F.explode(rf.tokens if rf.is_text else rf.predicate_value).alias("_value"))
    return Compiled(F.col("_id").isin(held.join(values, "_value", "left_semi").select("_id")), F.lit(_boost(c)))


def fuzzy_max_edits(term: str, fuzziness) -> int:
    """Edits allowed for ``term``; ``AUTO`` = 0 below 3 chars, 1 for 3-5, 2 above."""
    if fuzziness is None:
        return 0
    f = str(fuzziness).upper()
    if f.startswith("AUTO"):
        lo, hi = 3, 6
        if ":" in f:
            lo, hi = (int(x) for x in f.split(":", 1)[1].split(","))
        n = len(term)
        return 0 if n < lo else (1 if n < hi else 2)
    return int(float(f))


def fuzzy_expansions(ctx: Context, rf: ResolvedField, term: str, edits: int,
                     prefix_length: int, max_expansions: int | None) -> Column:
    """Vocabulary terms, each with its document frequency, within ``edits`` of ``term`` sharing its first
    ``prefix_length`` characters: all of them, or the ``max_expansions`` most frequent.

    The vocabulary is the stored term table when the index has one, else the
    distinct tokens of the index.  Candidates are blocked on length and prefix
    before the (thresholded) edit distance is computed; the result is a
    scalar subquery, one entry for each vocabulary term that close to ``term``.
    """
    vocab = ctx.index.stats.vocabulary(rf.path) if getattr(ctx.index, "stats", None) is not None else None
    if vocab is None:
        vocab = (ctx.index.df.select(F.explode(F.array_distinct(rf.tokens)).alias("term"))
                 .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    q = F.lit(term)
    cand = vocab.filter(F.abs(F.length("term") - F.lit(len(term))) <= edits)
    if prefix_length > 0:
        cand = cand.filter(F.substring("term", 1, prefix_length) == F.lit(term[:prefix_length]))
    cand = cand.filter(F.levenshtein(F.col("term"), q, edits) >= 0)
    top = cand if max_expansions is None else cand.orderBy(F.desc("df"), F.asc("term")).limit(max_expansions)
    return top.agg(F.map_from_entries(F.collect_list(F.struct("term", F.col("df").cast("bigint"))))).scalar()


def _expansion_column(c: Match, term: str) -> str:
    """Name of the column that holds a term's expansions (:func:`prepare`)."""
    return f"_fuzzy_{zlib.crc32(repr((c.field, term, fuzzy_max_edits(term, c.fuzziness), c.prefix_length, c.max_expansions)).encode()):08x}"


def _expansion_score(tokens: Column, exp: Column, n: Column, avg: Column) -> Column:
    """Every expansion is scored like a term, with its own document frequency."""
    def more(total: Column, word: Column) -> Column:
        return total + bm25(F.size(F.filter(tokens, lambda x: x == word)), F.size(tokens), n, exp[word], avg)

    return F.aggregate(F.array_intersect(tokens, F.map_keys(exp)), F.lit(0.0), more)


def _c_match(c: Match, ctx: Context) -> Compiled:
    rf = ctx.field(c.field)
    boost = _boost(c)
    if not rf.is_text:
        # keyword / numeric / date: the whole query is one term
        return _c_term(Term(c.field, c.query, c.boost), ctx)
    terms = query_terms(str(c.query), c.analyzer or rf.search_analyzer, ctx.index.analyzers)
    if not terms:
        return Compiled(F.lit(False), F.lit(0.0))
    tokens = rf.tokens
    if c.fuzziness is not None and any(fuzzy_max_edits(t, c.fuzziness) > 0 for t in terms):
        hits, scores = [], []
        for t in terms:
            k = fuzzy_max_edits(t, c.fuzziness)
            if k == 0:
                hits.append(F.array_contains(tokens, F.lit(t)))
                scores.append(_text_term_score(ctx, rf, [t], boost)[1][0])
                continue
            name = _expansion_column(c, t)
            known = ctx.element is None and name in ctx.index.df.columns
            exp = F.col(name) if known else fuzzy_expansions(ctx, rf, t, k, c.prefix_length, c.max_expansions)
            hits.append(F.arrays_overlap(tokens, F.map_keys(exp)))
            scores.append(_expansion_score(tokens, exp, F.col(f"{name}_n"), F.col(f"{name}_avgdl")) if known else F.lit(1.0))
        hit_n = _sum([F.when(h, F.lit(1)).otherwise(F.lit(0)) for h in hits])
        need = len(terms) if c.operator.lower() == "and" else max(1, resolve_msm(c.minimum_should_match, len(terms)))
        score = _sum([F.when(h, x).otherwise(F.lit(0.0)) for h, x in zip(hits, scores)])
        return Compiled(hit_n >= need, score * F.lit(boost))
    tfs, parts = _text_term_score(ctx, rf, terms, boost)
    if c.operator.lower() == "and":
        matched = _and([F.array_contains(tokens, F.lit(t)) for t in terms])
    elif c.minimum_should_match is not None:
        need = max(1, resolve_msm(c.minimum_should_match, len(terms)))
        matched = _sum([F.when(tf > 0, F.lit(1)).otherwise(F.lit(0)) for tf in tfs]) >= need
    else:
        matched = F.arrays_overlap(tokens, F.array(*[F.lit(t) for t in terms]))
    return Compiled(matched, _sum(parts) * F.lit(boost))


def _padded(tokens: Column) -> Column:
    """' t1  t2  t3 ': every token wrapped in single spaces, so a phrase is a substring."""
    return F.concat(F.lit(" "), F.array_join(tokens, "  "), F.lit(" "))


def phrase_needle(terms: list[str]) -> str:
    return "".join(f" {t} " for t in terms)


def _c_phrase(c: MatchPhrase, ctx: Context) -> Compiled:
    rf = ctx.field(c.field)
    boost = _boost(c)
    an = c.analyzer or rf.search_analyzer
    seq = ctx.index.analyzers.get(an).terms(str(c.query)) if rf.is_text else [str(c.query)]
    if not seq:
        return Compiled(F.lit(False), F.lit(0.0))
    if not rf.is_text:
        return _c_term(Term(c.field, c.query, c.boost), ctx)
    padded = _padded(rf.tokens)
    needle = phrase_needle(seq)
    # rows without all the words never build the padded text
    matched = _and([F.array_contains(rf.tokens, F.lit(t)) for t in dict.fromkeys(seq)]) & F.contains(padded, F.lit(needle))
    if not ctx.scoring:
        return Compiled(matched, F.lit(boost))
    freq = F.floor((F.length(padded) - F.length(F.replace(padded, F.lit(needle), F.lit(""))))
                   / F.lit(len(needle)))
    n, avg = ctx.n_docs(rf), ctx.avgdl(rf)
    w = _sum([idf(n, ctx.df(rf, t)) for t in dict.fromkeys(seq)])
    score = F.when(matched & (freq > 0), w * tf_norm(freq, F.size(rf.tokens), avg)).otherwise(F.lit(0.0))
    return Compiled(matched, score * F.lit(boost))


def _c_phrase_prefix(c: MatchPhrasePrefix, ctx: Context) -> Compiled:
    rf = ctx.field(c.field)
    boost = _boost(c)
    an = c.analyzer or rf.search_analyzer
    seq = ctx.index.analyzers.get(an).terms(str(c.query)) if rf.is_text else [str(c.query)]
    if not seq:
        return Compiled(F.lit(False), F.lit(0.0))
    if not rf.is_text:
        pat = _wildcard_to_like(str(c.query)) + "%"
        return Compiled(_any(rf, lambda x: x.like(pat)), F.lit(boost))
    needle = phrase_needle(seq[:-1]) + " " + seq[-1]
    return Compiled(F.contains(_padded(rf.tokens), F.lit(needle)), F.lit(boost))


def _c_wildcard(c: Wildcard, ctx: Context) -> Compiled:
    rf = ctx.field(c.field)
    pat = _wildcard_to_like(str(c.value))
    if rf.is_text:
        if c.case_insensitive:
            matched = F.exists(rf.tokens, lambda x: x.ilike(pat))
        else:
            matched = F.exists(rf.tokens, lambda x: x.like(pat))
    else:
        if c.case_insensitive:
            matched = _any(rf, lambda x: x.ilike(pat))
        else:
            matched = _any(rf, lambda x: x.like(pat))
    return Compiled(matched, F.lit(_boost(c)))


def _c_range(c: Range, ctx: Context) -> Compiled:
    rf = ctx.field(c.field, next((v for v in (c.gte, c.gt, c.lte, c.lt) if v is not None), None))
    et = rf.element_type
    conds: list[Callable[[Column], Column]] = []
    is_time = isinstance(et, (T.TimestampType, T.TimestampNTZType, T.DateType))
    for op, raw in (("gte", c.gte), ("gt", c.gt), ("lte", c.lte), ("lt", c.lt)):
        if raw is None:
            continue
        if is_time:
            lit, date_only = _date_literal(raw, c.format, c.time_zone, et)
            if date_only and op in ("lte", "gt") and not isinstance(et, T.DateType):
                # a bare date as upper bound covers the whole day
                nxt = lit + F.expr("INTERVAL 1 DAY")
                op = "lt" if op == "lte" else "gte"
                lit = nxt
        else:
            lit = F.lit(raw).cast(et) if not isinstance(et, T.StringType) else F.lit(str(raw))
        conds.append(_cmp(op, lit))
    if not conds:
        return Compiled(_any(rf, lambda x: x.isNotNull()), F.lit(_boost(c)))
    matched = _any(rf, lambda x: _and([f(x) for f in conds]))
    return Compiled(matched, F.lit(_boost(c)))


def _cmp(op: str, lit: Column):
    if op == "gte":
        return lambda x: x >= lit
    if op == "gt":
        return lambda x: x > lit
    if op == "lte":
        return lambda x: x <= lit
    return lambda x: x < lit


def _c_exists(c: Exists, ctx: Context) -> Compiled:
    rf = ctx.field(c.field)
    v = rf.predicate_value
    if isinstance(rf.data_type, T.ArrayType):
        matched = v.isNotNull() & (F.size(F.filter(v, lambda x: x.isNotNull())) > 0)
    else:
        matched = v.isNotNull()
    return Compiled(matched, F.lit(_boost(c)))


# ---------------------------------------------------------------------------
# compound
# ---------------------------------------------------------------------------


def _c_bool(c: Bool, ctx: Context) -> Compiled:
    must = [compile_clause(x, ctx) for x in _flat(c.must)]
    should = [compile_clause(x, ctx) for x in _flat(c.should)]
    filt = [compile_clause(x, ctx) for x in _flat(c.filter)]
    must_not = [compile_clause(x, ctx) for x in _flat(c.must_not)]
    boost = _boost(c)
    if not (must or should or filt or must_not):
        return Compiled(F.lit(True), F.lit(boost))
    conds: list[Column] = [x.matched for x in must] + [x.matched for x in filt]
    conds += [~F.coalesce(x.matched, F.lit(False)) for x in must_not]
    if must_not and not (must or should or filt) and not c.adjust_pure_negative:
        return Compiled(F.lit(False), F.lit(0.0))
    if should:
        default = 1 if not (must or filt) else 0
        need = default if c.minimum_should_match is None else resolve_msm(c.minimum_should_match, len(should))
        if need > 0:
            hits = _sum([F.when(x.matched, F.lit(1)).otherwise(F.lit(0)) for x in should])
            conds.append(hits >= F.lit(need))
    matched = _and(conds) if conds else F.lit(True)
    scoring = must + should
    if scoring:
        score = _sum([_scored(x) for x in scoring])
    elif must_not and not filt:
        score = F.lit(1.0)  # pure negative scores like match_all
    else:
        score = F.lit(0.0)
    return Compiled(matched, score * F.lit(boost))


def parse_fields(fields) -> list[tuple[str, float]]:
    out = []
    for f in fields:
        if isinstance(f, str):
            name, _, b = f.partition("^")
            out.append((name, float(b) if b else 1.0))
        elif isinstance(f, dict):
            out.append((f["field"], 1.0 if f.get("boost") is None else float(f["boost"])))
        else:
            name, b = f
            out.append((name, 1.0 if b is None else float(b)))
    return out


def _c_multi_match(c: MultiMatch, ctx: Context) -> Compiled:
    fields = parse_fields(c.fields)
    boost = _boost(c)
    kind = c.type
    if kind in ("best_fields", "most_fields"):
        per = [(compile_clause(Match(f, c.query, c.operator, c.analyzer, c.fuzziness), ctx), b)
               for f, b in fields]
    elif kind == "phrase":
        per = [(compile_clause(MatchPhrase(f, c.query, c.analyzer), ctx), b) for f, b in fields]
    elif kind == "phrase_prefix":
        per = [(compile_clause(MatchPhrasePrefix(f, c.query, c.analyzer), ctx), b) for f, b in fields]
    elif kind == "bool_prefix":
        per = [(_bool_prefix(f, c, ctx), b) for f, b in fields]
    elif kind == "cross_fields":
        return _cross_fields(c, fields, ctx)
    else:
        raise ValueError(f"unknown multi_match type {kind}")
    matched = _or([m.matched for m, _ in per])
    scores = [_scored(m) * F.lit(b) for m, b in per]
    if kind == "most_fields":
        score = _sum(scores)
    else:
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        score = best if not c.tie_breaker else best + F.lit(c.tie_breaker) * (_sum(scores) - best)
    return Compiled(matched, score * F.lit(boost))


def _bool_prefix(fname: str, c: MultiMatch, ctx: Context) -> Compiled:
    rf = ctx.field(fname)
    terms = query_terms(str(c.query), c.analyzer or rf.search_analyzer, ctx.index.analyzers)
    if not terms:
        return Compiled(F.lit(False), F.lit(0.0))
    tokens = rf.tokens if rf.is_text else F.array(rf.value.cast("string"))
    hits = [F.exists(tokens, _startswith(t)) for t in terms]
    n = _sum([F.when(h, F.lit(1.0)).otherwise(F.lit(0.0)) for h in hits])
    matched = _and(hits) if c.operator.lower() == "and" else _or(hits)
    return Compiled(matched, n)


def _startswith(t: str):
    lit = F.lit(t)
    return lambda x: F.startswith(x, lit)


def _cross_fields(c: MultiMatch, fields: list[tuple[str, float]], ctx: Context) -> Compiled:
    rfs = [(ctx.field(f), b) for f, b in fields]
    text_fields = [(rf, b) for rf, b in rfs if rf.is_text]
    an = c.analyzer or (text_fields[0][0].search_analyzer if text_fields else None)
    terms = query_terms(str(c.query), an, ctx.index.analyzers)
    if not terms or not text_fields:
        return Compiled(F.lit(False), F.lit(0.0))
    per_term_hit, per_term_score = [], []
    for t in terms:
        hits, scores = [], []
        for rf, b in text_fields:
            _, parts = _text_term_score(ctx, rf, [t], b)
            hits.append(F.array_contains(rf.tokens, F.lit(t)))
            scores.append(parts[0] * F.lit(b))
        per_term_hit.append(_or(hits))
        per_term_score.append(F.greatest(*scores) if len(scores) > 1 else scores[0])
    matched = _and(per_term_hit) if c.operator.lower() == "and" else _or(per_term_hit)
    return Compiled(matched, _sum(per_term_score) * F.lit(_boost(c)))


def _c_nested(c: Nested, ctx: Context) -> Compiled:
    arr = ctx.field(c.path).value

    def inner(e):
        return compile_clause(c.query, ctx.for_element(c.path, e))

    matched = F.exists(arr, lambda e: F.coalesce(inner(e).matched, F.lit(False)))
    mode = c.score_mode
    if mode == "none":
        score = F.lit(0.0)
    else:
        scores = F.transform(F.filter(arr, lambda e: F.coalesce(inner(e).matched, F.lit(False))),
                             lambda e: inner(e).score.cast("double"))
        total = F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + x)
        if mode == "sum":
            score = total
        elif mode == "max":
            score = F.array_max(scores)
        elif mode == "min":
            score = F.array_min(scores)
        else:
            score = total / F.size(scores)
    return Compiled(matched, score * F.lit(_boost(c)))


def _c_function_score(c: FunctionScore, ctx: Context) -> Compiled:
    base = compile_clause(c.query or MatchAll(), ctx)
    vals = []
    for fn in c.functions:
        if isinstance(fn, dict):
            fn = ScoreFunction(weight=fn.get("weight", 1.0), filter=fn.get("filter"))
        w = F.lit(float(fn.weight))
        if fn.filter is None:
            vals.append(w)
        else:
            vals.append(F.when(F.coalesce(compile_clause(fn.filter, ctx).matched, F.lit(False)), w))
    if vals:
        arr = F.filter(F.array(*vals), lambda x: x.isNotNull())
        mode = c.score_mode
        if mode == "sum":
            comb = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)
        elif mode == "avg":
            comb = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr)
        elif mode == "max":
            comb = F.array_max(arr)
        elif mode == "min":
            comb = F.array_min(arr)
        elif mode == "first":
            comb = F.element_at(arr, 1)
        elif mode == "multiply":
            comb = F.aggregate(arr, F.lit(1.0), lambda a, x: a * x)
        else:
            raise ValueError(f"unknown score_mode {mode}")
        fscore = F.when(F.size(arr) > 0, comb).otherwise(F.lit(1.0))
    else:
        fscore = F.lit(1.0)
    q = base.score
    bm = c.boost_mode
    if bm == "multiply":
        score = q * fscore
    elif bm == "replace":
        score = fscore
    elif bm == "sum":
        score = q + fscore
    elif bm == "avg":
        score = (q + fscore) / F.lit(2.0)
    elif bm == "max":
        score = F.greatest(q, fscore)
    elif bm == "min":
        score = F.least(q, fscore)
    else:
        raise ValueError(f"unknown boost_mode {bm}")
    return Compiled(base.matched, score * F.lit(_boost(c)))


def _c_raw(c: Raw, ctx: Context) -> Compiled:
    score = c.score if c.score is not None else F.lit(1.0)
    return Compiled(c.matched, score.cast("double") * F.lit(_boost(c)))


_COMPILERS: dict[type, Callable[[Any, Context], Compiled]] = {
    Term: _c_term,
    Terms: _c_terms,
    Match: _c_match,
    MatchPhrase: _c_phrase,
    MatchPhrasePrefix: _c_phrase_prefix,
    MatchAll: lambda c, ctx: Compiled(F.lit(True), F.lit(_boost(c))),
    MatchNone: lambda c, ctx: Compiled(F.lit(False), F.lit(0.0)),
    Wildcard: _c_wildcard,
    Range: _c_range,
    Exists: _c_exists,
    Bool: _c_bool,
    MultiMatch: _c_multi_match,
    Nested: _c_nested,
    FunctionScore: _c_function_score,
    Raw: _c_raw,
}


def compile_clause(clause: Clause | dict | None, ctx: Context) -> Compiled:
    if clause is None:
        return Compiled(F.lit(True), F.lit(1.0))
    if isinstance(clause, dict):
        clause = from_dict(clause)
    fn = _COMPILERS.get(type(clause))
    if fn is None:
        raise TypeError(f"not a clause: {clause!r}")
    out = fn(clause, ctx)
    return Compiled(out.matched, out.score.cast("double"))


# ---------------------------------------------------------------------------
# request-dict form ({"match": {"title": {"query": ...}}})
# ---------------------------------------------------------------------------


def _field_body(body: dict, key: str = "value") -> tuple[str, dict]:
    (fname, spec), = [(k, v) for k, v in body.items() if k not in ("boost", "_name")]
    if not isinstance(spec, dict):
        spec = {key: spec}
    return fname, spec


def from_dict(d: dict) -> Clause:
    """Clause from the JSON request form, for the kinds of this module."""
    if not isinstance(d, dict) or len(d) != 1:
        raise ValueError("a query object has exactly one kind")
    (kind, body), = d.items()
    if kind == "term":
        f, s = _field_body(body)
        return Term(f, s["value"], s.get("boost"), s.get("case_insensitive", False))
    if kind == "terms":
        boost = body.get("boost")
        (f, vals), = [(k, v) for k, v in body.items() if k != "boost"]
        return Terms(f, list(vals), boost)
    if kind == "match":
        f, s = _field_body(body, "query")
        return Match(f, s["query"], s.get("operator", "or"), s.get("analyzer"), s.get("fuzziness"),
                     s.get("prefix_length", 0), s.get("max_expansions"),
                     s.get("minimum_should_match"), s.get("boost"))
    if kind == "match_phrase":
        f, s = _field_body(body, "query")
        return MatchPhrase(f, s["query"], s.get("analyzer"), s.get("boost"))
    if kind == "match_phrase_prefix":
        f, s = _field_body(body, "query")
        return MatchPhrasePrefix(f, s["query"], s.get("analyzer"), s.get("boost"))
    if kind == "match_all":
        return MatchAll((body or {}).get("boost"))
    if kind == "match_none":
        return MatchNone()
    if kind == "wildcard":
        f, s = _field_body(body)
        return Wildcard(f, s.get("value", s.get("wildcard")), s.get("boost"), s.get("case_insensitive", False))
    if kind == "range":
        f, s = _field_body(body)
        return Range(f, s.get("gte"), s.get("gt"), s.get("lte"), s.get("lt"), s.get("format"),
                     s.get("time_zone"), s.get("boost"))
    if kind == "exists":
        return Exists(body["field"], body.get("boost"))
    if kind == "bool":
        conv = lambda v: [from_dict(x) for x in (v if isinstance(v, list) else [v])] if v else []
        return Bool(conv(body.get("must")), conv(body.get("should")), conv(body.get("filter")),
                    conv(body.get("must_not")), body.get("minimum_should_match"),
                    body.get("adjust_pure_negative", True), body.get("boost"))
    if kind == "multi_match":
        return MultiMatch(body["query"], body["fields"], body.get("type", "best_fields"),
                          body.get("operator", "or"), body.get("tie_breaker", 0.0), body.get("analyzer"),
                          body.get("fuzziness"), body.get("boost"))
    if kind == "nested":
        return Nested(body["path"], from_dict(body["query"]), body.get("score_mode", "avg"), body.get("boost"))
    if kind == "function_score":
        fns = [ScoreFunction(f.get("weight", 1.0), from_dict(f["filter"]) if f.get("filter") else None)
               for f in body.get("functions", [])]
        return FunctionScore(from_dict(body["query"]) if body.get("query") else None, fns,
                             body.get("score_mode", "multiply"), body.get("boost_mode", "multiply"),
                             body.get("boost"))
    raise ValueError(f"unsupported query kind {kind}")


def referenced_fields(clause) -> list[str]:
    """Field paths a clause reads at the top level (nested element fields excluded)."""
    out: list[str] = []

    def walk(c):
        if c is None:
            return
        if isinstance(c, dict):
            c = from_dict(c)
        if isinstance(c, (Term, Terms, Match, MatchPhrase, MatchPhrasePrefix, Wildcard, Exists, Range)):
            out.append(c.field)
        elif isinstance(c, MultiMatch):
            out.extend(f for f, _ in parse_fields(c.fields))
        elif isinstance(c, Bool):
            for x in _flat(c.must) + _flat(c.should) + _flat(c.filter) + _flat(c.must_not):
                walk(x)
        elif isinstance(c, FunctionScore):
            walk(c.query)
            for fn in c.functions:
                walk(fn.get("filter") if isinstance(fn, dict) else fn.filter)

    walk(clause)
    return list(dict.fromkeys(out))


def _fuzzy_matches(clause) -> list[Match]:
    """The fuzzy matches of a clause outside nested queries, those of multi_match included."""
    clause = from_dict(clause) if isinstance(clause, dict) else clause
    if isinstance(clause, Match):
        return [clause] if clause.fuzziness is not None else []
    if isinstance(clause, MultiMatch):
        return [m for f, _ in parse_fields(clause.fields)
                for m in _fuzzy_matches(Match(f, clause.query, analyzer=clause.analyzer, fuzziness=clause.fuzziness))]
    if isinstance(clause, Bool):
        return [m for part in (clause.must, clause.should, clause.filter, clause.must_not) for x in _flat(part) for m in _fuzzy_matches(x)]
    if isinstance(clause, FunctionScore):
        return [m for x in (clause.query, *(f.get("filter") if isinstance(f, dict) else f.filter for f in clause.functions))
                if x is not None for m in _fuzzy_matches(x)]
    return []


def prepare(index: Index, clause) -> Index:
    """The index with token columns for every text field the clause reads.

    Expansions of fuzzy terms and the statistics that score them stand beside
    them as columns, since Spark lets no subquery into the lambda that scores
    a row's words; one ``Generate`` keeps the optimizer from moving them there."""
    index = index.with_tokens(referenced_fields(clause))
    ctx, more = Context(index), {}
    for c in _fuzzy_matches(clause):
        rf = ctx.field(c.field)
        if not rf.is_text:
            continue
        for t in query_terms(str(c.query), c.analyzer or rf.search_analyzer, index.analyzers):
            edits, name = fuzzy_max_edits(t, c.fuzziness), _expansion_column(c, t)
            if edits and name not in more:
                more[name] = fuzzy_expansions(ctx, rf, t, edits, c.prefix_length, c.max_expansions)
                more[f"{name}_n"], more[f"{name}_avgdl"] = ctx.n_docs(rf), ctx.avgdl(rf)
    if not more:
        return index
    return index.with_df(index.df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in more.items()])))))


# ---------------------------------------------------------------------------
# terms to highlight
# ---------------------------------------------------------------------------


def highlight_terms(clause: Clause | None, fname: str, index: Index) -> tuple[list[str], list[str], list[Phrase]]:
    """(exact terms, wildcard patterns, phrases) that ``clause`` looks for in ``fname``."""
    terms: list[str] = []
    pats: list[str] = []
    phrases: list[Phrase] = []

    def phrase(q, analyzer, prefix=False):
        """A phrase's words in order; a phrase of one word is a term or a prefix."""
        try:
            rf = index.field(fname)
            analyzer = analyzer or rf.search_analyzer
        except ValueError:
            pass
        seq = index.analyzers.get(analyzer).terms(str(q))
        if len(seq) > 1:
            phrases.append((tuple(seq), prefix))
        else:
            (pats if prefix else terms).extend(t + "*" if prefix else t for t in seq)

    def an_terms(q, analyzer, rf_name):
        try:
            rf = index.field(rf_name)
            a = analyzer or rf.search_analyzer
        except ValueError:
            a = analyzer
        return query_terms(str(q), a, index.analyzers)

    def walk(c):
        if c is None:
            return
        if isinstance(c, dict):
            c = from_dict(c)
        if isinstance(c, Match) and c.field == fname:
            terms.extend(an_terms(c.query, c.analyzer, fname))
        elif isinstance(c, (MatchPhrase, MatchPhrasePrefix)) and c.field == fname:
            phrase(c.query, c.analyzer, isinstance(c, MatchPhrasePrefix))
        elif isinstance(c, Term) and c.field == fname:
            terms.append(str(c.value))
        elif isinstance(c, Terms) and c.field == fname:
            terms.extend(str(v) for v in c.values if not isinstance(c.values, DataFrame))
        elif isinstance(c, Wildcard) and c.field == fname:
            pats.append(str(c.value))
        elif isinstance(c, MultiMatch):
            names = [f for f, _ in parse_fields(c.fields)]
            if fname in names:
                seq = an_terms(c.query, c.analyzer, fname)
                if c.type in ("phrase", "phrase_prefix"):
                    phrase(c.query, c.analyzer, c.type == "phrase_prefix")
                elif c.type == "bool_prefix":
                    pats.extend(t + "*" for t in seq)
                else:
                    terms.extend(seq)
        elif isinstance(c, Bool):
            for x in _flat(c.must) + _flat(c.should) + _flat(c.filter):
                walk(x)
        elif isinstance(c, Nested):
            walk(c.query)
        elif isinstance(c, FunctionScore):
            walk(c.query)

    walk(clause)
    return list(dict.fromkeys(terms)), list(dict.fromkeys(pats)), list(dict.fromkeys(phrases))
