"""Search as one lazy DataFrame plan.

    index.df --filter(matched)--> withColumn(_score) --[keyset filter]-->
    orderBy(keys).offset(from).limit(size) --> project _source --> highlight

Catalyst turns ``orderBy + offset + limit`` into ``TakeOrderedAndProject``:
each task keeps its own top (from + size) rows and only those cross the
single small exchange, so a page never shuffles the index.  Highlighting is
projected after the limit and therefore runs on page rows only.
"""

from __future__ import annotations

import fnmatch
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.highlight import Highlight, highlight_column
from ..functions.scoring import round_score
from ..sources.index import Index
from .clauses import Clause, Context, compile_clause, highlight_terms, prepare

DEFAULT_SIZE = 10


# ---------------------------------------------------------------------------
# sort keys
# ---------------------------------------------------------------------------


@dataclass
class SortKey:
    field: str
    order: str = "desc"

    def __post_init__(self):
        o = self.order.lower()
        if o not in ("asc", "desc"):
            raise ValueError(f"sort order must be asc or desc, not {self.order}")
        self.order = o


def parse_sort(sort) -> list[SortKey]:
    """``'f'`` / ``('f','asc')`` / ``{'f': 'asc'}`` / ``{'f': {'order': 'asc'}}`` / SortKey,
    alone or in a list.  Default order is desc for every key."""
    if sort is None:
        return []
    if isinstance(sort, (str, SortKey, dict)) or (isinstance(sort, tuple) and len(sort) == 2
                                                   and isinstance(sort[1], str)
                                                   and sort[1].lower() in ("asc", "desc")):
        sort = [sort]
    out: list[SortKey] = []
    for s in sort:
        if isinstance(s, SortKey):
            out.append(s)
        elif isinstance(s, str):
            out.append(SortKey(s))
        elif isinstance(s, tuple):
            out.append(SortKey(s[0], s[1] if len(s) > 1 and s[1] else "desc"))
        elif isinstance(s, dict):
            for k, v in s.items():
                order = v.get("order", "desc") if isinstance(v, dict) else (v or "desc")
                out.append(SortKey(k, order))
        else:
            raise TypeError(f"bad sort entry {s!r}")
    return out


def _sort_key(index: Index, df: DataFrame, key: str) -> tuple[Column, T.DataType]:
    """A field as sorts see it: keyword sub-fields (``title.exact``) by their field, ``null_value`` in place of null."""
    if key.startswith("_"):
        return F.col(key), df.schema[key].dataType
    rf = index.field(key)
    if rf.is_array:
        raise ValueError(f"cannot sort by {key}: it holds several values")
    return rf.predicate_value, rf.data_type


def sort_value_json(col: Column, dt: T.DataType) -> Column:
    """One sort value as JSON text, exact; dates as epoch milliseconds with up to three decimals (microseconds)."""
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(dt, T.TimestampType):
            v = F.unix_micros(col)
        else:  # NTZ values hold UTC wall time
            v = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), col).cast("timestamp"))
        millis = (v.cast("decimal(20,0)") / F.lit(1000).cast("decimal(4,0)")).cast("decimal(23,3)").cast("string")
        return F.coalesce(F.regexp_replace(millis, r"\.000$", ""), F.lit("null"))
    if isinstance(dt, T.DateType):
        return F.coalesce(F.unix_millis(col.cast("timestamp")).cast("string"), F.lit("null"))
    return F.regexp_extract(F.to_json(F.array(col)), r"^\[(.*)\]$", 1)


def _cursor_literal(value, dt: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(dt)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        ts = F.timestamp_micros(F.lit(int(Decimal(str(value)) * 1000)))
        if isinstance(dt, T.TimestampNTZType):
            return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
        return ts
    if isinstance(dt, T.DateType):
        return F.timestamp_millis(F.lit(int(value))).cast("date")
    # exact numbers come as Decimal; their text converts to any numeric type without loss
    return F.lit(str(value) if isinstance(value, Decimal) else value).cast(dt)


def keyset_after(keys: list[tuple[Column, str, Column]]) -> Column:
    """Rows strictly after the cursor in the sort order, nulls last both ways.

    after = OR_i ( k1 <=> v1 AND ... AND k(i-1) <=> v(i-1) AND next_i )
    next_i = false if vi is null, else coalesce(ki IS NULL OR ki < vi, false) for
    desc (ki > vi for asc)."""
    ors = []
    for i, (col, order, val) in enumerate(keys):
        prefix = [keys[j][0].eqNullSafe(keys[j][2]) for j in range(i)]
        cmp = col < val if order == "desc" else col > val
        nxt = F.when(val.isNull(), F.lit(False)).otherwise(F.coalesce(col.isNull() | cmp, F.lit(False)))
        term = nxt
        for p in reversed(prefix):
            term = p & term
        ors.append(term)
    out = ors[0]
    for o in ors[1:]:
        out = out | o
    return out


def decode_cursor(cursor: str | None) -> list | None:
    """A cursor string (JSON array of sort values); falsy gives no cursor."""
    if not cursor:
        return None
    try:
        values = json.loads(cursor, parse_float=Decimal)
    except (TypeError, ValueError) as exc:
        raise ValueError(f"Invalid cursor format: {cursor}") from exc
    if not isinstance(values, list):
        raise ValueError(f"Invalid cursor format: {cursor}")
    return values


# ---------------------------------------------------------------------------
# projection
# ---------------------------------------------------------------------------


def _hits(path: str, patterns: list[str]) -> bool:
    """Whether a pattern names the path or a level above it."""
    parts = path.split(".")
    return any(fnmatch.fnmatchcase(".".join(parts[:n]), p) for p in patterns for n in range(1, len(parts) + 1))


def _pruned(col: Column, dt: T.DataType, path: str, includes: list[str] | None, excludes: list[str]) -> Column | None:
    """The value with the wanted sub-fields only, in structs and lists as they were; None if none is wanted."""
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        if _pruned(F.lit(None), dt.elementType, path, includes, excludes) is None:
            return None
        return F.transform(col, lambda x: _pruned(x, dt.elementType, path, includes, excludes))
    if isinstance(dt, T.StructType):
        parts = [(f.name, _pruned(col.getField(f.name), f.dataType, f"{path}.{f.name}", includes, excludes)) for f in dt.fields]
        kept = [v.alias(n) for n, v in parts if v is not None]
        return F.when(col.isNotNull(), F.struct(*kept)) if kept else None
    wanted = (includes is None or _hits(path, includes)) and not _hits(path, excludes)
    return col if wanted else None


def source_columns(index: Index, source) -> list[Column]:
    cols = index.source_columns
    if source is False or isinstance(source, dict) and source.get("enabled") is False:
        return []
    if source is True or source is None:
        return [F.col(f"`{c}`") for c in cols]
    if isinstance(source, dict):
        includes, excludes = source.get("includes") or None, list(source.get("excludes") or [])
    else:
        includes, excludes = list(source), []
        # in the order asked for
        tops = [[c for c in cols if fnmatch.fnmatchcase(c, n.split(".")[0])] for n in includes]
        unknown = [n for n, t in zip(includes, tops) if not t and not set(n) & set("*?")]
        if unknown:
            raise ValueError(f"unknown source field {unknown[0]}")
        cols = list(dict.fromkeys(c for t in tops for c in t))
    plain = not any("." in p for p in [*(includes or []), *excludes])
    out = []
    for c in cols:
        if plain:                              # whole columns, so that nothing is taken apart
            v = F.col(f"`{c}`") if (includes is None or _hits(c, includes)) and not _hits(c, excludes) else None
        else:
            v = _pruned(F.col(f"`{c}`"), index.df.schema[c].dataType, c, includes, excludes)
        if v is not None:
            out.append(v.alias(c))
    return out


# ---------------------------------------------------------------------------
# result
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Page:
    """A page that was run: its rows, the number of all matches, and the cursor of the next page."""

    rows: list
    total: int
    cursor: str | None

    @property
    def is_empty(self) -> bool:
        return not self.rows


class SearchResult:
    """Lazy search result.  ``hits`` is the page; ``matches`` every matching
    row (with ``_score``), from which ``total`` is counted.  ``page()`` gives
    rows, total and cursor from one run."""

    def __init__(self, matches: DataFrame, paged: Callable[[DataFrame], DataFrame]):
        self.matches = matches
        self._paged = paged
        self.hits = paged(matches)

    def page(self) -> Page:
        """Run the search once: matches are counted on their way into the page."""
        seen = Observation(f"matches-{uuid.uuid4().hex}")
        rows = self._paged(self.matches.observe(seen, F.count(F.lit(1)).alias("total"))).collect()
        return Page(rows, seen.get["total"], rows[-1]["_sort"] if rows else None)

    @property
    def total(self) -> int:
        return self.matches.count()

    def total_frame(self) -> DataFrame:
        return self.matches.agg(F.count(F.lit(1)).alias("total"))

    @property
    def is_empty(self) -> bool:
        return self.hits.isEmpty()

    @property
    def cursor(self) -> str | None:
        """Sort values of the last hit of the page (only that row reaches the driver)."""
        rows = self.hits.select("_sort").tail(1)
        return rows[0]["_sort"] if rows else None

    def rows(self) -> list:
        return self.hits.collect()


def _highlight_map(index: Index, query, hl: Highlight) -> Column | None:
    entries = []
    for hf in hl.fields:
        q = hf.highlight_query or hl.highlight_query or query
        names = [hf.name] + [m for m in hf.matched_fields if m != hf.name]
        terms, pats, phrases = [], [], []
        for n in names:
            t, p, ph = highlight_terms(q, n, index)
            terms += t
            pats += p
            phrases += ph
        terms, pats = list(dict.fromkeys(terms)), list(dict.fromkeys(pats))
        base = index.field(hf.name).value if "." not in hf.name or hf.name.split(".")[0] in index.df.columns \
            else F.col(hf.name)
        entries += [F.lit(hf.name), highlight_column(base, terms, pats, hf, hl, list(dict.fromkeys(phrases)))]
    if not entries:
        return None
    return F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())


def search(index: Index, query: Clause | dict | None = None, *, sort=None, size: int = DEFAULT_SIZE,
           from_: int = 0, search_after: list | None = None, cursor: str | None = None,
           source: Any = True, highlight: Highlight | None = None, track_scores: bool = False,
           min_score: float | None = None) -> SearchResult:
    """Run a search request against ``index``; see the module docstring for the plan."""
    index = prepare(index, query)
    ctx = Context(index)
    comp = compile_clause(query, ctx)
    keys = parse_sort(sort)
    if not keys:
        keys = [SortKey("_score", "desc")]
    by_score = any(k.field == "_score" for k in keys) or track_scores or min_score is not None
    df = index.df.filter(comp.matched)
    score = round_score(comp.score) if by_score else F.lit(None).cast("double")
    scored = df.withColumn("_score", score)
    if min_score is not None:
        scored = scored.filter(F.col("_score") >= F.lit(float(min_score)))
    if not any(k.field == "_id" for k in keys):
        keys = keys + [SortKey("_id", "asc")]
    sorts = [(*_sort_key(index, scored, k.field), k.order) for k in keys]
    key_cols = [(c, o, dt) for c, dt, o in sorts]
    sort_json = F.concat(F.lit("["), F.concat_ws(",", *[sort_value_json(c, dt) for c, _, dt in key_cols]), F.lit("]"))
    values = search_after if search_after is not None else decode_cursor(cursor)
    if values:
        if len(values) > len(key_cols):
            raise ValueError(f"{len(values)} cursor values for {len(key_cols)} sort keys")
        if len(values) < len(key_cols):
            # a cursor may omit the implicit _id tie-break: pad with nothing after it
            values = list(values) + [None] * (len(key_cols) - len(values))
    order = [c.asc_nulls_last() if o == "asc" else c.desc_nulls_last() for c, o, _ in key_cols]
    cols = [F.col("_index"), F.col("_id"), F.col("_score")] + source_columns(index, source) + [F.col("_sort")]
    if highlight is not None:
        hmap = _highlight_map(index, query, highlight)
        if hmap is not None:
            cols.append(hmap.alias("_highlight"))

    def paged(page: DataFrame) -> DataFrame:
        if values:
            page = page.filter(keyset_after([(c, o, _cursor_literal(v, dt)) for (c, o, dt), v in zip(key_cols, values)]))
        page = page.withColumn("_sort", sort_json).orderBy(*order)
        if from_:
            page = page.offset(int(from_))
        return page.limit(int(size)).select(*cols)

    return SearchResult(scored, paged)


def matching(index: Index, query: Clause | dict | None = None, with_score: bool = True) -> DataFrame:
    """Every matching row with ``_score`` (no sort, no page)."""
    cols = index.df.columns
    index = prepare(index, query)
    comp = compile_clause(query, Context(index))
    df = index.df.filter(comp.matched)
    if with_score:
        df = df.withColumn("_score", round_score(comp.score))
    return df.select(*[F.col(f"`{c}`") for c in cols], *(["_score"] if with_score else []))


def count(index: Index, query: Clause | dict | None = None) -> int:
    """Number of matching documents; paging and sort do not apply."""
    return count_frame(index, query).first()["count"]


def count_frame(index: Index, query: Clause | dict | None = None) -> DataFrame:
    index = prepare(index, query)
    comp = compile_clause(query, Context(index))
    return index.df.filter(comp.matched).agg(F.count(F.lit(1)).alias("count"))


def get_by_ids(index: Index, ids: DataFrame, id_col: str = "_id") -> DataFrame:
    """Fetch documents by id; ids without a document give a row of nulls
    (``found`` false).  A semi join keeps the documents asked for before the
    left join from the id table; Spark broadcasts the ids where their size allows."""
    want = ids.select(F.col(id_col).cast("string").alias("_id"))
    docs = (index.df.join(want.distinct(), "_id", "left_semi")
            .select("_id", *[F.col(f"`{c}`") for c in index.source_columns]))
    return (want.join(docs.withColumn("found", F.lit(True)), "_id", "left")
            .withColumn("found", F.coalesce(F.col("found"), F.lit(False))))
