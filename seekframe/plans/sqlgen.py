"""Helpers that write the DuckDB oracle SQL of the registered queries.

They spell out the same arithmetic as :mod:`seekframe.functions.scoring`
in the same order, with every literal cast to DOUBLE (a bare ``0.5`` is a
DECIMAL in DuckDB and would change the results).
"""

from __future__ import annotations

from ..functions.analysis import STANDARD_TOKEN
from ..functions.scoring import B, K1


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + str(s).replace("'", "''") + "'"


def tok(expr: str) -> str:
    """Standard analyser: lower-case, runs of letters/digits/marks/underscore."""
    return f"regexp_extract_all(lower({expr}), {q(STANDARD_TOKEN)})"


def tf(tokens: str, term: str) -> str:
    return f"CAST(len(list_filter({tokens}, lambda x: x = {q(term)})) AS BIGINT)"


def idf(n: str, df: str) -> str:
    return (f"ln({dbl(1.0)} + (CAST({n} AS DOUBLE) - CAST({df} AS DOUBLE) + {dbl(0.5)}) "
            f"/ (CAST({df} AS DOUBLE) + {dbl(0.5)}))")


def tf_norm(tf_expr: str, dl: str, avgdl: str) -> str:
    t = f"CAST({tf_expr} AS DOUBLE)"
    norm = f"({dbl(K1)} * ({dbl(1.0 - B)} + {dbl(B)} * CAST({dl} AS DOUBLE) / {avgdl}))"
    return f"({t} * {dbl(K1 + 1.0)} / ({t} + {norm}))"


def bm25(tf_expr: str, dl: str, n: str, df: str, avgdl: str) -> str:
    return (f"(CASE WHEN {tf_expr} > 0 THEN {idf(n, df)} * {tf_norm(tf_expr, dl, avgdl)} "
            f"ELSE {dbl(0.0)} END)")


def total(parts: list[str]) -> str:
    if not parts:
        return dbl(0.0)
    out = parts[0]
    for p in parts[1:]:
        out = f"({out} + {p})"
    return out


def stats_cte(name: str, source: str, tokens: str, terms: list[str], prefix: str = "") -> str:
    """One-row statistics: n, sum of lengths, df per term (``{prefix}df{i}``)."""
    dfs = ", ".join(f"count(*) FILTER (WHERE list_contains({tokens}, {q(t)})) AS {prefix}df{i}"
                    for i, t in enumerate(terms))
    extra = f", {dfs}" if dfs else ""
    return (f"{name} AS (SELECT count(*) FILTER (WHERE {tokens} IS NOT NULL) AS {prefix}n, "
            f"CAST(sum(len({tokens})) AS DOUBLE) AS {prefix}sdl{extra} FROM {source})")


def match_score(tokens: str, terms: list[str], prefix: str = "", boost: float = 1.0) -> str:
    """BM25 sum over ``terms`` (stats columns from :func:`stats_cte`), times boost."""
    avg = f"({prefix}sdl / CAST({prefix}n AS DOUBLE))"
    parts = [bm25(tf(tokens, t), f"len({tokens})", f"{prefix}n", f"{prefix}df{i}", avg)
             for i, t in enumerate(terms)]
    return f"({total(parts)} * {dbl(boost)})"


def any_term(tokens: str, terms: list[str]) -> str:
    return f"list_has_any({tokens}, [{', '.join(q(t) for t in terms)}])"


def all_terms(tokens: str, terms: list[str]) -> str:
    return "(" + " AND ".join(f"list_contains({tokens}, {q(t)})" for t in terms) + ")"


def scored(expr: str, matched: str) -> str:
    return f"(CASE WHEN {matched} THEN {expr} ELSE {dbl(0.0)} END)"


def padded(tokens: str) -> str:
    return f"(' ' || array_to_string({tokens}, '  ') || ' ')"
