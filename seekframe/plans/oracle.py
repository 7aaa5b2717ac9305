"""DuckDB SQL oracles of the registered queries (same keys, same columns)."""

from __future__ import annotations

from .sqlgen import all_terms, any_term, dbl, match_score, q, stats_cte, tok

SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    SQL[name] = text.strip()


def docs_cte(extra: str = "") -> str:
    return f"d AS (SELECT *, {tok('text')} AS tok{extra} FROM documents)"


FLAG_TERMS = ["ering", "retion"]

sql("flagship_search", f"""
WITH {docs_cte()},
{stats_cte('st', 'd', 'tok', FLAG_TERMS)}
SELECT 'documents' AS _index, CAST(doc_id AS VARCHAR) AS _id,
       round({match_score('tok', FLAG_TERMS)}, 6) AS _score, doc_id, lang, n_chars
FROM d, st
WHERE {any_term('tok', FLAG_TERMS)} AND lang = 'en'
ORDER BY _score DESC, _id ASC
LIMIT 10
""")


def all_sql() -> dict[str, str]:
    from . import oracle_more, oracle_stored  # noqa: F401

    oracle_stored.stored_sql()
    return dict(SQL)
