"""DuckDB SQL of :mod:`seekframe.plans.catalog_stored`."""

from __future__ import annotations

from .oracle import SQL, sql
from .sqlgen import dbl

_NULL_SCORE = "CAST(NULL AS DOUBLE) AS _score"

sql("cursor_page_ts", f"""
SELECT 'events' AS _index, CAST(event_id AS VARCHAR) AS _id, {_NULL_SCORE}, ts,
       '[' || CASE WHEN epoch_us(ts) % 1000 = 0 THEN CAST(epoch_ms(ts) AS VARCHAR)
         ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) || '.' || lpad(CAST(epoch_us(ts) % 1000 AS VARCHAR), 3, '0') END
         || ',"' || event_id || '"]' AS _sort
FROM events
WHERE ts > TIMESTAMP '2024-01-01 00:00:07.179575' OR (ts = TIMESTAMP '2024-01-01 00:00:07.179575' AND CAST(event_id AS VARCHAR) > '0')
ORDER BY ts, CAST(event_id AS VARCHAR) LIMIT 50""")

sql("search_after_ts", f"""
SELECT 'events' AS _index, CAST(event_id AS VARCHAR) AS _id, {_NULL_SCORE}, ts, event_type FROM events
WHERE ts < TIMESTAMP '2024-01-30 23:57:12.194062'
   OR (ts = TIMESTAMP '2024-01-30 23:57:12.194062' AND event_type > 'view')
   OR (ts = TIMESTAMP '2024-01-30 23:57:12.194062' AND event_type = 'view' AND CAST(event_id AS VARCHAR) > '0')
ORDER BY ts DESC, event_type, CAST(event_id AS VARCHAR) LIMIT 50""")

sql("range_date_offset", f"""
SELECT CAST(event_id AS VARCHAR) AS _id, {dbl(1)} AS _score FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:30:00' AND ts < TIMESTAMP '2024-01-12 03:00:00'""")

sql("sort_subfield", f"""
SELECT 'part' AS _index, CAST(p_partkey AS VARCHAR) AS _id, {_NULL_SCORE}, p_name, p_size FROM part
ORDER BY p_name, p_size DESC, CAST(p_partkey AS VARCHAR) LIMIT 40""")

sql("sort_null_value", f"""
SELECT 'documents' AS _index, CAST(doc_id AS VARCHAR) AS _id, {_NULL_SCORE}, quality, n_chars
FROM documents LEFT JOIN labels USING (doc_id)
ORDER BY coalesce(quality, 1), n_chars DESC, CAST(doc_id AS VARCHAR) LIMIT 120""")

sql("multi_index_custom_analyzer", """
SELECT CASE WHEN p_size < 25 THEN 'small' ELSE 'large' END AS _index, CAST(p_partkey AS VARCHAR) AS _id
FROM part WHERE contains(lower(p_name), 'ri')""")

sql("bulk_update_nested", """
SELECT CAST(event_id AS VARCHAR) AS _id,
       CAST(json_extract_string(props, '$.k') AS INTEGER) + CASE WHEN event_type = 'click' THEN 1000 ELSE 0 END AS k,
       CASE WHEN event_type <> 'view' THEN event_type END AS kind, CASE WHEN event_type = 'view' THEN 'seen' END AS note
FROM events""")

sql("bulk_mixed", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'NEW' WHEN 'P' THEN 'UPD' ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 2 <> 0) AND NOT (o_orderstatus = 'P' AND o_orderkey % 3 = 0)""")

sql("conform_rejects", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'v: not a double' WHEN 'view' THEN 'big: not a integer'
         WHEN 'click' THEN 'obj.a: not an integer; obj: unknown field' ELSE '1.5/7' END AS outcome
FROM events""")

sql("dynamic_object", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type AS more FROM events")


def stored_sql() -> None:
    """The searches over stored tables give what the searches over the documents give."""
    SQL["search_stored"] = SQL["flagship_search"]
    SQL["batch_search_stored"] = SQL["batch_search"]
