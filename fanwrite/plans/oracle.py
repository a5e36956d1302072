"""DuckDB SQL equal to each registered query, over the raw parquet views.

``b`` maps an ``events`` row to its event fields the same way
:func:`fanwrite.sources.tables.table_fields` does; the other CTE pieces spell
out the row key, routing, blob text and JSON payload of the Spark side.
"""

from __future__ import annotations

BASE = """b AS (
  SELECT event_id, ts, user_id,
         CAST(event_id AS VARCHAR) AS id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS dt,
         CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END AS rv39,
         event_type AS evt,
         CAST(user_id AS VARCHAR) AS sun,
         CAST(value AS VARCHAR) AS sev,
         props AS msg,
         'US' AS obscountry
  FROM events)"""

ROW_KEY = r"regexp_replace(md5(id), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5')"
TABLE = "coalesce('events-' || rv39, 'unrouted')"
FIELDS = "id, dt, rv39, evt, sun, sev, msg"
ENRICHED = FIELDS + ", obscountry"
BLOB = (
    "'{' || concat_ws(', ', 'dt=' || dt, 'evt=' || evt, 'id=' || id, 'msg=' || msg, "
    "'obscountry=' || obscountry, 'rv39=' || rv39, 'sev=' || sev, 'sun=' || sun) || '}'"
)
RAW_BLOB = (
    "'{' || concat_ws(', ', 'dt=' || dt, 'evt=' || evt, 'id=' || id, 'msg=' || msg, "
    "'rv39=' || rv39, 'sev=' || sev, 'sun=' || sun) || '}'"
)
JSON = (
    """'{"id":"' || id || '","dt":"' || dt || '",' || coalesce('"rv39":"' || rv39 || '",', '') || """
    """'"evt":"' || evt || '","sun":"' || sun || '","sev":"' || sev || '","msg":"' || replace(msg, '"', '\\"') || '"}'"""
)


def _with(body: str, extra: str = "") -> str:
    return f"WITH {BASE}{extra}\n{body}"


def _fields(key: str, cols: str, source: str = "b") -> str:
    return _with(f"SELECT {key}, qualifier, value FROM (SELECT {key}, {cols} FROM {source}) UNPIVOT (value FOR qualifier IN ({cols}))")


def _wide(table: str) -> str:
    return _with(
        f"SELECT table_name, row_key, 'evt' AS family, qualifier, value FROM "
        f"(SELECT {table} AS table_name, {ROW_KEY} AS row_key, {ENRICHED} FROM b) "
        f"UNPIVOT (value FOR qualifier IN ({ENRICHED}))"
    )


def _blob(table: str) -> str:
    return _with(f"SELECT {table} AS table_name, {ROW_KEY} AS row_key, 'evt' AS family, 'data' AS qualifier, {BLOB} AS value FROM b")


DECODED = _with("SELECT id AS msg_key, id, dt, rv39, evt, sun, sev, msg FROM b")

LATEST_BY_USER = _with(
    f"SELECT doc_id, qualifier, value FROM (SELECT sun AS doc_id, {ENRICHED} FROM l) UNPIVOT (value FOR qualifier IN ({ENRICHED}))",
    extra=",\nl AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)",
)

CSV_LINE = "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in FIELDS.split(", ")) + ")"
MANY = ", ".join(f"'v{i}' AS c{i:02d}" for i in range(19))
MANY_FIELDS = FIELDS + ", " + ", ".join(f"c{i:02d}" for i in range(19))
LONG = "event_id % 5 = 0"
UNKEYED = "event_id % 4 = 0"
BOTH_BLOB = (
    "'{' || concat_ws(', ', 'dt=' || dt, 'evt=' || evt, 'id=' || CASE WHEN event_id % 4 <> 0 THEN id END, 'msg=' || msg, "
    "'obscountry=' || obscountry, 'rv39=' || rv39, 'sev=' || sev, 'sun=' || sun) || '}'"
)
BOTH_SINKS = _with(
    f"SELECT 'cell' AS kind, {TABLE} AS name, {BOTH_BLOB} AS content FROM b\n"
    f"UNION ALL SELECT 'document', id, {BOTH_BLOB} FROM b WHERE NOT {UNKEYED}\n"
    f"UNION ALL SELECT 'no_doc_id', id, '' FROM b WHERE {UNKEYED}"
)

ORACLE_SQL: dict[str, str] = {
    "enrich_many": _with(
        f"SELECT event_id, qualifier, value FROM (SELECT event_id, {MANY_FIELDS} FROM m) UNPIVOT (value FOR qualifier IN ({MANY_FIELDS}))",
        extra=f",\nm AS (SELECT * REPLACE ('fixed' AS sev), {MANY} FROM b)",
    ),
    "enrich_hook": _with(
        f"SELECT event_id, qualifier, value FROM (SELECT event_id, {FIELDS}, region FROM h) UNPIVOT (value FOR qualifier IN ({FIELDS}, region))",
        extra=",\nh AS (SELECT *, coalesce(upper(rv39), 'NONE') AS region FROM b)",
    ),
    "rejects_by_reason": "SELECT reason, count(*) AS messages FROM (SELECT CASE event_id % 7 WHEN 0 THEN 'decode' WHEN 1 THEN 'null_payload' "
    "WHEN 2 THEN 'duplicate_field' WHEN 3 THEN 'decode' WHEN 4 THEN 'decode' ELSE 'good' END AS reason FROM events) GROUP BY 1",
    "route_by_message_field": "SELECT 'events-' || event_type AS table_name, count(*) AS events FROM events GROUP BY 1",
    "csv_rejects": _with(f"SELECT 'csv_long_row' AS reason, {CSV_LINE} || ',EXTRA' AS line FROM b WHERE {LONG}"),
    "index_upsert_batches": LATEST_BY_USER,
    "bulk_rejects": _with(
        f"SELECT 'cell' AS kind, {BLOB} AS content FROM b WHERE NOT {LONG}\n"
        f"UNION ALL SELECT 'reject', {CSV_LINE} || ',EXTRA' FROM b WHERE {LONG}"
    ),
    "fanout_both_sinks": BOTH_SINKS,
    "fanout_both_sinks_parallel": BOTH_SINKS,
    "stream_table_only": _blob(TABLE),
    "events_to_map": _fields("event_id", FIELDS),
    "enrich_constant": _fields("event_id", ENRICHED),
    "restamp_event_time": "SELECT event_id, strftime(ts - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS dt FROM events",
    "drop_empty_fields": _fields("event_id", FIELDS),
    "row_key": _with(f"SELECT event_id, {ROW_KEY} AS row_key FROM b"),
    "wide_cells": _wide(TABLE),
    "blob_cells": _blob(TABLE),
    "tenant_list": _with("SELECT DISTINCT rv39 AS tenant FROM b WHERE rv39 IS NOT NULL"),
    "tenant_filter": _with(f"SELECT event_id, {ROW_KEY} AS row_key, rv39 AS tenant FROM b WHERE rv39 = 'purchase'"),
    "route_counts": _with(f"SELECT {TABLE} AS table_name, count(*) AS events FROM b GROUP BY 1"),
    "decode_events": DECODED,
    "encode_events": _with(f"SELECT event_id, CAST(strlen({JSON}) AS BIGINT) AS payload_bytes, msg FROM b"),
    "rejects": _with(f"SELECT id AS msg_key, 'decode' AS reason, {RAW_BLOB} AS payload FROM b WHERE evt = 'error'"),
    "csv_events": _with(
        f"SELECT event_key, qualifier, value FROM (SELECT id AS event_key, {FIELDS} FROM b) UNPIVOT (value FOR qualifier IN ({FIELDS}))"
    ),
    "sink_single_table": _blob("'events'"),
    "sink_tenant_tables": _wide(TABLE),
    "index_upsert_latest": LATEST_BY_USER,
    "bulk_load_cells": _wide("'events'"),
    "stream_ingest": DECODED,
    "stream_resume": _blob(TABLE),
    "stream_fanout": _wide(TABLE),
    "stream_fanout_parallel": LATEST_BY_USER,
    "batch_stats": _with(
        f"SELECT 'table' AS sink, {TABLE} AS table_name, count(*) AS row_count FROM b WHERE evt <> 'error' GROUP BY 2\n"
        "UNION ALL SELECT 'index' AS sink, 'index' AS table_name, count(*) AS row_count FROM b WHERE evt <> 'error'\n"
        "UNION ALL SELECT 'rejects' AS sink, 'decode' AS table_name, count(*) AS row_count FROM b WHERE evt = 'error'"
    ),
}
