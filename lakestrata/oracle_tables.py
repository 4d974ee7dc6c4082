"""DuckDB twins of the source, catalog, schema and sink entries."""

from __future__ import annotations

from .oracle import SQL as TABLES_SQL
from .oracle import BUCKET, CATEGORY_METRICS, FUNNEL, _with
from .oracle_more import DEFECTIVE, FIRST, LATEST_ODS, MESSAGE_REASONS, VALID
from .oracle_more import SQL as MORE_SQL
from .schemas import TABLES

CHECKED = f"checked AS (SELECT *, {MESSAGE_REASONS} AS reasons FROM ({DEFECTIVE}))"

CLOSED = "(SELECT max(ts_ltz) - INTERVAL 3 SECOND FROM src)"

# Declared types next to whether the loads leave any value in the column.
_ALWAYS_NULL: set = set()
_SCHEMA_ROWS = ", ".join(
    f"('{t}', {i}, '{f.name}', '{f.dataType.simpleString()}', {str((t, f.name) not in _ALWAYS_NULL).lower()})"
    for t, s in sorted(TABLES.items()) for i, f in enumerate(s.fields))

SQL: dict[str, str] = {
    "click_csv_scan": _with("msg") + """SELECT coalesce(user_id, '') AS user_id, coalesce(item_id, '') AS item_id,
 coalesce(category_id, '') AS category_id, coalesce(behavior, '') AS behavior, CAST(ts AS VARCHAR) AS ts
FROM msg WHERE ts % 7 NOT IN (0, 1)""",
    "catalog_roundtrip": TABLES_SQL["orientation_daily"],
    "insert_by_name": TABLES_SQL["build_year_segment_daily"],
    "daily_to_catalog": TABLES_SQL["top_attention_houses"],
    "table_schemas": f"""SELECT * FROM (VALUES {_SCHEMA_ROWS})
 AS v(table_name, position, column_name, type, filled)""",
    "append_by_dt": MORE_SQL["stream_click_ods"],
    "stream_restart": MORE_SQL["stream_click_dwd"],
    "stream_compact_stream": MORE_SQL["stream_click_ods"],
    "upsert_null_partition": _with("listing", extra="""l AS (SELECT * REPLACE (CASE WHEN house_id LIKE '%-2' THEN NULL ELSE city END AS city)
 FROM listing)""") + """SELECT house_id, trace_id, city FROM (SELECT *, row_number() OVER (
 PARTITION BY house_id, city ORDER BY event_time DESC, trace_id DESC) AS rn FROM l) WHERE rn = 1""",
    "compact_string_partition": _with("click") + """SELECT event_id,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE '00' || category_id END AS code FROM click""",
    "compact_map_table": TABLES_SQL["community_daily"],
    "stream_listing_ingest": _with("listing", extra=f"{CHECKED},\n{VALID},\n{FIRST}")
    + "SELECT house_id, trace_id FROM first_seen WHERE house_id NOT LIKE '%-2'",
    "stream_listing_rejects": _with("listing", extra=CHECKED)
    + "SELECT house_id, trace_id, reasons FROM checked WHERE reasons != ''",
    "stream_fresh_checkpoint": MORE_SQL["stream_click_ods"],
    "stream_ingest_fresh_checkpoint": _with("listing", extra=f"{CHECKED},\n{VALID}") + """SELECT house_id, trace_id FROM (
 SELECT *, row_number() OVER (PARTITION BY house_id ORDER BY unit_price % 2, event_time, trace_id) AS rn FROM valid)
 WHERE rn = 1 AND house_id NOT LIKE '%-2'""",
    "stream_clicks_to_catalog": _with("src") + f"""SELECT 'ods_user_behavior' AS table_name, count(*) AS n_rows FROM src
 UNION ALL SELECT 'dwd_user_behavior', count(*) FROM src WHERE behavior IN ('pv', 'buy', 'cart', 'fav')
 UNION ALL SELECT 'dws_category_metrics', count(*) FROM ({CATEGORY_METRICS}) WHERE win_end <= {CLOSED}
 UNION ALL SELECT 'dws_behavior_funnel', count(*) FROM ({FUNNEL}) WHERE win_end <= {CLOSED}""",
    # a delivery loses the rows of windows that its predecessors' watermark has closed
    "stream_late_rows": _with("src", extra=f"""parts AS (
 SELECT *, CASE WHEN ts % 10 = 0 THEN 2 WHEN ts < (SELECT avg(ts) FROM src) THEN 0 ELSE 1 END AS part FROM src),
marks AS (SELECT p, max(ts_ltz) - INTERVAL 3 SECOND AS mark FROM parts, (SELECT unnest([1, 2]) AS p) WHERE part < p GROUP BY p),
kept AS (SELECT parts.* FROM parts LEFT JOIN marks ON part = p
 WHERE mark IS NULL OR {BUCKET} + INTERVAL 10 MINUTE > mark)""")
    + f"SELECT * FROM ({CATEGORY_METRICS.replace('FROM src', 'FROM kept')}) WHERE win_end <= {CLOSED}",
    "compact_incremental": MORE_SQL["stream_click_ods"],
    "upsert_fold": LATEST_ODS,
    "source_view": _with("msg") + "SELECT behavior, count(*) AS n, max(ts) AS last_ts FROM msg GROUP BY behavior",
    "load_stamp": _with("listing") + "SELECT house_id, trace_id, true AS stamped FROM listing",
    "written_codec": _with("src") + "SELECT DISTINCT CAST(CAST(ts_ltz AS DATE) AS VARCHAR) AS dt, 'zstd' AS codec FROM src",
    "topic_order": _with("msg") + """SELECT user_id, count(*) AS n, CAST(1 AS BIGINT) AS partitions, CAST(0 AS BIGINT) AS out_of_order
 FROM msg GROUP BY user_id""",
}
