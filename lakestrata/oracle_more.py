"""DuckDB twins of the data-quality, sink and streaming registry entries."""

from __future__ import annotations

from .oracle import (CATEGORY_METRICS, FUNNEL, HAS_ROOM, _ods_select, _r, _stats, _with)

DEFECTIVE = """SELECT trace_id, house_id, city, district, event_time, unit_price, area_sqm,
 CASE WHEN house_id LIKE '%-5' AND unit_price % 5 = 0 THEN NULL ELSE source END AS source,
 CASE WHEN house_id LIKE '%-4' AND unit_price % 4 = 0 THEN 'n/a' ELSE CAST(room_num AS VARCHAR) END AS room_num,
 CASE WHEN house_id LIKE '%-6' AND unit_price % 3 = 0 THEN NULL ELSE community END AS community,
 CASE WHEN house_id LIKE '%-7' AND unit_price % 2 = 0 THEN ' ' ELSE house_url END AS house_url,
 CASE WHEN house_id LIKE '%-1' AND unit_price % 7 = 0 THEN NULL ELSE total_price END AS total_price
FROM listing"""


def _missing(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'missing:{c}' END"


def _not_numeric(c: str) -> str:
    return f"CASE WHEN TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) IS NULL THEN 'not_numeric:{c}' END"


def _not_integer(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS BIGINT) IS NULL THEN 'not_integer:{c}' END"


RULES = ([_missing(c) for c in ("source", "house_id", "house_url", "city", "district", "community")]
         + [_not_numeric(c) for c in ("total_price", "unit_price", "area_sqm")])
# messages are typed, so a count that is no number arrives as NULL there
MESSAGE_REASONS = "concat_ws('|', " + ", ".join(RULES) + ")"
REASONS = "concat_ws('|', " + ", ".join([*RULES, _not_integer("room_num")]) + ")"

CHECKED = f"checked AS (SELECT *, {REASONS} AS reasons FROM ({DEFECTIVE}))"
VALID = "valid AS (SELECT * FROM checked WHERE reasons = '')"
FIRST = """first_seen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY house_id
 ORDER BY event_time, trace_id) AS rn FROM valid) WHERE rn = 1)"""

LATEST_ORDER = "event_time DESC, trace_id DESC, total_price DESC, area_sqm DESC"
LATEST_ODS = _with("listing", extra=f"""latest AS (SELECT * FROM (SELECT *, row_number() OVER (
 PARTITION BY house_id, city ORDER BY {LATEST_ORDER}) AS rn FROM listing)
 WHERE rn = 1)""") + _ods_select().replace("FROM listing", "FROM latest")


def _closed(metric_sql: str) -> str:
    """Windows the watermark (max event time - 3 s) has closed."""
    return _with("src") + f"""SELECT * FROM ({metric_sql})
WHERE win_end <= (SELECT max(ts_ltz) - INTERVAL 3 SECOND FROM src)"""


CORRECTED = "AND attention_count > 0 AND ds >= '20240104'"
HOUSE_TYPE = f"""SELECT ds, room_num, hall_num, bathroom_num, {_stats()} FROM dwd WHERE {HAS_ROOM} {{}}
GROUP BY ds, room_num, hall_num, bathroom_num"""

SQL: dict[str, str] = {
    "validate_valid": _with("listing", extra=CHECKED) + f"""SELECT trace_id, house_id, city,
 community, house_url, {_r('total_price', 'total_price')} FROM checked WHERE reasons = ''""",

    "validate_rejected": _with("listing", extra=CHECKED) + """SELECT trace_id, house_id, reasons
FROM checked WHERE reasons != ''""",

    "dedupe_first_seen": _with("listing", extra=f"{CHECKED},\n{VALID},\n{FIRST}")
    + "SELECT house_id, trace_id, event_time FROM first_seen",

    "skip_delivered": _with("listing", extra=f"{CHECKED},\n{VALID},\n{FIRST}")
    + """SELECT f.house_id, f.trace_id FROM first_seen f
WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE l.house_id LIKE '%-1' AND l.house_id = f.house_id)""",

    "upsert_latest_per_key": LATEST_ODS,

    "sink_dynamic_overwrite": _with("dwd", extra=(
        f"a AS ({HOUSE_TYPE.format('')}),\n"
        f"b AS ({HOUSE_TYPE.format(CORRECTED)})"))
    + "SELECT * FROM a WHERE ds NOT IN (SELECT ds FROM b) UNION ALL SELECT * FROM b",

    "compact_roundtrip": _with("src") + """SELECT user_id, item_id, category_id, behavior, ts,
 event_time, ts_ltz, CAST(ts_ltz AS DATE) AS dt FROM src""",

    "stream_click_ods": _with("src") + """SELECT user_id, item_id, category_id, behavior, ts,
 event_time, ts_ltz, CAST(ts_ltz AS DATE) AS dt FROM src""",
    "stream_click_dwd": _with("src") + """SELECT user_id, item_id, category_id, behavior, ts, ts_ltz,
 CAST(ts_ltz AS DATE) AS dt FROM src
WHERE behavior IS NOT NULL AND behavior IN ('pv', 'buy', 'cart', 'fav')""",
    "stream_category_metrics": _closed(CATEGORY_METRICS),
    "stream_behavior_funnel": _closed(FUNNEL),
    "stream_dedupe_first": _with("listing") + """SELECT house_id, trace_id, event_time FROM (SELECT *, row_number() OVER (
 PARTITION BY house_id ORDER BY event_time, trace_id) AS rn FROM listing) WHERE rn = 1""",
    "stream_upsert_latest": LATEST_ODS,
}
