"""DuckDB twins of the registered queries (the correctness oracle).

Each SQL runs on DuckDB with the driver tables registered as views.  The
fixture mappings come verbatim from ``lakestrata.fixtures``; outputs are
rendered like ``catalog.render`` (doubles rounded to 6 places, maps as
sorted ``k:v`` strings, arrays ``|``-joined).
"""

from __future__ import annotations

from .fixtures import oracle_views

_V = oracle_views()
FMT = "%Y-%m-%d %H:%M:%S"

# --- shared CTE bodies -------------------------------------------------------

DWD = """
SELECT strftime(to_timestamp(event_time) AT TIME ZONE 'UTC', '%Y%m%d') AS ds, event_time, source,
 batch_id, trace_id, house_id, house_url, title, city,
 CASE WHEN district = 'TODO_MAPPING' THEN NULL ELSE district END AS district, neighborhood,
 community, total_price, unit_price, area_sqm, room_num, hall_num, bathroom_num, orientation,
 floor_level, floor_total,
 CAST(CASE floor_level WHEN '低楼层' THEN 0.25 WHEN '中楼层' THEN 0.5 WHEN '高楼层' THEN 0.75
      ELSE 0.0 END AS DOUBLE) AS floor_ratio,
 decoration, build_year, tags, attention_count, visit_30_days, subway_info,
 regexp_extract(p2_desc, '([一二三四五六]环(?:至[一二三四五六]环)?)', 1) AS ring_road,
 p1_desc, p2_desc
FROM listing WHERE city NOT IN ('AFRICA')
"""

MSG = f"""
SELECT user_id, item_id, category_id, behavior, CAST(floor(epoch(ts_ltz)) AS BIGINT) AS ts,
 strftime(ts_ltz, '{FMT}') AS event_time FROM click
"""

SRC = f"SELECT *, try_strptime(event_time, '{FMT}') AS ts_ltz FROM msg"

CTES = {"listing": _V["listing"], "click": _V["click"], "dim": _V["dim"], "dwd": DWD,
        "msg": MSG, "src": SRC}
DEPS = {"dwd": ["listing"], "msg": ["click"], "src": ["click", "msg"]}


def _with(*names: str, extra: str = "") -> str:
    order: list[str] = []
    for n in names:
        for d in DEPS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    parts = [f"{n} AS ({CTES[n]})" for n in order]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def _r(expr: str, alias: str) -> str:
    """Round like ``catalog.render``: to 9 places, then half-up to 6."""
    return f"CAST(CAST(CAST({expr} AS DECIMAL(38,9)) AS DECIMAL(38,6)) AS DOUBLE) AS {alias}"


def _stats(count_name: str = "house_count") -> str:
    return ", ".join([
        f"COUNT(*) AS {count_name}",
        _r("avg(total_price)", "avg_total_price"),
        _r("quantile_disc(total_price, 0.5)", "median_total_price"),
        _r("avg(unit_price)", "avg_unit_price"),
        "CAST(quantile_disc(unit_price, 0.5) AS DOUBLE) AS median_unit_price",
        _r("avg(area_sqm)", "avg_area_sqm")])


ROOM_TYPE = ("CAST(room_num AS VARCHAR) || '-' || CAST(hall_num AS VARCHAR) || '-' || "
             "CAST(bathroom_num AS VARCHAR)")
HAS_ROOM = "room_num IS NOT NULL AND hall_num IS NOT NULL AND bathroom_num IS NOT NULL"
# --- fixed values: labels and edges of constants.py as SQL --------------------
PRICE_CASE = """CASE WHEN total_price < 100 THEN '0-100万' WHEN total_price < 200 THEN '100-200万'
 WHEN total_price < 300 THEN '200-300万' WHEN total_price < 400 THEN '300-400万'
 WHEN total_price < 500 THEN '400-500万' WHEN total_price < 600 THEN '500-600万'
 WHEN total_price < 700 THEN '600-700万' WHEN total_price < 800 THEN '700-800万'
 WHEN total_price < 900 THEN '800-900万' WHEN total_price < 1000 THEN '900-1000万'
 ELSE '1000万以上' END"""
YEAR_CASE = """CASE WHEN build_year < 1990 THEN '1990前'
 WHEN build_year >= 1990 AND build_year < 2000 THEN '1990-2000'
 WHEN build_year >= 2000 AND build_year < 2010 THEN '2000-2010'
 WHEN build_year >= 2010 THEN '2010后' ELSE '未知' END"""
STEP_CASE = """CASE behavior WHEN 'pv' THEN '1-浏览(PV)' WHEN 'fav' THEN '2-收藏(Fav)'
 WHEN 'cart' THEN '3-加购(Cart)' WHEN 'buy' THEN '4-购买(Buy)' END"""
BUCKET = "time_bucket(INTERVAL 10 MINUTE, ts_ltz)"
COMMUNITY = "city, district, neighborhood, community"


def _pct(n: str, total: str) -> str:
    """ROUND(n*100.0/total, 2) half-up, in exact integer arithmetic."""
    return f"CAST((20000 * {n} + {total}) // (2 * {total}) AS DOUBLE) / 100"


def _ods_select(unit_price: str = "unit_price") -> str:
    return f"""SELECT house_id, source, event_time, version, trace_id, batch_id, house_url, title,
 city, district, neighborhood, community, {_r('total_price', 'total_price')},
 {unit_price} AS unit_price, {_r('area_sqm', 'area_sqm')}, room_num, hall_num, bathroom_num,
 orientation, floor_level, floor_total, decoration, build_year,
 array_to_string(tags, '|') AS tags, attention_count, visit_30_days, subway_info,
 p1_desc AS raw_p1_desc, p2_desc AS raw_p2_desc FROM listing"""


def _map_string(src: str, group: str, key: str, out: str, where: str = "") -> str:
    """Sorted ``k:v`` rendering of a per-group count map."""
    cond = f"WHERE {key} IS NOT NULL" + (f" AND {where}" if where else "")
    return (f"(SELECT {group}, string_agg({key} || ':' || CAST(n AS VARCHAR), ',' ORDER BY {key}) "
            f"AS {out} FROM (SELECT {group}, {key}, COUNT(*) AS n FROM {src} {cond} "
            f"GROUP BY {group}, {key}) GROUP BY {group})")


def _hot_tags(group: str) -> str:
    return f"""(SELECT {group}, string_agg(tag, '|' ORDER BY n DESC, tag DESC) AS hot_tags FROM (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY n DESC, tag DESC) AS rn FROM (
   SELECT {group}, tag, COUNT(*) AS n FROM (SELECT {group}, unnest(tags) AS tag FROM dwd)
   WHERE tag IS NOT NULL AND tag != '' GROUP BY {group}, tag)) WHERE rn <= 5 GROUP BY {group})"""


def _counts(key: str, where: str) -> str:
    """Sorted ``k:v`` text of a group's value counts, '' without any."""
    entries = f"list_sort(map_entries(histogram({key}) FILTER (WHERE {key} IS NOT NULL AND {where})))"
    return f"coalesce(array_to_string([e.key || ':' || CAST(e.value AS VARCHAR) FOR e IN {entries}], ','), '')"


def _community_daily(null_safe: bool) -> str:
    """One grouped pass for numbers and room types; hot tags joined on the key list.  Plain joins never
    match a NULL key, so such groups have no map and no tags unless ``null_safe``."""
    keys = ["city", "district", "neighborhood", "community", "ds"]
    g = ", ".join(keys)
    known = "true" if null_safe else " AND ".join(f"{k} IS NOT NULL" for k in keys)
    numbers = ", ".join(_r(f"{fn}({c})", f"{fn}_{c}") for c, fn in (
        ("total_price", "avg"), ("total_price", "min"), ("total_price", "max"), ("unit_price", "avg"),
        ("area_sqm", "avg"), ("attention_count", "avg"), ("visit_30_days", "avg")))
    return _with("dwd") + f"""SELECT stat.*, CASE WHEN {known} THEN coalesce(hot_tags, '') ELSE '' END AS hot_tags
FROM (SELECT {g}, COUNT(*) AS house_count, {numbers}, {_r('quantile_disc(total_price, 0.5)', 'median_total_price')},
 CAST(quantile_disc(unit_price, 0.5) AS DOUBLE) AS median_unit_price,
 CASE WHEN {known} THEN {_counts(ROOM_TYPE, HAS_ROOM)} ELSE '' END AS room_type_distribution
 FROM dwd GROUP BY {g}) stat
LEFT JOIN (SELECT {", ".join(f"{k} AS t_{k}" for k in keys)}, hot_tags FROM {_hot_tags(g)}) tag
 ON {" AND ".join(f"{k} IS NOT DISTINCT FROM t_{k}" for k in keys)}"""


def _ranked_hot(order: str) -> str:
    ties = ", ".join(f"{c} ASC NULLS FIRST" for c in COMMUNITY.split(", "))
    return (f"CAST(row_number() OVER (PARTITION BY ds ORDER BY {order} DESC, {ties}) AS INTEGER)")


def _windowed(metric_sql: str) -> str:
    return _with("src") + metric_sql


CATEGORY_METRICS = f"""SELECT {BUCKET} AS win_start, {BUCKET} + INTERVAL 10 MINUTE AS win_end,
 category_id,
 CAST(SUM(CASE WHEN behavior = 'pv' THEN 1 ELSE 0 END) AS BIGINT) AS pv_cnt,
 CAST(SUM(CASE WHEN behavior = 'cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_cnt,
 CAST(SUM(CASE WHEN behavior = 'fav' THEN 1 ELSE 0 END) AS BIGINT) AS fav_cnt,
 CAST(SUM(CASE WHEN behavior = 'buy' THEN 1 ELSE 0 END) AS BIGINT) AS buy_cnt
FROM src WHERE behavior IS NOT NULL GROUP BY 1, 2, 3"""

FUNNEL = f"""SELECT {BUCKET} AS win_start, {BUCKET} + INTERVAL 10 MINUTE AS win_end, behavior,
 {STEP_CASE} AS step_name, COUNT(*) AS trigger_cnt
FROM src WHERE behavior IN ('pv', 'cart', 'fav', 'buy') GROUP BY 1, 2, 3"""


SQL: dict[str, str] = {
    "house_type_daily": _with("dwd") + f"""SELECT ds, room_num, hall_num, bathroom_num, {_stats()}
FROM dwd WHERE {HAS_ROOM} GROUP BY ds, room_num, hall_num, bathroom_num""",

    "listing_json_parse": _with("listing") + _ods_select(
        "CASE WHEN house_id LIKE '%-5' THEN NULL ELSE unit_price END")
    + " WHERE house_id NOT LIKE '%-4'",

    "listing_flatten": _with("listing") + _ods_select()
    + " WHERE NOT (house_id LIKE '%-3' AND unit_price % 2 = 0)",

    "ds_from_epoch": _with("listing") + """SELECT trace_id, event_time,
 strftime(to_timestamp(event_time) AT TIME ZONE 'UTC', '%Y%m%d') AS ds,
 strftime(to_timestamp(event_time) AT TIME ZONE 'Asia/Shanghai', '%Y%m%d') AS ds_shanghai
FROM listing""",

    "sentinel_to_null": _with("listing") + """SELECT trace_id, district AS district_raw,
 CASE WHEN district = 'TODO_MAPPING' THEN NULL ELSE district END AS district FROM listing""",

    "floor_ratio": _with("listing") + """SELECT trace_id, floor_level,
 CAST(CASE floor_level WHEN '低楼层' THEN 0.25 WHEN '中楼层' THEN 0.5 WHEN '高楼层' THEN 0.75
      ELSE 0.0 END AS DOUBLE) AS floor_ratio FROM listing""",

    "ring_road": _with("listing") + """SELECT trace_id, p2_desc,
 regexp_extract(p2_desc, '([一二三四五六]环(?:至[一二三四五六]环)?)', 1) AS ring_road FROM listing""",

    "room_type_key": _with("listing") + f"SELECT trace_id, {ROOM_TYPE} AS room_type FROM listing",

    "price_bucket": _with("listing") + f"""SELECT trace_id, {_r('total_price', 'total_price')},
 {PRICE_CASE} AS price_range FROM listing""",

    "build_year_bucket": _with("listing") + f"""SELECT trace_id, build_year, {YEAR_CASE} AS segment
FROM listing""",

    "parse_event_time": _with("msg") + f"""SELECT user_id, item_id, event_time,
 try_strptime(event_time, '{FMT}') AS ts_ltz FROM (
 SELECT user_id, item_id, CASE WHEN behavior = 'unknown' THEN 'not-a-time' ELSE event_time END
  AS event_time FROM msg)""",

    "event_date": _with("src") + "SELECT user_id, item_id, ts, CAST(ts_ltz AS DATE) AS dt FROM src",

    "epoch_to_string": _with("msg") + f"""SELECT ts,
 strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '{FMT}') AS event_time,
 strftime(to_timestamp(ts) AT TIME ZONE 'Asia/Shanghai', '{FMT}') AS event_time_shanghai FROM msg""",

    "contract_defaults": _with("listing") + f"""SELECT trace_id,
 CASE WHEN house_id LIKE '%-4' THEN 'made' ELSE 'given' END AS trace_id_form, true AS event_time_set,
 COALESCE(room_num, 0) AS room_num,
 COALESCE(hall_num, 0) AS hall_num, COALESCE(bathroom_num, 0) AS bathroom_num,
 COALESCE(floor_total, 0) AS floor_total, {_r('CAST(total_price AS DOUBLE)', 'total_price')},
 {_r('CAST(unit_price AS DOUBLE)', 'unit_price')}, {_r('CAST(area_sqm AS DOUBLE)', 'area_sqm')},
 build_year,
 COALESCE(array_to_string(CASE WHEN house_id LIKE '%-2' THEN NULL ELSE tags END, '|'), '') AS tags,
 COALESCE(CASE WHEN house_id LIKE '%-3' THEN NULL ELSE version END, '1.1') AS version
FROM listing""",

    "city_blacklist": _with("listing") + "SELECT trace_id, city FROM listing WHERE city NOT IN ('AFRICA')",

    "ts_range_filter": _with("msg") + f"""SELECT user_id, item_id, category_id, behavior,
 TRY_CAST(ts AS BIGINT) AS ts,
 strftime(to_timestamp(TRY_CAST(ts AS BIGINT)) AT TIME ZONE 'UTC', '{FMT}') AS event_time
FROM (SELECT user_id, item_id, category_id, behavior,
 CASE WHEN behavior IS NULL THEN 'abc' WHEN behavior = 'unknown' THEN CAST(ts % 1000 AS VARCHAR)
  ELSE CAST(ts AS VARCHAR) END AS ts FROM msg)
WHERE TRY_CAST(ts AS BIGINT) BETWEEN 900000000 AND 2000000000""",

    "incremental_since": _with("dwd") + f"""SELECT ds, orientation, {_stats()} FROM dwd
WHERE ds >= '20240103' GROUP BY ds, orientation""",

    "listing_fact": _with("dwd") + f"""SELECT ds, event_time, source, batch_id, trace_id, house_id,
 house_url, title, city, district, neighborhood, community, {_r('total_price', 'total_price')},
 unit_price, {_r('area_sqm', 'area_sqm')}, room_num, hall_num, bathroom_num, orientation,
 floor_level, floor_total, {_r('floor_ratio', 'floor_ratio')}, decoration, build_year,
 array_to_string(tags, '|') AS tags, attention_count, visit_30_days, subway_info, ring_road,
 p1_desc, p2_desc FROM dwd""",

    "approx_median": _with("dwd") + f"""SELECT ds, city,
 {_r('quantile_disc(total_price, 0.5)', 'median_total_price')},
 CAST(quantile_disc(unit_price, 0.5) AS DOUBLE) AS median_unit_price,
 {_r('quantile_disc(area_sqm, 0.5)', 'median_area_sqm')} FROM dwd GROUP BY ds, city""",

    "orientation_daily": _with("dwd") + f"SELECT ds, orientation, {_stats()} FROM dwd GROUP BY ds, orientation",

    "build_year_segment_daily": _with("dwd") + f"""SELECT ds, {YEAR_CASE} AS segment, {_stats()}
FROM dwd WHERE build_year IS NOT NULL GROUP BY ds, segment""",

    "price_range_distribution": _with("dwd") + f"""SELECT *,
 {_pct('house_count', 'CAST(SUM(house_count) OVER (PARTITION BY ds) AS BIGINT)')} AS percentage
FROM (SELECT ds, {PRICE_CASE} AS price_range, COUNT(*) AS house_count, {_r('avg(area_sqm)', 'avg_area_sqm')},
 {_r('avg(build_year)', 'avg_build_year')}, {_r('avg(total_price)', 'avg_total_price')},
 {_r('avg(unit_price)', 'avg_unit_price')} FROM dwd WHERE total_price > 0 GROUP BY 1, 2)""",

    "room_type_distribution": _with("dwd") + "SELECT * FROM " + _map_string(
        f"(SELECT ds, city, {ROOM_TYPE} AS room_type FROM dwd WHERE {HAS_ROOM})", "ds, city",
        "room_type", "room_type_distribution"),

    "decoration_distribution": _with("dwd") + "SELECT * FROM " + _map_string(
        f"(SELECT ds, city, decoration FROM dwd WHERE {HAS_ROOM})", "ds, city", "decoration",
        "decoration_distribution"),

    "hot_tags": _with("dwd") + "SELECT * FROM " + _hot_tags(
        "ds, city, district, neighborhood, community"),

    "community_daily": _community_daily(False),
    "community_daily_null_safe": _community_daily(True),

    "city_overview_daily": _with("dwd") + f"""SELECT ds, city, {_stats('total_house_count')},
 {_counts(ROOM_TYPE, HAS_ROOM)} AS room_type_distribution, {_counts('decoration', HAS_ROOM)} AS decoration_distribution
FROM dwd WHERE {HAS_ROOM} GROUP BY ds, city""",

    "hot_communities": _with("dwd") + f"""SELECT ds, {COMMUNITY}, house_count,
 {_r('avg_total_price', 'avg_total_price')}, {_r('avg_unit_price', 'avg_unit_price')},
 {_r('avg_area_sqm', 'avg_area_sqm')}, total_attention, total_visit_30,
 {_r('avg_attention', 'avg_attention')}, {_r('avg_visit_30', 'avg_visit_30')},
 rank_by_attention, rank_by_visit FROM (
 SELECT *, {_ranked_hot('total_attention')} AS rank_by_attention,
  {_ranked_hot('total_visit_30')} AS rank_by_visit FROM (
  SELECT ds, {COMMUNITY}, COUNT(*) AS house_count, avg(total_price) AS avg_total_price,
   avg(unit_price) AS avg_unit_price, avg(area_sqm) AS avg_area_sqm,
   CAST(SUM(attention_count) AS BIGINT) AS total_attention,
   CAST(SUM(visit_30_days) AS BIGINT) AS total_visit_30,
   avg(attention_count) AS avg_attention, avg(visit_30_days) AS avg_visit_30
  FROM dwd WHERE (attention_count > 0 OR visit_30_days > 0) AND attention_count IS NOT NULL
   AND visit_30_days IS NOT NULL GROUP BY ds, {COMMUNITY}))
WHERE rank_by_attention <= 100 OR rank_by_visit <= 100""",

    "top_attention_houses": _with("dwd") + f"""SELECT ds, city, rn AS "rank", house_id, house_url,
 title, community, {_r('total_price', 'total_price')}, unit_price, {_r('area_sqm', 'area_sqm')},
 attention_count, visit_30_days, array_to_string(tags, '|') AS tags FROM (
 SELECT *, CAST(row_number() OVER (PARTITION BY ds, city ORDER BY attention_count DESC,
  house_id ASC, trace_id ASC) AS INTEGER) AS rn
 FROM dwd WHERE attention_count IS NOT NULL AND attention_count > 0) WHERE rn <= 10""",

    "dim_category": _with("dim") + "SELECT category_id, category_name FROM dim",

    "click_to_json": _with("msg") + """SELECT user_id AS key,
 '{"user_id":"' || user_id || '","item_id":"' || item_id || '","category_id":"' || category_id
 || '"' || CASE WHEN behavior IS NULL THEN '' ELSE ',"behavior":"' || behavior || '"' END
 || ',"ts":' || CAST(ts AS VARCHAR) || ',"event_time":"' || event_time || '"}' AS value FROM msg""",

    "funnel_step": _with("click") + f"SELECT event_id, behavior, {STEP_CASE} AS step_name FROM click",

    "click_ods": _with("src") + """SELECT user_id, item_id, category_id, behavior, ts, event_time,
 ts_ltz, CAST(ts_ltz AS DATE) AS dt FROM src""",

    "click_dwd": _with("src") + """SELECT user_id, item_id, category_id, behavior, ts, ts_ltz,
 CAST(ts_ltz AS DATE) AS dt FROM src
WHERE behavior IS NOT NULL AND behavior IN ('pv', 'buy', 'cart', 'fav')""",

    "category_window_metrics": _windowed(CATEGORY_METRICS),
    "behavior_funnel_windows": _windowed(FUNNEL),

    "view_category_metrics": _with("src", "dim", extra=f"m AS ({CATEGORY_METRICS})")
    + """SELECT d.category_name AS category_name, CAST(SUM(m.pv_cnt) AS BIGINT) AS total_pv,
 CAST(SUM(m.cart_cnt) AS BIGINT) AS total_cart, CAST(SUM(m.fav_cnt) AS BIGINT) AS total_fav,
 CAST(SUM(m.buy_cnt) AS BIGINT) AS total_buy
FROM m JOIN dim d ON m.category_id = d.category_id GROUP BY d.category_name""",

    "view_behavior_funnel": _with("src", extra=f"f AS ({FUNNEL})")
    + "SELECT step_name, CAST(SUM(trigger_cnt) AS BIGINT) AS trigger_cnt FROM f GROUP BY step_name",

    # --- serving analyses ---------------------------------------------------
    "bi_market_overview": _with("dwd") + f"""SELECT deco.ds, deco.decoration, day.total_listings,
 {_r('day.avg_unit_price', 'avg_unit_price')}, deco.decoration_count,
 {_pct('deco.decoration_count', 'day.total_listings')} AS decoration_share
FROM (SELECT ds, decoration, COUNT(*) AS decoration_count FROM dwd WHERE decoration IS NOT NULL
  GROUP BY ds, decoration) deco
JOIN (SELECT ds, COUNT(*) AS total_listings, avg(unit_price) AS avg_unit_price FROM dwd
  GROUP BY ds) day ON deco.ds = day.ds""",

    "bi_neighborhood_heat": _with("dwd") + f"""SELECT city, neighborhood, COUNT(*) AS listing_count,
 CAST(SUM(attention_count) AS BIGINT) AS total_attention,
 CAST(SUM(visit_30_days) AS BIGINT) AS total_visits,
 {_r('avg(attention_count)', 'avg_attention')}, {_r('avg(visit_30_days)', 'avg_visits')}
FROM dwd GROUP BY city, neighborhood""",

    "bi_price_structure": _with("dwd") + f"""SELECT {PRICE_CASE} AS price_range, {YEAR_CASE} AS segment,
 COUNT(*) AS listing_count, {_r('avg(area_sqm)', 'avg_area_sqm')},
 {_r('corr(total_price, area_sqm)', 'price_area_corr')}
FROM dwd WHERE total_price > 0 GROUP BY 1, 2""",

    "bi_type_orientation": _with("dwd") + f"""SELECT {ROOM_TYPE} AS room_type, orientation,
 COUNT(*) AS listing_count, {_r('avg(unit_price)', 'avg_unit_price')}
FROM dwd WHERE {HAS_ROOM} GROUP BY 1, 2""",

    "bi_high_attention_profile": _with("dwd") + f"""SELECT b.ds,
 CASE WHEN a.above_n < a.total_n * 0.1 THEN 'high' ELSE 'rest' END AS segment,
 COUNT(*) AS listing_count, {_r('avg(b.total_price)', 'avg_total_price')},
 {_r('avg(b.area_sqm)', 'avg_area_sqm')}, {_r('avg(b.build_year)', 'avg_build_year')},
 {_r('avg(b.attention_count)', 'avg_attention')}
FROM (SELECT * FROM dwd WHERE attention_count IS NOT NULL) b
JOIN (SELECT ds, attention_count,
  SUM(n) OVER (PARTITION BY ds ORDER BY attention_count DESC) - n AS above_n,
  SUM(n) OVER (PARTITION BY ds) AS total_n
  FROM (SELECT ds, attention_count, COUNT(*) AS n FROM dwd WHERE attention_count IS NOT NULL
   GROUP BY ds, attention_count)) a
 ON b.ds = a.ds AND b.attention_count = a.attention_count
GROUP BY 1, 2""",
}


def oracle_sql() -> dict[str, str]:
    from . import oracle_more, oracle_tables
    return SQL | oracle_more.SQL | oracle_tables.SQL
