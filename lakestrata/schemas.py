"""Declared schemas and column orders of every table the pipelines write."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


HEADER = _struct(("source", S), ("event_time", L), ("version", S), ("trace_id", S),
                 ("batch_id", S))
CORE_DATA = _struct(
    ("house_id", S), ("house_url", S), ("title", S), ("city", S), ("district", S),
    ("neighborhood", S), ("community", S), ("total_price", D), ("unit_price", I),
    ("area_sqm", D), ("room_num", I), ("hall_num", I), ("bathroom_num", I),
    ("orientation", S), ("floor_level", S), ("floor_total", I), ("decoration", S),
    ("build_year", I))
EXT_ATTRIBUTES = _struct(
    ("tags", T.ArrayType(S)),
    ("follow_info", _struct(("attention_count", I), ("visit_30_days", I))),
    ("subway_info", S),
    ("raw_info", _struct(("p1_desc", S), ("p2_desc", S))))

# Nested listing message as it arrives on the topic.
LISTING_MESSAGE = _struct(("header", HEADER), ("core_data", CORE_DATA),
                          ("ext_attributes", EXT_ATTRIBUTES))

# Flat ODS listing, key (house_id, city), partitioned by city.
ODS_LISTING_COLUMNS = (
    "house_id", "source", "event_time", "version", "trace_id", "batch_id", "house_url",
    "title", "city", "district", "neighborhood", "community", "total_price", "unit_price",
    "area_sqm", "room_num", "hall_num", "bathroom_num", "orientation", "floor_level",
    "floor_total", "decoration", "build_year", "tags", "attention_count", "visit_30_days",
    "subway_info", "raw_p1_desc", "raw_p2_desc", "etl_time")
ODS_KEYS = ("house_id", "city")

# DWD listing fact, partitioned by ds.
DWD_COLUMNS = (
    "ds", "event_time", "source", "batch_id", "trace_id", "house_id", "house_url", "title",
    "city", "district", "neighborhood", "community", "total_price", "unit_price", "area_sqm",
    "room_num", "hall_num", "bathroom_num", "orientation", "floor_level", "floor_total",
    "floor_ratio", "decoration", "build_year", "tags", "attention_count", "visit_30_days",
    "subway_info", "ring_road", "p1_desc", "p2_desc")

COMMUNITY_KEYS = ("city", "district", "neighborhood", "community")

DWS_COMMUNITY_COLUMNS = (
    "ds", "city", "district", "neighborhood", "community", "house_count", "avg_total_price",
    "median_total_price", "min_total_price", "max_total_price", "avg_unit_price",
    "median_unit_price", "avg_area_sqm", "room_type_distribution", "avg_attention_count",
    "avg_visit_30_days", "hot_tags")
PRICE_STATS = ("house_count", "avg_total_price", "median_total_price", "avg_unit_price",
               "median_unit_price", "avg_area_sqm")
DWS_HOUSE_TYPE_COLUMNS = ("ds", "room_num", "hall_num", "bathroom_num") + PRICE_STATS
DWS_ORIENTATION_COLUMNS = ("ds", "orientation") + PRICE_STATS
DWS_BUILD_YEAR_COLUMNS = ("ds", "segment") + PRICE_STATS
ADS_CITY_OVERVIEW_COLUMNS = (
    "ds", "city", "total_house_count", "avg_total_price", "median_total_price",
    "avg_unit_price", "median_unit_price", "avg_area_sqm", "room_type_distribution",
    "decoration_distribution")
ADS_HOT_COMMUNITIES_COLUMNS = (
    "ds", "city", "district", "neighborhood", "community", "house_count", "avg_total_price",
    "avg_unit_price", "avg_area_sqm", "total_attention", "total_visit_30", "avg_attention",
    "avg_visit_30", "rank_by_attention", "rank_by_visit")
ADS_PRICE_RANGE_COLUMNS = (
    "ds", "price_range", "house_count", "percentage", "avg_area_sqm", "avg_build_year",
    "avg_total_price", "avg_unit_price")
ADS_TOP_HOUSES_COLUMNS = (
    "ds", "city", "rank", "house_id", "house_url", "title", "community", "total_price",
    "unit_price", "area_sqm", "attention_count", "visit_30_days", "tags")

# Click message (JSON value on the topic) and derived tables.
CLICK_MESSAGE = _struct(("user_id", S), ("item_id", S), ("category_id", S), ("behavior", S),
                        ("ts", L), ("event_time", S))
CLICK_CSV = _struct(("user_id", S), ("item_id", S), ("category_id", S), ("behavior", S),
                    ("ts", S))
CLICK_ODS_COLUMNS = ("user_id", "item_id", "category_id", "behavior", "ts", "event_time",
                     "ts_ltz", "dt")
CLICK_DWD_COLUMNS = ("user_id", "item_id", "category_id", "behavior", "ts", "ts_ltz", "dt")
CATEGORY_METRICS_COLUMNS = ("win_start", "win_end", "category_id", "pv_cnt", "cart_cnt",
                            "fav_cnt", "buy_cnt")
BEHAVIOR_FUNNEL_COLUMNS = ("win_start", "win_end", "behavior", "step_name", "trigger_cnt")
DIM_CATEGORY = _struct(("category_id", S), ("category_name", S))


# Declared column types of the tables; a column not named here is a string.
_DOUBLES = ("total_price", "area_sqm", "floor_ratio", "percentage", "avg_total_price", "median_total_price",
            "min_total_price", "max_total_price", "avg_unit_price", "median_unit_price", "avg_area_sqm",
            "avg_build_year", "avg_attention_count", "avg_visit_30_days", "avg_attention", "avg_visit_30")
_BIGINTS = ("house_count", "total_house_count", "total_attention", "total_visit_30", "ts", "pv_cnt", "cart_cnt",
            "fav_cnt", "buy_cnt", "trigger_cnt")
_INTS = ("unit_price", "room_num", "hall_num", "bathroom_num", "floor_total", "build_year", "attention_count",
         "visit_30_days", "rank", "rank_by_attention", "rank_by_visit")
_OTHERS = {"tags": T.ArrayType(S), "hot_tags": T.ArrayType(S), "dt": T.DateType(), "ts_ltz": T.TimestampNTZType(),
           "win_start": T.TimestampNTZType(), "win_end": T.TimestampNTZType(), "etl_time": T.TimestampType(),
           "room_type_distribution": T.MapType(S, L), "decoration_distribution": T.MapType(S, L)}
_TYPES = {**dict.fromkeys(_DOUBLES, D), **dict.fromkeys(_BIGINTS, L), **dict.fromkeys(_INTS, I), **_OTHERS}


def _typed(columns, **other) -> T.StructType:
    return _struct(*[(c, {**_TYPES, **other}.get(c, S)) for c in columns])


# Every table the pipelines write, as declared; rows are conformed to it before a write.
TABLES: dict[str, T.StructType] = {
    "ods_ershoufang": _typed(ODS_LISTING_COLUMNS, event_time=L),
    "dwd_ershoufang_fact": _typed(DWD_COLUMNS, event_time=L),
    "dws_community_daily": _typed(DWS_COMMUNITY_COLUMNS, room_type_distribution=T.MapType(S, I)),
    "dws_house_type_daily": _typed(DWS_HOUSE_TYPE_COLUMNS),
    "dws_orientation_daily": _typed(DWS_ORIENTATION_COLUMNS),
    "dws_build_year_segment_daily": _typed(DWS_BUILD_YEAR_COLUMNS),
    "ads_city_overview_daily": _typed(ADS_CITY_OVERVIEW_COLUMNS),
    "ads_price_range_distribution_daily": _typed(ADS_PRICE_RANGE_COLUMNS),
    "ads_hot_communities_daily": _typed(ADS_HOT_COMMUNITIES_COLUMNS),
    "ads_top10_attention_houses_daily": _typed(ADS_TOP_HOUSES_COLUMNS),
    "ods_user_behavior": _typed(CLICK_ODS_COLUMNS),
    "dwd_user_behavior": _typed(CLICK_DWD_COLUMNS),
    "dws_category_metrics": _typed(CATEGORY_METRICS_COLUMNS),
    "dws_behavior_funnel": _typed(BEHAVIOR_FUNNEL_COLUMNS),
}


def conform(df, target) -> "DataFrame":  # noqa: F821
    """Select and cast ``df`` to a target schema *by name* (PRJ-16, SNK-2).

    ``target`` is a ``StructType`` (columns are cast to its types) or a list
    of column names (order only).  Missing columns are an error; a ``rank``
    keyword column needs no quoting because names are passed as strings.
    """
    from pyspark.sql import functions as F
    if isinstance(target, T.StructType):
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                           for f in target.fields])
    return df.select(*[F.col(f"`{c}`") for c in target])
