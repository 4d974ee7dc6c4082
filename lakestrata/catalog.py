"""Registry of runnable queries: one entry per operator/table of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the driver
tables at that scale.  Outputs are *rendered* for cross-engine comparison:
maps become sorted ``k:v`` strings, arrays ``|``-joined strings and doubles are
rounded to 6 places (the library functions themselves return maps, arrays
and unrounded doubles).  ``lakestrata.oracle`` holds the DuckDB twin of
every entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures
from .functions import expressions as X
from .operators import quality
from .operators.aggregate import distribution_map, top_values, with_medians
from .operators.nested import flatten_listing, parse_listing_json, to_listing_message
from .plans import bi, clicks, listings
from .sinks.files import to_message
from .sources.batch import load_dimension, normalise_click_log

# Fixture parameter: the reference's city names do not occur in the driver
# data, so the blacklist test value is a region that does.
TEST_BLACKLIST = ("AFRICA",)
TZ = "UTC"

Query = Callable[[SparkSession, str], DataFrame]


def render(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable form: doubles rounded (9 then 6 places), maps as sorted ``k:v``, arrays ``|``-joined."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            # two-step decimal rounding: near-ties from summation order snap
            # to the same 9-digit value first, then round half-up
            c = c.cast("decimal(38,9)").cast(f"decimal(38,{digits})").cast("double")
        elif isinstance(f.dataType, T.MapType):
            entries = F.array_sort(F.map_entries(c))
            c = F.array_join(F.transform(entries, lambda e: F.concat(
                e["key"].cast("string"), F.lit(":"), e["value"].cast("string"))), ",")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- listings --

def listing(spark, sf) -> DataFrame:
    return fixtures.listing(spark, sf)


def ods(spark, sf) -> DataFrame:
    """Flat ODS rows via the nested message (reproducible: no ``etl_time``)."""
    return flatten_listing(to_listing_message(listing(spark, sf)), with_etl_time=False)


def dwd(spark, sf) -> DataFrame:
    """The DWD fact computed from the listing messages (the DWD load itself)."""
    return listings.listing_fact(ods(spark, sf), TEST_BLACKLIST, tz=TZ)


_DWD_TABLES: dict = {}


def dwd_table(spark, sf) -> DataFrame:
    """The DWD fact as a written ``ds``-partitioned table, as the DWS/ADS loads
    read it.  Built once per application and scale directory (by Spark, from
    the driver tables) under the shared checkpoint folder."""
    from .session import scratch_path
    from .sinks.files import overwrite_partitions, place
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DWD_TABLES:
        fact = dwd(spark, sf)
        path = scratch_path(spark, "dwd_ershoufang_fact")
        overwrite_partitions(fact, path, by=place(fact, "ds"))
        _DWD_TABLES[key] = (path, fact.schema)
    path, schema = _DWD_TABLES[key]
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def q_listing_json_parse(spark, sf):
    msg = to_listing_message(listing(spark, sf))
    value = F.to_json(F.struct("header", "core_data", "ext_attributes"))
    hid = F.col("core_data.house_id")
    value = (F.when(hid.endswith("-4"), F.regexp_replace(value, "^[{]", ""))
             .when(hid.endswith("-5"), F.regexp_replace(value, '"unit_price":[0-9]+',
                                                        '"unit_price":"n/a"'))
             .otherwise(value))
    parsed = parse_listing_json(msg.select(value.alias("value")))
    return flatten_listing(parsed, with_etl_time=False)


def q_listing_flatten(spark, sf):
    src = listing(spark, sf)
    drop_id = F.col("house_id").endswith("-3") & (F.col("unit_price") % 2 == 0)
    src = src.withColumn("house_id", F.when(drop_id, F.lit(None)).otherwise(F.col("house_id")))
    return flatten_listing(to_listing_message(src), with_etl_time=False)


def q_ds_from_epoch(spark, sf):
    return listing(spark, sf).select(
        "trace_id", "event_time", X.ds_from_epoch("event_time", "UTC").alias("ds"),
        X.ds_from_epoch("event_time", "Asia/Shanghai").alias("ds_shanghai"))


def q_sentinel_to_null(spark, sf):
    return listing(spark, sf).select("trace_id", F.col("district").alias("district_raw"),
                                     X.null_if("district").alias("district"))


def q_floor_ratio(spark, sf):
    return listing(spark, sf).select("trace_id", "floor_level",
                                     X.floor_ratio("floor_level").alias("floor_ratio"))


def q_ring_road(spark, sf):
    return listing(spark, sf).select("trace_id", "p2_desc", X.ring_road("p2_desc").alias("ring_road"))


def q_room_type_key(spark, sf):
    return listing(spark, sf).select(
        "trace_id", X.room_type("room_num", "hall_num", "bathroom_num").alias("room_type"))


def q_price_bucket(spark, sf):
    return listing(spark, sf).select("trace_id", "total_price",
                                     X.price_range("total_price").alias("price_range"))


def q_build_year_bucket(spark, sf):
    return listing(spark, sf).select("trace_id", "build_year",
                                     X.year_segment("build_year").alias("segment"))


def q_contract_defaults(spark, sf):
    src = listing(spark, sf)
    src = (src.withColumn("tags", F.when(F.col("house_id").endswith("-2"), F.lit(None))
                          .otherwise(F.col("tags")))
           .withColumn("version", F.when(F.col("house_id").endswith("-3"), F.lit(None))
                       .otherwise(F.col("version")))
           .withColumn("row", F.col("trace_id"))
           .withColumn("trace_id", F.when(~F.col("house_id").endswith("-4"), F.col("trace_id")))
           .withColumn("event_time", F.when(~F.col("house_id").endswith("-1"), F.col("event_time"))))
    out = quality.apply_contract(src).withColumn(
        "trace_id_form", F.when(F.col("trace_id") == F.col("row"), "given")
        .when(F.col("trace_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), "made").otherwise("missing")).withColumn(
        "event_time_set", F.col("event_time").isNotNull())
    return out.select(F.col("row").alias("trace_id"), "trace_id_form", "event_time_set", "room_num", "hall_num", "bathroom_num", "floor_total",
                      "total_price", "unit_price", "area_sqm", "build_year", "tags", "version")


def q_city_blacklist(spark, sf):
    return quality.city_blacklist(listing(spark, sf), TEST_BLACKLIST).select("trace_id", "city")


def q_incremental_since(spark, sf):
    return listings.orientation_daily(dwd_table(spark, sf), since="20240103")


def q_listing_fact(spark, sf):
    return dwd(spark, sf)


def q_approx_median(spark, sf):
    """Exact medians of three columns per day and city."""
    keys = ["ds", "city"]
    names = {"total_price": "median_total_price", "unit_price": "median_unit_price", "area_sqm": "median_area_sqm"}
    return with_medians(dwd_table(spark, sf), keys, names, [])


def q_room_type_distribution(spark, sf):
    base = dwd_table(spark, sf).dropna(subset=list(listings.ROOM_PARTS)).select(
        "ds", "city", X.room_type(*listings.ROOM_PARTS).alias("room_type"))
    return distribution_map(base, ["ds", "city"], "room_type", "room_type_distribution")


def q_decoration_distribution(spark, sf):
    base = dwd_table(spark, sf).dropna(subset=list(listings.ROOM_PARTS))
    return distribution_map(base, ["ds", "city"], "decoration", "decoration_distribution")


def q_hot_tags(spark, sf):
    keys = ["ds", "city", "district", "neighborhood", "community"]
    return top_values(dwd_table(spark, sf), keys, "tags", "hot_tags", 5)


# ------------------------------------------------------------------ clicks --

def click_src(spark, sf) -> DataFrame:
    return clicks.with_event_time(clicks.click_messages(fixtures.click(spark, sf)))


def q_parse_event_time(spark, sf):
    msg = clicks.click_messages(fixtures.click(spark, sf))
    msg = msg.withColumn("event_time", F.when(F.col("behavior") == "unknown", F.lit("not-a-time"))
                         .otherwise(F.col("event_time")))
    return msg.select("user_id", "item_id", "event_time",
                      X.instant_to_wall(X.parse_event_time("event_time")).alias("ts_ltz"))


def q_event_date(spark, sf):
    return click_src(spark, sf).select("user_id", "item_id", "ts",
                                       X.event_date("ts_ltz").alias("dt"))


def q_epoch_to_string(spark, sf):
    msg = clicks.click_messages(fixtures.click(spark, sf))
    return msg.select("ts", X.epoch_to_string("ts", "UTC").alias("event_time"),
                      X.epoch_to_string("ts", "Asia/Shanghai").alias("event_time_shanghai"))


def q_ts_range_filter(spark, sf):
    msg = clicks.click_messages(fixtures.click(spark, sf))
    ts_text = (F.when(F.col("behavior").isNull(), F.lit("abc"))
               .when(F.col("behavior") == "unknown", (F.col("ts") % 1000).cast("string"))
               .otherwise(F.col("ts").cast("string")))
    log = msg.select("user_id", "item_id", "category_id", "behavior", ts_text.alias("ts"))
    return normalise_click_log(log, tz=TZ)


def q_dim_category(spark, sf):
    return load_dimension(fixtures.dim(spark, sf), "category_id", "category_name")


def q_click_to_json(spark, sf):
    return to_message(clicks.click_messages(fixtures.click(spark, sf)), key="user_id")


def q_funnel_step(spark, sf):
    return fixtures.click(spark, sf).select("event_id", "behavior",
                                            X.funnel_step("behavior").alias("step_name"))


def q_view_category_metrics(spark, sf):
    metrics = clicks.category_window_metrics(click_src(spark, sf))
    dim = load_dimension(fixtures.dim(spark, sf), "category_id", "category_name", check_unique=False)
    return clicks.view_category_metrics(metrics, dim)


def q_view_behavior_funnel(spark, sf):
    return clicks.view_behavior_funnel(clicks.behavior_funnel_windows(click_src(spark, sf)))


# ---------------------------------------------------------------- registry --

def _on_dwd(fn, **kw) -> Query:
    return lambda spark, sf: fn(dwd_table(spark, sf), **kw)


def _on_clicks(fn) -> Query:
    return lambda spark, sf: fn(click_src(spark, sf))


RAW: dict[str, Query] = {
    "house_type_daily": _on_dwd(listings.house_type_daily),
    "listing_json_parse": q_listing_json_parse,
    "listing_flatten": q_listing_flatten,
    "ds_from_epoch": q_ds_from_epoch,
    "sentinel_to_null": q_sentinel_to_null,
    "floor_ratio": q_floor_ratio,
    "ring_road": q_ring_road,
    "room_type_key": q_room_type_key,
    "price_bucket": q_price_bucket,
    "build_year_bucket": q_build_year_bucket,
    "parse_event_time": q_parse_event_time,
    "event_date": q_event_date,
    "epoch_to_string": q_epoch_to_string,
    "contract_defaults": q_contract_defaults,
    "city_blacklist": q_city_blacklist,
    "ts_range_filter": q_ts_range_filter,
    "incremental_since": q_incremental_since,
    "listing_fact": q_listing_fact,
    "approx_median": q_approx_median,
    "orientation_daily": _on_dwd(listings.orientation_daily),
    "build_year_segment_daily": _on_dwd(listings.build_year_segment_daily),
    "price_range_distribution": _on_dwd(listings.price_range_distribution),
    "room_type_distribution": q_room_type_distribution,
    "decoration_distribution": q_decoration_distribution,
    "hot_tags": q_hot_tags,
    "community_daily": _on_dwd(listings.community_daily),
    "community_daily_null_safe": _on_dwd(listings.community_daily, null_safe=True),
    "city_overview_daily": _on_dwd(listings.city_overview_daily),
    "hot_communities": _on_dwd(listings.hot_communities),
    "top_attention_houses": _on_dwd(listings.top_attention_houses),
    "dim_category": q_dim_category,
    "click_to_json": q_click_to_json,
    "funnel_step": q_funnel_step,
    "click_ods": _on_clicks(clicks.click_ods),
    "click_dwd": _on_clicks(clicks.click_dwd),
    "category_window_metrics": _on_clicks(clicks.category_window_metrics),
    "behavior_funnel_windows": _on_clicks(clicks.behavior_funnel_windows),
    "view_category_metrics": q_view_category_metrics,
    "view_behavior_funnel": q_view_behavior_funnel,
}


def _register_more() -> None:
    from . import catalog_more, catalog_tables
    RAW.update(catalog_more.QUERIES)
    RAW.update(catalog_tables.QUERIES)
    RAW.update({k: (lambda fn: (lambda spark, sf: fn(dwd_table(spark, sf))))(fn)
                for k, fn in bi.QUERIES.items()})


_register_more()


def queries() -> dict[str, Query]:
    return {name: (lambda fn: (lambda spark, sf: render(fn(spark, sf))))(fn)
            for name, fn in RAW.items()}
