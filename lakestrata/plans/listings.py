"""Daily listing warehouse: ODS -> DWD -> DWS / ADS (WH-1 .. WH-9).

Each table is a pure ``DataFrame -> DataFrame`` function of the DWD fact, so
the eight loads are independent and can be scheduled in any order; the DWD
is written once and read back by all of them (``run_daily``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expressions as X
from ..operators.aggregate import (PRICE_MEDIANS, distribution_map, empty_array_if_null, empty_map_if_null, null_safe,
                                   price_stats, share_of_total, top_values, with_medians)
from ..operators.quality import city_blacklist
from ..operators.rank import ranks_with_cutoff, top_n_per_group
from ..schemas import (ADS_CITY_OVERVIEW_COLUMNS, ADS_HOT_COMMUNITIES_COLUMNS,
                       ADS_PRICE_RANGE_COLUMNS, ADS_TOP_HOUSES_COLUMNS, COMMUNITY_KEYS,
                       DWD_COLUMNS, DWS_BUILD_YEAR_COLUMNS, DWS_COMMUNITY_COLUMNS,
                       DWS_HOUSE_TYPE_COLUMNS, DWS_ORIENTATION_COLUMNS, TABLES, conform)

ROOM_PARTS = ("room_num", "hall_num", "bathroom_num")


def since_until(df: DataFrame, since: str | None = None, until: str | None = None,
                col: str = "ds") -> DataFrame:
    """Optional incremental day range (FIL-11); prunes partitions on a ``ds`` table."""
    if since is not None:
        df = df.where(F.col(col) >= F.lit(since))
    if until is not None:
        df = df.where(F.col(col) <= F.lit(until))
    return df


def _offset_bounds(day: str, zone: str | None) -> int:
    """Epoch second at which a day ``yyyyMMdd`` begins in ``zone``."""
    at = datetime.strptime(day, "%Y%m%d")
    return int(at.replace(tzinfo=ZoneInfo(zone)).timestamp())


def event_time_range(df: DataFrame, since: str | None, until: str | None, tz: str | None,
                     col: str = "event_time") -> DataFrame:
    """Rows whose epoch second can lie in the days ``since`` .. ``until`` of a zone (WH-1, FIL-11).

    The inverse of the day key as a range on the stored column, so that it reaches the scan; the exact filter
    on the day key follows.  The bounds are widened by three hours, because around a change of the clocks
    near midnight a day need not be one interval; zones that are not in the zone database (``GMT+8``) get
    the range of all zones.  Days must be ``yyyyMMdd``; other texts give no range.
    """
    zone = tz or df.sparkSession.conf.get("spark.sql.session.timeZone")
    try:
        ZoneInfo(zone)
        slack = 3 * 3600
    except (ZoneInfoNotFoundError, ValueError):
        zone, slack = "UTC", 18 * 3600
    day = 86_400
    if since is not None and re.fullmatch(r"\d{8}", since):
        df = df.where(F.col(col) >= _offset_bounds(since, zone) - slack)
    if until is not None and re.fullmatch(r"\d{8}", until):
        df = df.where(F.col(col) < _offset_bounds(until, zone) + day + slack)
    return df


def listing_fact(ods: DataFrame, blacklist: Sequence[str] = K.CITY_BLACKLIST,
                 tz: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """Flat ODS listing -> DWD fact (WH-1), of the days ``since`` .. ``until``.

    ``tz=None`` derives ``ds`` in the session time zone like ``FROM_UNIXTIME``;
    pass a zone to make the partition key independent of the session.
    """
    out = city_blacklist(event_time_range(ods, since, until, tz), blacklist).select(
        X.ds_from_epoch("event_time", tz).alias("ds"),
        "event_time", "source", "batch_id", "trace_id", "house_id", "house_url", "title",
        "city", X.null_if("district").alias("district"), "neighborhood", "community",
        "total_price", "unit_price", "area_sqm", "room_num", "hall_num", "bathroom_num",
        "orientation", "floor_level", "floor_total",
        X.floor_ratio("floor_level").alias("floor_ratio"), "decoration", "build_year",
        "tags", "attention_count", "visit_30_days", "subway_info",
        X.ring_road("raw_p2_desc").alias("ring_road"),
        F.col("raw_p1_desc").alias("p1_desc"), F.col("raw_p2_desc").alias("p2_desc"))
    return since_until(out.select(*DWD_COLUMNS), since, until)


def _left_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
               null_keys: bool = False) -> DataFrame:
    """LEFT JOIN on ``keys``; NULL keys never match unless ``null_keys``."""
    return null_safe(left, right, keys) if null_keys else left.join(right, list(keys), "left")


def community_daily(dwd: DataFrame, null_safe: bool = False, since: str | None = None,
                    until: str | None = None) -> DataFrame:
    """``dws_community_daily`` (WH-2): stats, room-type map and hot tags per community/day.

    Three aggregates over the same grouping keys, each reading its own columns; map and tags are joined
    on the group (a NULL in the key finds them only with ``null_safe``).
    """
    base = since_until(dwd, since, until)
    keys = list(COMMUNITY_KEYS) + ["ds"]
    stats = with_medians(base, keys, PRICE_MEDIANS, price_stats() + [
        F.min("total_price").alias("min_total_price"),
        F.max("total_price").alias("max_total_price"),
        F.avg("attention_count").alias("avg_attention_count"),
        F.avg("visit_30_days").alias("avg_visit_30_days")])
    rooms = (base.where(F.col("room_num").isNotNull() & F.col("hall_num").isNotNull()
                        & F.col("bathroom_num").isNotNull())
             .select(*keys, X.room_type(*ROOM_PARTS).alias("room_type")))
    room_map = distribution_map(rooms, keys, "room_type", "room_type_distribution")
    tags = top_values(base.where(F.col("tags").isNotNull()), keys, "tags", "hot_tags",
                      K.HOT_TAGS_N)
    joined = _left_join(_left_join(stats, room_map, keys, null_safe), tags, keys, null_safe)
    return joined.select(*[
        empty_map_if_null(c) if c == "room_type_distribution"
        else empty_array_if_null(c) if c == "hot_tags" else F.col(c)
        for c in DWS_COMMUNITY_COLUMNS])


def _price_summary(base: DataFrame, keys: Sequence[str], count_name: str = "house_count") -> DataFrame:
    return with_medians(base, keys, PRICE_MEDIANS, price_stats(count_name))


def house_type_daily(dwd: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """``dws_house_type_daily`` (WH-3): rows with full room info, per day x room x hall x bath."""
    base = since_until(dwd, since, until).dropna(subset=list(ROOM_PARTS))
    return _price_summary(base, ["ds", *ROOM_PARTS]).select(*DWS_HOUSE_TYPE_COLUMNS)


def orientation_daily(dwd: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """``dws_orientation_daily`` (WH-4); a NULL orientation is its own group."""
    return _price_summary(since_until(dwd, since, until), ["ds", "orientation"]).select(*DWS_ORIENTATION_COLUMNS)


def build_year_segment_daily(dwd: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """``dws_build_year_segment_daily`` (WH-5): rows with a build year, per day x segment."""
    base = (since_until(dwd, since, until).where(F.col("build_year").isNotNull())
            .withColumn("segment", X.year_segment("build_year")))
    return _price_summary(base, ["ds", "segment"]).select(*DWS_BUILD_YEAR_COLUMNS)


def city_overview_daily(dwd: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """``ads_city_overview_daily`` (WH-6): only listings with full room info count."""
    base = (since_until(dwd, since, until).dropna(subset=list(ROOM_PARTS))
            .select("ds", "city", "total_price", "unit_price", "area_sqm", "decoration",
                    X.room_type(*ROOM_PARTS).alias("room_type")))
    keys = ["ds", "city"]
    stats = _price_summary(base, keys, "total_house_count")
    room_map = distribution_map(base, keys, "room_type", "room_type_distribution")
    deco_map = distribution_map(base, keys, "decoration", "decoration_distribution")
    joined = _left_join(_left_join(stats, room_map, keys), deco_map, keys)
    return joined.select(*[
        empty_map_if_null(c) if c.endswith("_distribution") else F.col(c)
        for c in ADS_CITY_OVERVIEW_COLUMNS])


def price_range_distribution(dwd: DataFrame, since: str | None = None,
                             until: str | None = None) -> DataFrame:
    """``ads_price_range_distribution_daily`` (WH-7): bucket stats and share of the day."""
    base = (since_until(dwd, since, until)
            .where(F.col("total_price").isNotNull() & (F.col("total_price") > 0))
            .withColumn("price_range", X.price_range("total_price")))
    stats = base.groupBy("ds", "price_range").agg(
        F.count(F.lit(1)).alias("house_count"),
        F.avg("area_sqm").alias("avg_area_sqm"),
        F.avg("build_year").alias("avg_build_year"),
        F.avg("total_price").alias("avg_total_price"),
        F.avg("unit_price").alias("avg_unit_price"))
    return share_of_total(stats, ["ds"], "house_count", "percentage").select(
        *ADS_PRICE_RANGE_COLUMNS)


HOT_TIE_BREAK = [(c, True) for c in COMMUNITY_KEYS]


def hot_communities(dwd: DataFrame, cutoff: int = K.HOT_COMMUNITY_CUTOFF,
                    since: str | None = None, until: str | None = None) -> DataFrame:
    """``ads_hot_communities_daily`` (WH-8): communities in the top ``cutoff`` by
    attention or by visits, with both exact row numbers.

    Ties in the reference order are broken by the community key (city,
    district, neighborhood, community ascending, NULLs first).
    """
    base = (since_until(dwd, since, until)
            .where(((F.col("attention_count") > 0) | (F.col("visit_30_days") > 0))
                   & F.col("attention_count").isNotNull() & F.col("visit_30_days").isNotNull()))
    agg = base.groupBy("ds", *COMMUNITY_KEYS).agg(
        F.count(F.lit(1)).alias("house_count"),
        F.avg("total_price").alias("avg_total_price"),
        F.avg("unit_price").alias("avg_unit_price"),
        F.avg("area_sqm").alias("avg_area_sqm"),
        F.sum("attention_count").cast("long").alias("total_attention"),
        F.sum("visit_30_days").cast("long").alias("total_visit_30"),
        F.avg("attention_count").alias("avg_attention"),
        F.avg("visit_30_days").alias("avg_visit_30"))
    ranked = ranks_with_cutoff(agg, ["ds"], {
        "rank_by_attention": [("total_attention", False)] + HOT_TIE_BREAK,
        "rank_by_visit": [("total_visit_30", False)] + HOT_TIE_BREAK,
    }, cutoff)
    return ranked.select(*ADS_HOT_COMMUNITIES_COLUMNS)


def top_attention_houses(dwd: DataFrame, n: int = K.TOP_HOUSES_PER_CITY,
                         since: str | None = None, until: str | None = None) -> DataFrame:
    """``ads_top10_attention_houses_daily`` (WH-9): top ``n`` per day and city.

    Ties on ``attention_count`` are broken by ``house_id`` then ``trace_id``.
    """
    base = (since_until(dwd, since, until)
            .where(F.col("attention_count").isNotNull() & (F.col("attention_count") > 0)))
    order = [F.col("attention_count").desc(), F.col("house_id").asc(), F.col("trace_id").asc()]
    ranked = top_n_per_group(base, ["ds", "city"], order, n, rank_col="rank")
    return ranked.select(*ADS_TOP_HOUSES_COLUMNS)


# Output table name -> (builder, partition column).
DAILY_LOADS = {
    "dws_community_daily": community_daily,
    "dws_house_type_daily": house_type_daily,
    "dws_orientation_daily": orientation_daily,
    "dws_build_year_segment_daily": build_year_segment_daily,
    "ads_city_overview_daily": city_overview_daily,
    "ads_price_range_distribution_daily": price_range_distribution,
    "ads_hot_communities_daily": hot_communities,
    "ads_top10_attention_houses_daily": top_attention_houses,
}


def run_daily(ods: DataFrame, out_root: str, tz: str | None = None,
              blacklist: Sequence[str] = K.CITY_BLACKLIST, since: str | None = None,
              until: str | None = None, concurrency: int = 1) -> dict[str, str]:
    """Run the whole daily warehouse: write DWD, then the eight loads from it.

    ``out_root`` is a folder, or the name of a catalog database whose tables
    are created as declared.  The DWD is written as a ``ds``-partitioned table and read back, which
    cuts the lineage and lets every load prune partitions by ``since/until``.
    Each write replaces only the partitions present in its result.  The
    eight loads only read the DWD, so with ``concurrency > 1`` they are
    submitted as concurrent Spark jobs (threads of the driver), which keeps
    the cluster busy through each job's last stages.
    """
    from concurrent.futures import ThreadPoolExecutor

    from ..sinks.files import is_table, overwrite_partitions, place
    from ..sources.batch import ensure_table
    spark = ods.sparkSession
    into_catalog = is_table(out_root)

    def target(name: str) -> str:
        return f"{out_root}.{name}" if into_catalog else f"{out_root}/{name}"

    if into_catalog:
        for name in ("dwd_ershoufang_fact", *DAILY_LOADS):
            ensure_table(spark, target(name), TABLES[name], ["ds"])
    paths = {"dwd_ershoufang_fact": target("dwd_ershoufang_fact")}
    dwd_new = conform(listing_fact(ods, blacklist, tz, since, until), TABLES["dwd_ershoufang_fact"])
    overwrite_partitions(dwd_new, paths["dwd_ershoufang_fact"], by=place(dwd_new, "ds"))
    dwd = (spark.table(paths["dwd_ershoufang_fact"]) if into_catalog else
           spark.read.schema(dwd_new.schema).parquet(paths["dwd_ershoufang_fact"]))

    def load(item):
        name, build = item
        spark.sparkContext.setJobDescription(f"daily load {name}")
        rows = conform(build(dwd, since=since, until=until), TABLES[name])
        overwrite_partitions(rows, target(name), by="ds")
        return name

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        for name in pool.map(load, DAILY_LOADS.items()):
            paths[name] = target(name)
    return paths
