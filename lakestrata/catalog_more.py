"""Registry entries for data quality, sinks and streaming.

Stream entries run the real ``readStream`` query with an ``availableNow``
trigger over JSON files that Spark derives from the driver tables, into a
fresh folder under the shared checkpoint root, and return what the sink
wrote.  Sink entries write, rewrite and read back a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fixtures
from .operators import quality
from .operators.aggregate import latest_per_key
from .operators.nested import flatten_listing, to_listing_message
from .plans import clicks, listings
from .schemas import ODS_KEYS
from .session import scratch_path, write_staged
from .sinks.compaction import compact
from .sinks.files import overwrite_partitions
from .streaming import jobs
from .streaming.sinks import append_stream, first_per_key_stream, read_upserted, upsert_stream
from .streaming.sources import read_click_stream, read_listing_stream

AVAILABLE_NOW = {"availableNow": True}
ORDER = ["event_time", "trace_id"]
# What tells rows of one event apart; anything left is the library's hash of the row.
LATEST = ORDER + ["total_price", "area_sqm"]


def _catalog():
    from . import catalog
    return catalog


def read_back(spark, path: str, like: DataFrame) -> DataFrame:
    """Read a written folder with the schema it was written with (no inference)."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


_TOPICS: dict = {}


# ------------------------------------------------------------ data quality --

def defective_listing(spark, sf, bad_counts: bool = False) -> DataFrame:
    """Listing rows with contract defects derived from the keys; ``bad_counts`` also makes some
    room counts text that is no number (then the column is a string)."""
    key = (spark.sparkContext.applicationId, sf, "defective", bad_counts)
    if key not in _TOPICS:  # scraped rows arrive as a written table
        _TOPICS[key] = write_staged(defects(fixtures.listing(spark, sf), bad_counts), "scraped-listings")
    return _TOPICS[key]


def defects(src: DataFrame, bad_counts: bool = False) -> DataFrame:
    hid, up = F.col("house_id"), F.col("unit_price")
    return (src
            .withColumn("community", F.when(hid.endswith("-6") & (up % 3 == 0), F.lit(None))
                        .otherwise(F.col("community")))
            .withColumn("house_url", F.when(hid.endswith("-7") & (up % 2 == 0), F.lit(" "))
                        .otherwise(F.col("house_url")))
            .withColumn("total_price", F.when(hid.endswith("-1") & (up % 7 == 0), F.lit(None))
                        .otherwise(F.col("total_price")))
            .withColumn("source", F.when(hid.endswith("-5") & (up % 5 == 0), F.lit(None))
                        .otherwise(F.col("source")))
            .withColumn("room_num", F.when(hid.endswith("-4") & (up % 4 == 0), F.lit("n/a"))
                        .otherwise(F.col("room_num").cast("string")) if bad_counts else F.col("room_num")))


def q_validate_valid(spark, sf):
    valid, _ = quality.validate(defective_listing(spark, sf, True))
    return valid.select("trace_id", "house_id", "city", "community", "house_url", "total_price")


def q_validate_rejected(spark, sf):
    _, rejected = quality.validate(defective_listing(spark, sf, True))
    return rejected.select("trace_id", "house_id", "reasons")


def first_seen(spark, sf) -> DataFrame:
    """First valid message per house.  The columns are cut before the pick: messages that tie in ``ORDER``
    agree in them, so no wider row has to be sorted or moved to tell them apart."""
    valid, _ = quality.validate(defective_listing(spark, sf, True))
    return quality.dedupe_first(valid.select("house_id", *ORDER), "house_id", ORDER, total_order=False)


def q_dedupe_first_seen(spark, sf):
    return first_seen(spark, sf).select("house_id", "trace_id", "event_time")


def q_skip_delivered(spark, sf):
    delivered = fixtures.listing(spark, sf).where(F.col("house_id").endswith("-1"))
    return quality.anti_delivered(first_seen(spark, sf), delivered, "house_id").select(
        "house_id", "trace_id")


def q_upsert_latest_per_key(spark, sf):
    return latest_per_key(_catalog().ods(spark, sf), list(ODS_KEYS), LATEST, few=True)


# ------------------------------------------------------------------- sinks --

def q_sink_dynamic_overwrite(spark, sf):
    """Load all days, then re-load days >= 20240104 from corrected input:
    only those partitions are replaced, earlier days stay as written."""
    dwd = _catalog().dwd_table(spark, sf)
    path = scratch_path(spark, "dws_house_type_daily")
    first = listings.house_type_daily(dwd)
    overwrite_partitions(first, path, by="ds")
    fixed = listings.house_type_daily(dwd.where(F.col("attention_count") > 0),
                                      since="20240104")
    overwrite_partitions(fixed, path, by="ds")
    return read_back(spark, path, first)


def q_compact_roundtrip(spark, sf):
    """Write the click ODS as many small files per day, compact, read back."""
    ods = clicks.click_ods(_catalog().click_src(spark, sf))
    path = scratch_path(spark, "ods_user_behavior")
    ods.repartition(16).write.partitionBy("dt").parquet(path)
    compact(spark, path, "dt")
    return read_back(spark, path, ods)


# --------------------------------------------------------------- streaming --

def _topic(spark, sf, name: str, build, stage=fixtures.stage_json) -> str:
    """Folder of JSON messages ("topic") written by Spark from the driver tables, once
    per application and scale directory (a topic outlives its consumers;
    every stream query still reads it from the start with a fresh checkpoint)."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _TOPICS:
        _TOPICS[key] = stage(build(), scratch_path(spark, name))
    return _TOPICS[key]


def _click_stream(spark, sf):
    staged = _topic(spark, sf, "click-topic",
                    lambda: clicks.click_messages(fixtures.click(spark, sf)))
    return read_click_stream(spark, source="text", path=staged)


def _run(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _stream_click_layer(spark, sf, layer: str):
    """Run the one-read fan-out (SNK-5) and read back one of its two layers."""
    out, ck = scratch_path(spark, "click-layers"), scratch_path(spark, "ckpt")
    fn = {"ods": clicks.click_ods, "dwd": clicks.click_dwd}
    paths = {name: f"{out}/{name}_user_behavior" for name in fn}
    _run(jobs.batch_fanout(_click_stream(spark, sf), {paths[n]: fn[n] for n in fn},
                           partition_by=["dt"], checkpoint=ck, trigger=AVAILABLE_NOW))
    like = fn[layer](_catalog().click_src(spark, sf))
    return read_back(spark, paths[layer], like)


def q_stream_click_ods(spark, sf):
    return _stream_click_layer(spark, sf, "ods")


def q_stream_click_dwd(spark, sf):
    return _stream_click_layer(spark, sf, "dwd")


def q_stream_category_metrics(spark, sf):
    out, ck = scratch_path(spark, "dws_category_metrics"), scratch_path(spark, "ckpt")
    _run(jobs.category_metrics_stream(_click_stream(spark, sf), out, ck, AVAILABLE_NOW))
    like = clicks.category_window_metrics(_catalog().click_src(spark, sf))
    return read_back(spark, out, like)


def q_stream_behavior_funnel(spark, sf):
    out, ck = scratch_path(spark, "dws_behavior_funnel"), scratch_path(spark, "ckpt")
    _run(jobs.behavior_funnel_stream(_click_stream(spark, sf), out, ck, AVAILABLE_NOW))
    like = clicks.behavior_funnel_windows(_catalog().click_src(spark, sf))
    return read_back(spark, out, like)


def _listing_stream(spark, sf, files: int | None = None):
    staged = _topic(spark, sf, f"listing-topic-{bool(files)}",
                    lambda: to_listing_message(fixtures.listing(spark, sf)), fixtures.stage_log)
    return read_listing_stream(spark, source="parquet", path=staged, max_files=files)


def q_stream_dedupe_first(spark, sf):
    """The first message per house by event time, as a stream delivers it."""
    flat = flatten_listing(_listing_stream(spark, sf), with_etl_time=False)
    seen = scratch_path(spark, "no-houses")
    flat_ids = spark.createDataFrame([], "house_id string")
    flat_ids.write.parquet(seen)
    out, ck = scratch_path(spark, "listing_first_seen"), scratch_path(spark, "ckpt")
    first = first_per_key_stream(flat, "house_id", ORDER, spark.readStream.schema(flat_ids.schema).parquet(seen))
    _run(append_stream(first, out, ck, trigger=AVAILABLE_NOW, sorts=True))
    return read_back(spark, out, flat).select("house_id", "trace_id", "event_time")


def q_stream_upsert_latest(spark, sf):
    """Micro-batches of up to four topic files upserted on (house_id, city)."""
    flat = flatten_listing(_listing_stream(spark, sf, files=4), with_etl_time=False)
    out, ck = scratch_path(spark, "ods_ershoufang"), scratch_path(spark, "ckpt")
    _run(upsert_stream(flat, out, list(ODS_KEYS), LATEST, ck, ("city",), AVAILABLE_NOW))
    return read_upserted(spark, out, list(ODS_KEYS), LATEST, flat.schema)


QUERIES = {
    "validate_valid": q_validate_valid,
    "validate_rejected": q_validate_rejected,
    "dedupe_first_seen": q_dedupe_first_seen,
    "skip_delivered": q_skip_delivered,
    "upsert_latest_per_key": q_upsert_latest_per_key,
    "sink_dynamic_overwrite": q_sink_dynamic_overwrite,
    "compact_roundtrip": q_compact_roundtrip,
    "stream_click_ods": q_stream_click_ods,
    "stream_click_dwd": q_stream_click_dwd,
    "stream_category_metrics": q_stream_category_metrics,
    "stream_behavior_funnel": q_stream_behavior_funnel,
    "stream_dedupe_first": q_stream_dedupe_first,
    "stream_upsert_latest": q_stream_upsert_latest,
}
