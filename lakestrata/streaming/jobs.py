"""End-to-end streaming pipelines (SNK-5, STR-1..9).

``run_click_pipeline``: one source -> ODS + DWD (one ``foreachBatch``, one
read) + two windowed aggregates (append, emitted once per closed window),
into folders or the tables of a catalog database.
``run_listing_pipeline``: nested JSON -> flatten -> contract validation ->
keyed upsert into the ODS change log by city; rejected rows to their own table.
``listing_ingest_stream``: the producer side of the listings.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import constants as K
from ..operators.nested import flatten_listing
from ..operators.quality import with_reasons
from ..plans import clicks
from ..schemas import ODS_KEYS
from ..sinks.files import InPlace, is_table
from .sinks import (append_stream, batch_fanout, each_batch, first_per_key_stream, load_name, upsert_batch,
                    write_load)
from .sources import with_event_watermark


def target_name(root: str, name: str) -> str:
    """A table of the catalog database ``root``, or a folder below the folder ``root``."""
    return f"{root}.{name}" if is_table(root) else os.path.join(root, name)


def category_metrics_stream(src: DataFrame, path: str, checkpoint: str,
                            trigger: dict | None = None, window: str = K.WINDOW_SIZE,
                            delay: str = K.WATERMARK_DELAY) -> StreamingQuery:
    """10-minute category metrics, appended once each window closes (WH-11)."""
    agg = clicks.category_window_metrics(with_event_watermark(src, delay), window)
    return append_stream(agg, path, checkpoint, trigger=trigger)


def behavior_funnel_stream(src: DataFrame, path: str, checkpoint: str,
                           trigger: dict | None = None, window: str = K.WINDOW_SIZE,
                           delay: str = K.WATERMARK_DELAY) -> StreamingQuery:
    """10-minute behaviour funnel, appended once each window closes (WH-12)."""
    agg = clicks.behavior_funnel_windows(with_event_watermark(src, delay), window)
    return append_stream(agg, path, checkpoint, trigger=trigger)


def run_click_pipeline(src: DataFrame, out_root: str, checkpoint_root: str,
                       trigger: dict | None = None) -> list[StreamingQuery]:
    """Start the four sinks of the click statement set; returns the queries.

    ``out_root`` is a folder, or the name of a catalog database whose tables are
    created on first use.  ODS and DWD share one read of the source through
    ``batch_fanout``; the two aggregates are stateful and run as their own append queries.
    """
    fan = batch_fanout(
        src, {target_name(out_root, "ods_user_behavior"): clicks.click_ods,
              target_name(out_root, "dwd_user_behavior"): clicks.click_dwd},
        partition_by=["dt"], checkpoint=os.path.join(checkpoint_root, "click_layers"),
        trigger=trigger)
    cat = category_metrics_stream(src, target_name(out_root, "dws_category_metrics"),
                                  os.path.join(checkpoint_root, "category_metrics"), trigger)
    fun = behavior_funnel_stream(src, target_name(out_root, "dws_behavior_funnel"),
                                 os.path.join(checkpoint_root, "behavior_funnel"), trigger)
    return [fan, cat, fun]


def _seen_keys(spark, topic: str, delivered: DataFrame | None, checkpoint: str) -> DataFrame:
    """Stream of the houses delivered before a query's first start (by earlier runs, or as ``delivered``).

    They are written below the checkpoint once, so a restarted query reads the same files again (that is, none)."""
    path = os.path.join(checkpoint, "seen")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
        keys = spark.createDataFrame([], "house_id string") if delivered is None else delivered.select("house_id")
        before = spark._jvm.org.apache.hadoop.fs.Path(topic)
        if before.getFileSystem(spark._jsc.hadoopConfiguration()).exists(before):
            keys = keys.unionByName(spark.read.schema("house_id string").parquet(topic).select("house_id"))
        keys.where("house_id IS NOT NULL").distinct().write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(path)
    return spark.readStream.schema("house_id string").parquet(path)


def listing_ingest_stream(nested: DataFrame, topic: str, rejects: str, checkpoint: str,
                          delivered: DataFrame | None = None, trigger: dict | None = None) -> list[StreamingQuery]:
    """Producer side of the listings: validate, keep the first message per house, skip houses delivered
    before (by an earlier run, an earlier batch or as ``delivered``), deliver; rejects go to their own
    table with their reasons (DQ-1..3, STR-8).

    Delivered houses are keys in the state store, so a batch reads its messages and looks up their
    houses, however many were delivered.  Two queries on the same source: deliveries and rejects.
    """
    tagged = with_reasons(flatten_listing(nested, with_etl_time=False))
    seen = _seen_keys(nested.sparkSession, topic, delivered, os.path.join(checkpoint, "deliveries"))
    first = first_per_key_stream(tagged, "house_id", ["event_time", "trace_id"], seen, unless="reasons")
    return [append_stream(first, topic, os.path.join(checkpoint, "deliveries"), trigger=trigger, sorts=True),
            reject_stream(tagged, rejects, os.path.join(checkpoint, "rejects"), trigger)]


def reject_stream(tagged: DataFrame, rejects: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the rows that failed a rule, with their reasons (DQ-1).

    They are few and written by the tasks that read them: a load has at most one file per task, which compaction merges."""
    def run(batch, batch_id):
        write_load(batch.where(F.size("reasons") > 0), rejects, load_name(batch, batch_id), columns=InPlace)
    return each_batch(tagged, run, checkpoint, trigger)


def run_listing_pipeline(nested: DataFrame, target: str, checkpoint: str, trigger: dict | None = None,
                         rejects: str | None = None) -> StreamingQuery:
    """Listing stream -> ODS, last write per (house_id, city) wins; rejected rows are appended to ``rejects``
    (DQ-1), from the same read."""
    def run(batch, batch_id):
        batch = batch.persist()
        try:
            upsert_batch(batch.where(F.size("reasons") == 0).drop("reasons"), batch_id, target, list(ODS_KEYS),
                         ["event_time", "trace_id"], ["city"])
            if rejects:
                write_load(batch.where(F.size("reasons") > 0), rejects, load_name(batch, batch_id))
        finally:
            batch.unpersist()
    return each_batch(with_reasons(flatten_listing(nested)), run, checkpoint, trigger)
