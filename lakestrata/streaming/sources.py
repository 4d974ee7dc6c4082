"""Streaming sources: click and listing topics (SRC-2, SRC-3, STR-1, STR-9).

``source="kafka"`` reads a topic (needs the Kafka connector jar on the
cluster); ``source="text"`` reads JSON lines from files, one record per
line; ``source="parquet"`` reads a message log, files whose ``value`` column
holds one JSON record per row.  All yield the same message columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators.nested import parse_listing_json
from ..plans.clicks import with_event_time
from ..schemas import CLICK_MESSAGE


ARRIVAL = ("arrival_partition", "arrival_offset", "arrival_time")


def _raw_values(spark: SparkSession, source: str, path: str | None, options: dict | None,
                starting: str, max_files: int | None, max_offsets: int | None) -> DataFrame:
    """Message values with where and when they arrived; ``max_files`` / ``max_offsets`` limit a batch (STR-9)."""
    opts = dict(options or {})
    if source == "kafka":
        reader = spark.readStream.format("kafka").option("startingOffsets", starting)
        if max_offsets:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets)
        return reader.options(**opts).load().select(
            F.col("value").cast("string").alias("value"), F.col("partition").cast("string").alias(ARRIVAL[0]),
            F.col("offset").alias(ARRIVAL[1]), F.col("timestamp").alias(ARRIVAL[2]))
    reader = spark.readStream.format(source).schema("value string").options(**opts)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    position = "row_index" if source == "parquet" else "file_block_start"
    return reader.load(path).select("value", F.col("_metadata.file_name").alias(ARRIVAL[0]),
                                    F.col(f"_metadata.{position}").alias(ARRIVAL[1]),
                                    F.col("_metadata.file_modification_time").alias(ARRIVAL[2]))


def read_click_stream(spark: SparkSession, source: str = "kafka", path: str | None = None,
                      options: dict | None = None, mode: str = "FAILFAST",
                      starting: str = "earliest", max_files: int | None = None,
                      max_offsets: int | None = None) -> DataFrame:
    """Click messages with computed ``ts_ltz``; malformed JSON fails the query
    by default, as the source table declares no ignore option."""
    raw = _raw_values(spark, source, path, options, starting, max_files, max_offsets)
    msgs = raw.select(F.from_json("value", CLICK_MESSAGE, {"mode": mode}).alias("m")).select("m.*")
    return with_event_time(msgs)


def read_listing_stream(spark: SparkSession, source: str = "kafka", path: str | None = None,
                        options: dict | None = None, mode: str = "PERMISSIVE",
                        starting: str = "earliest", max_files: int | None = None,
                        max_offsets: int | None = None, arrival: bool = False) -> DataFrame:
    """Nested listing messages; bad fields become NULL, broken records a NULL
    struct (dropped by the ``house_id`` filter of ``flatten_listing``).

    With ``arrival`` the topic partition, offset and time (of a file: its name, position and modification time)
    are kept, so that an upsert can be ordered by arrival instead of by event time."""
    raw = _raw_values(spark, source, path, options, starting, max_files, max_offsets)
    return parse_listing_json(raw if arrival else raw.select("value"), "value", mode)


def with_event_watermark(df: DataFrame, delay: str = K.WATERMARK_DELAY,
                         col: str = "ts_ltz") -> DataFrame:
    """``WATERMARK FOR ts_ltz AS ts_ltz - delay`` on the source, before any filter,
    so rows that are filtered out later still advance event time (STR-1)."""
    return df.withWatermark(col, delay)
