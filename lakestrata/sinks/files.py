"""Batch sinks: dynamic partition overwrite, event publishing (SNK-*); ``compaction`` merges small files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_dropped

OPEN_FILES = 8


class InPlace(list):
    """Partition columns of rows that are written by the tasks that have them (no ``clustered``)."""


def place(df: DataFrame, by: Sequence[str] | str) -> list[str]:
    """Partition columns for a write of wide rows: ``InPlace`` if they lie in so few partitions that a task can write
    to all of them at once.

    Bringing wide rows together by partition first shuffles every one of them, most of what a load moves.  A pass
    over the partition columns alone counts the partitions; rows of more than ``OPEN_FILES`` (a long history) are
    still brought together, since in place they would be sorted and leave a small file per task and partition."""
    spark, cols = df.sparkSession, _columns(by)
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":  # tasks are many and small
        return cols
    with shuffles_dropped(spark):
        few = df.select(*cols).distinct().limit(OPEN_FILES + 1).count() <= OPEN_FILES
    return InPlace(cols) if few else cols


def _columns(by: Sequence[str] | str | None) -> list[str]:
    return [by] if isinstance(by, str) else list(by or ())


def write_unsorted(spark) -> None:
    """Let a task write to up to ``OPEN_FILES`` partitions at once, as a setting of the session (unless it has one).

    Without it Spark sorts every task's rows by partition before a partitioned write.  Rows that were brought together
    lie in one or a few partitions, and the sort holds, or spills, whole wide rows to change nothing.  A
    task that meets more partitions sorts what is left, as before."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    if int(spark.conf.get(key, "0")) == 0:
        spark.conf.set(key, str(OPEN_FILES))


def _writer(df: DataFrame, by: Sequence[str] | str | None, max_records: int | None = None):
    w = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd"))
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    if by:
        w = w.partitionBy(*_columns(by))
    return w


def overwrite_partitions(df: DataFrame, target: str, by: Sequence[str] | str | None = "ds",
                         columns: Sequence[str] | None = None,
                         max_records: int | None = None) -> None:
    """``INSERT OVERWRITE .. PARTITION (by)`` with dynamic overwrite (SNK-1/2/9).

    Only partitions present in ``df`` are replaced.  Columns are matched by
    *name* (the partition column may come first in ``df``).  ``target`` is a
    path, or a catalog table name when it contains no ``/``.  Columns given as
    ``InPlace`` leave rows in the tasks that have them.
    """
    write_unsorted(df.sparkSession)
    if columns is not None:
        df = df.select(*columns)
    if is_table(target):
        df = clustered(df.select(*df.sparkSession.table(target).columns), by)
        with shuffles_dropped(df.sparkSession):
            df.write.option("partitionOverwriteMode", "dynamic").insertInto(target, overwrite=True)
        return
    with shuffles_dropped(df.sparkSession):
        _writer(clustered(df, by), by, max_records).parquet(target)


def is_table(target: str) -> bool:
    """A catalog name (``table``, ``db.table``, ``catalog.db.table``) rather than a folder."""
    return re.fullmatch(r"\w+(\.\w+){0,2}", target) is not None


def clustered(df: DataFrame, by: Sequence[str] | str | None) -> DataFrame:
    """Rows of a table partition brought together before the write (``REBALANCE``): one file per
    partition up to the advisory size, and a large partition split over several tasks.  Without
    adaptive execution, and in streams, rows are written where they are."""
    cols = _columns(by)
    return df.hint("rebalance", *cols) if cols and not df.isStreaming and not isinstance(by, InPlace) else df


def data_files(spark, path: str) -> DataFrame:
    """One row per Parquet data file under ``path`` (``path``, ``length`` and the
    partition columns), from the file listing: the ``binaryFile`` source does
    not read file contents unless ``content`` is selected, so this is
    O(files), not O(rows)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
            .drop("content", "modificationTime"))


def location(spark, table: str) -> str:
    """Folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type").take(1)
    if not rows:
        raise ValueError(f"{table} has no folder of its own")
    return rows[0][0]


def file_count(spark, path: str) -> int:
    """Number of Parquet data files under ``path`` (from the listing)."""
    return data_files(spark, path).count()


def to_message(df: DataFrame, key: str | None = None, columns: Sequence[str] | None = None
               ) -> DataFrame:
    """Record -> JSON ``value`` (+ ``key``) as for a message topic (PRJ-13)."""
    cols = list(columns or df.columns)
    value = F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def topic_messages(df: DataFrame, key: str = "user_id", order_by: Sequence[str] | str | None = "ts",
                   partitions: int = 2) -> DataFrame:
    """Messages (``partition``, ``key``, ``value``) laid out for a keyed topic (SNK-10).

    A key belongs to one topic partition, and a topic partition is written by one task in the
    order of its rows, so a consumer sees every key in order.  The number of partitions bounds the
    writers, as it bounds the readers of a topic; a hot key fills one partition, which order per key demands.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by or ())
    spot = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(partitions)).cast("int")
    laid = df.withColumn("__spot", spot).repartitionById(partitions, F.col("__spot")).sortWithinPartitions("__spot", key, *order)
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")
    return laid.select(F.col("__spot").alias("partition"), F.col(key).cast("string").alias("key"), value)


def publish_events(df: DataFrame, key: str = "user_id", fmt: str = "json",
                   path: str | None = None, order_col: str | None = "ts",
                   options: dict | None = None, partitions: int = 2) -> None:
    """Publish records keyed by ``key`` so per-key order holds (SNK-10).

    ``fmt="kafka"`` writes partition, key and value to a topic of ``partitions``
    partitions (needs the connector jar; a retried task sends its part again, in order).  Otherwise
    the same messages become text files, one folder ``partition=<n>`` per topic partition with
    one ordered file.
    """
    out = topic_messages(df, key, order_col, partitions)
    if fmt == "kafka":
        out.write.format("kafka").options(**(options or {})).save()
        return
    out.select("partition", "value").write.mode("overwrite").partitionBy("partition").text(path)


__all__ = ["overwrite_partitions", "data_files", "file_count", "location", "topic_messages", "to_message", "publish_events"]
