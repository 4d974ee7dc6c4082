"""Batch sources: click CSV log, catalog/lake tables, static dimensions (SRC-1, 4-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions as X
from ..schemas import CLICK_CSV


def read_click_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Headerless 5-field click log; lines without exactly 5 fields are dropped (SRC-1).

    Read as text and split so that short or long lines are detected (the CSV
    reader would pad or truncate them).
    """
    parts = F.split(F.trim(F.col("value")), sep)
    lines = spark.read.text(path).select(parts.alias("p")).where(F.size("p") == len(CLICK_CSV))
    return lines.select(*[F.col("p")[i].alias(f.name) for i, f in enumerate(CLICK_CSV.fields)])


def normalise_click_log(log: DataFrame, tz: str | None = None) -> DataFrame:
    """Keep plausible epoch seconds and add the readable ``event_time`` (FIL-10, PRJ-12).

    ``tz=None`` renders in the session zone, as the producer did in local time.
    """
    ts = F.col("ts").try_cast("long")
    return (log.where(X.ts_in_range("ts"))
            .select("user_id", "item_id", "category_id", "behavior", ts.alias("ts"),
                    X.epoch_to_string(ts, tz).alias("event_time")))


def read_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """Catalog table (``catalog.db.table``) or a lake folder path (SRC-4)."""
    if "/" in name or "://" in name:
        return spark.read.format(fmt).load(name)
    return spark.table(name)


def load_dimension(df: DataFrame, key: str, value: str, check_unique: bool = True
                   ) -> DataFrame:
    """Static dimension with a string key that must be unique (SRC-5, conflict C7).

    The uniqueness check is one distributed aggregate at load time; nothing
    but the verdict is collected.
    """
    dim = df.select(F.col(key).cast("string").alias(key), F.col(value).cast("string").alias(value))
    if check_unique:
        dup = dim.groupBy(key).count().where(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError(f"dimension key {key!r} is not unique")
    return dim


def register_source(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped temporary table over a source (SRC-7)."""
    df.createOrReplaceTempView(name)
    return df


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: Sequence[str] = (), location: str | None = None,
                 properties: dict | None = None, using: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS .. USING <format> PARTITIONED BY`` (SRC-6, SNK-8).

    ``properties`` become TBLPROPERTIES (e.g. a table format's target file
    size or metadata retention); zstd compression is always set.
    """
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {using}"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        sql += f" LOCATION '{location}'"
    props = {"compression": "zstd", **(properties or {})}
    sql += " TBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in props.items()) + ")"
    spark.sql(sql)
