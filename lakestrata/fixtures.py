"""Driver tables -> the shapes the pipelines consume.

The mapping SQL is written once in a dialect both Spark and DuckDB accept and
is used twice: by Spark (table names bound to the Parquet files) and as a CTE
prefix of the DuckDB oracle (table names bound to its pre-registered views).
Only the order of the listing's joins is Spark's own (``LISTING_SPARK_SQL``).

The BROADCAST hint names only ``nation`` and ``region``: their size is fixed
(25 and 5 rows) whatever the scale factor, so broadcasting them is bounded.
Every other join is left to the planner and AQE.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import shuffles_dropped
from .sinks.files import write_unsorted

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Listing message fields (flat).  Extra columns beyond the driver mapping are
# pure functions of the keys so both engines agree.
LISTING_COLUMNS = """
SELECT /*+ BROADCAST(nation, region) */
 'feed-' || CAST(l_suppkey % 3 AS STRING) AS source,
 1704067200 + (l_orderkey % 5) * 86400 AS event_time,
 '1.1' AS version,
 CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS trace_id,
 'b' || CAST(l_orderkey % 5 AS STRING) AS batch_id,
 CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS house_id,
 '/house/' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS house_url,
 p_name AS title,
 r_name AS city,
 CASE WHEN n_nationkey % 7 = 0 THEN 'TODO_MAPPING' ELSE n_name END AS district,
 c_mktsegment AS neighborhood, p_brand AS community,
 l_extendedprice / 100 AS total_price,
 CAST(ROUND(p_retailprice * 10) AS INT) AS unit_price,
 l_quantity * 4 AS area_sqm,
 CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size % 5 END AS room_num,
 l_linenumber % 3 AS hall_num, l_linenumber % 2 AS bathroom_num,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS orientation,
 CASE p_size % 4 WHEN 0 THEN '低楼层' WHEN 1 THEN '中楼层' WHEN 2 THEN '高楼层' ELSE '未知' END AS floor_level,
 p_size AS floor_total,
 CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_type END AS decoration,
 CASE WHEN p_size % 11 = 0 THEN NULL ELSE 1980 + p_size END AS build_year,
 split(p_name, ' ') AS tags,
 CAST(ROUND(l_discount * 100) AS INT) AS attention_count,
 CASE WHEN l_linenumber = 6 THEN NULL ELSE CAST(ROUND(l_tax * 100) AS INT) END AS visit_30_days,
 CASE WHEN l_linenumber % 2 = 0 THEN 'line-' || CAST(l_suppkey % 10 AS STRING) END AS subway_info,
 p_type AS p1_desc,
 CASE l_linenumber % 3 WHEN 0 THEN '五环至六环 近地铁' WHEN 1 THEN '三环内' ELSE '城郊' END AS p2_desc
"""

LISTING_SQL = LISTING_COLUMNS + """FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} nation ON c_nationkey = n_nationkey JOIN {region} region ON n_regionkey = r_regionkey
JOIN {part} ON l_partkey = p_partkey
"""

# The same joins in the order that moves least: only orders, which are narrow and few, are dealt out by
# customer; lines are dealt out twice (order, part) instead of three times, names are looked up last.
LISTING_SPARK_SQL = LISTING_COLUMNS + """FROM {lineitem}
JOIN (SELECT o_orderkey, c_nationkey, c_mktsegment FROM {orders} JOIN {customer} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
JOIN {part} ON l_partkey = p_partkey
JOIN {nation} nation ON c_nationkey = n_nationkey JOIN {region} region ON n_regionkey = r_regionkey
"""

# Click events (ts_ltz keeps the driver's microsecond wall clock).
CLICK_SQL = """
SELECT event_id, CAST(user_id AS STRING) AS user_id, CAST(event_id % 500 AS STRING) AS item_id,
 CAST(event_id % 40 AS STRING) AS category_id,
 CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav' WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'buy'
  ELSE CASE WHEN event_id % 2 = 0 THEN 'unknown' END END AS behavior, ts AS ts_ltz FROM {events}
"""

# Category dimension: the whole part table, many ids to one brand name.
DIM_SQL = """
SELECT CAST(p_partkey AS STRING) AS category_id, p_brand AS category_name FROM {part}
"""


def _spark_refs(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> dict:
    """Bind the SQL placeholders to DataFrames (``spark.sql(text, **frames)``)."""
    return {t: table(spark, sf_dir, t) for t in names}


def _oracle_refs() -> dict[str, str]:
    return {t: t for t in TABLES}


def _path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, name))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat listing messages (one row per lineitem)."""
    return spark.sql(LISTING_SPARK_SQL, **_spark_refs(
        spark, sf_dir, ("lineitem", "orders", "customer", "nation", "region", "part")))


def click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events with wall-clock ``ts_ltz`` (TIMESTAMP_NTZ)."""
    return spark.sql(CLICK_SQL, **_spark_refs(spark, sf_dir, ("events",)))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DIM_SQL, **_spark_refs(spark, sf_dir, ("part",)))


def oracle_views() -> dict[str, str]:
    """The same mappings as DuckDB CTE bodies."""
    refs = _oracle_refs()
    return {"listing": LISTING_SQL.format(**refs), "click": CLICK_SQL.format(**refs),
            "dim": DIM_SQL.format(**refs)}


# Rows of a topic file.  A compressed text file is read by one task, so its size is bounded.
TOPIC_FILE_ROWS = 500_000
# Rows of a file of a message log, and bytes of its row groups, by which a file is read by many tasks.
LOG_FILE_ROWS, LOG_BLOCK = 2_000_000, 8 << 20


def stage_json(df: DataFrame, path: str) -> str:
    """A file-fed topic: rows as JSON lines, one message per line, in compressed files of bounded length
    (every message repeats its field names: as plain text a topic is many times the size of its tables)."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")
    with shuffles_dropped(df.sparkSession):
        (df.select(value).write.mode("overwrite").option("compression", "gzip")
         .option("maxRecordsPerFile", TOPIC_FILE_ROWS).text(path))
    return path


def stage_log(df: DataFrame, path: str, part: Column | None = None) -> str:
    """A file-fed topic as a log: JSON messages in the ``value`` column of Parquet files (``read_listing_stream``,
    ``source="parquet"``), which are compressed as a broker compresses its batches and can be read by many tasks each.

    ``part`` deals the messages out to one topic each, the folder ``part=<value>`` below ``path``, in one pass."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")
    rows = df.select(value) if part is None else df.select(value, part.alias("part")).where("part IS NOT NULL")
    write_unsorted(df.sparkSession)
    w = (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
         .option("parquet.enable.dictionary", "false").option("parquet.block.size", str(LOG_BLOCK))
         .option("maxRecordsPerFile", LOG_FILE_ROWS))
    with shuffles_dropped(df.sparkSession):
        (w if part is None else w.partitionBy("part")).parquet(path)
    return path
