"""Registry entries for sources, catalog tables, typed schemas and sink edge cases.

Every entry writes what Spark derives from the driver tables through the real
source or sink and returns what a reader finds afterwards.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import catalog_more as more
from . import fixtures
from .operators.nested import flatten_listing, to_listing_message
from .plans import clicks, listings
from .schemas import CLICK_CSV, ODS_KEYS, TABLES, conform
from .session import scratch_path, write_staged
from .sinks.compaction import compact
from .sinks.files import overwrite_partitions, publish_events
from .sources.batch import ensure_table, read_click_csv, read_table, register_source
from .streaming import jobs
from .streaming.sinks import append_stream, batch_fanout, read_upserted, upsert_batch
from .streaming.sources import read_click_stream


def _catalog():
    from . import catalog
    return catalog


def _database(spark, name: str) -> str:
    db = f"{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    return db


def q_click_csv_scan(spark, sf):
    """CSV click log with short and long lines in between: only five-field lines are read."""
    msg = clicks.click_messages(fixtures.click(spark, sf))
    cols = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in CLICK_CSV.fields]
    line = F.concat_ws(",", *cols)
    line = F.when(F.col("ts") % 7 == 0, F.concat(line, F.lit(",extra"))).when(
        F.col("ts") % 7 == 1, F.regexp_replace(line, ",[^,]*$", "")).otherwise(line)
    path = scratch_path(spark, "click-log")
    msg.select(line.alias("value")).write.text(path)
    return read_click_csv(spark, path)


def q_catalog_roundtrip(spark, sf):
    """Typed catalog table, created if absent (twice), loaded by name, read by name."""
    db = _database(spark, "ls_roundtrip")
    table = f"{db}.dws_orientation_daily"
    for _ in range(2):
        ensure_table(spark, table, TABLES["dws_orientation_daily"], ["ds"])
    rows = _catalog().RAW["orientation_daily"](spark, sf)
    overwrite_partitions(conform(rows, TABLES["dws_orientation_daily"]), table)
    return read_table(spark, table).select(*rows.columns)


def q_insert_by_name(spark, sf):
    """Columns in another order than the table's are matched by name."""
    db = _database(spark, "ls_by_name")
    table = f"{db}.dws_build_year_segment_daily"
    ensure_table(spark, table, TABLES["dws_build_year_segment_daily"], ["ds"])
    rows = _catalog().RAW["build_year_segment_daily"](spark, sf)
    overwrite_partitions(rows.select(*reversed(rows.columns)), table)
    return spark.table(table).select(*rows.columns)


def q_daily_to_catalog(spark, sf):
    """The daily warehouse with a catalog database as its root; returns the top-houses table."""
    db = _database(spark, "ls_daily")
    made = listings.run_daily(_catalog().ods(spark, sf), db, tz="UTC", blacklist=_catalog().TEST_BLACKLIST)
    return read_table(spark, made["ads_top10_attention_houses_daily"]).select(
        *TABLES["ads_top10_attention_houses_daily"].fieldNames())


def _typed_tables(spark, sf) -> dict:
    cat, dwd, src = _catalog(), _catalog().dwd_table(spark, sf), _catalog().click_src(spark, sf)
    made = {name: build(dwd) for name, build in listings.DAILY_LOADS.items()}
    return made | {
        "ods_ershoufang": flatten_listing(to_listing_message(cat.listing(spark, sf))), "dwd_ershoufang_fact": dwd,
        "ods_user_behavior": clicks.click_ods(src), "dwd_user_behavior": clicks.click_dwd(src),
        "dws_category_metrics": clicks.category_window_metrics(src),
        "dws_behavior_funnel": clicks.behavior_funnel_windows(src)}


def q_table_schemas(spark, sf):
    """Column types of every table as written: one row per column, with the rows that hold a value."""
    out = None
    for name, rows in sorted(_typed_tables(spark, sf).items()):
        path = scratch_path(spark, f"typed-{name}")
        conform(rows, TABLES[name]).write.parquet(path)
        back = spark.read.parquet(path)
        # one pass keeps one flag per column; only the row of flags is exploded (a table without rows has none)
        flags = back.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.col(f"`{f.name}`").isNotNull()).alias(f"v{i}")
                                                         for i, f in enumerate(back.schema.fields)]).where("n > 0")
        types = flags.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f.name).alias("c"), F.lit(
            f.dataType.simpleString()).alias("t"), F.col(f"v{i}").alias("filled")) for i, f in enumerate(back.schema.fields)])))
        types = types.select(F.lit(name).alias("table_name"), F.col("i").alias("position"), F.col("c").alias("column_name"),
                             F.col("t").alias("type"), "filled")
        out = types if out is None else out.unionByName(types)
    return out


def q_append_by_dt(spark, sf):
    """Append-mode stream into a table partitioned by day."""
    src = more._click_stream(spark, sf)
    out, ck = scratch_path(spark, "append-by-dt"), scratch_path(spark, "ckpt")
    more._run(append_stream(clicks.click_ods(src), out, ck, "dt", more.AVAILABLE_NOW))
    return more.read_back(spark, out, clicks.click_ods(_catalog().click_src(spark, sf)))


def _two_part_topic(spark, sf):
    """The click topic in two deliveries, split by user."""
    msg, path = clicks.click_messages(fixtures.click(spark, sf)), scratch_path(spark, "click-parts")
    value = F.to_json(F.struct(*msg.columns)).alias("value")
    first = F.pmod(F.xxhash64("user_id"), F.lit(2)) == 0

    def deliver(part: int) -> None:
        msg.where(first if part == 0 else ~first).select(value).write.mode("append").text(path)
    return path, deliver


def q_stream_restart(spark, sf):
    """A stopped stream restarted on its checkpoint reads only what arrived since."""
    path, deliver = _two_part_topic(spark, sf)
    out, ck = scratch_path(spark, "restart"), scratch_path(spark, "ckpt")
    for part in (0, 1):
        deliver(part)
        src = read_click_stream(spark, source="text", path=path)
        more._run(append_stream(clicks.click_dwd(src), out, ck, "dt", more.AVAILABLE_NOW))
    return more.read_back(spark, out, clicks.click_dwd(_catalog().click_src(spark, sf)))


def q_stream_compact_stream(spark, sf):
    """Fan-out stream, compaction of its table by day, then the stream goes on writing to it."""
    path, deliver = _two_part_topic(spark, sf)
    out, ck = scratch_path(spark, "fanout-compact"), scratch_path(spark, "ckpt")
    for part in (0, 1):
        deliver(part)
        src = read_click_stream(spark, source="text", path=path, max_files=1)
        more._run(batch_fanout(src, {out: clicks.click_ods}, ["dt"], ck, more.AVAILABLE_NOW))
        compact(spark, out, "dt")
    return more.read_back(spark, out, clicks.click_ods(_catalog().click_src(spark, sf)))


def q_upsert_null_partition(spark, sf):
    """Two batches into a table partitioned by a column with nulls: nothing of the null partition is lost."""
    ods = _catalog().ods(spark, sf).withColumn(
        "city", F.when(F.col("house_id").endswith("-2"), F.lit(None)).otherwise(F.col("city")))
    path = scratch_path(spark, "upsert-null")
    half = F.pmod(F.xxhash64("house_id"), F.lit(2)) == 0
    for i, part in enumerate((half, ~half)):
        upsert_batch(ods.where(part), i, path, list(ODS_KEYS), more.ORDER, ["city"])
    # rows that tie in the order agree in the columns that are returned
    return read_upserted(spark, path, list(ODS_KEYS), more.ORDER, ods.schema, total_order=False).select("house_id", "trace_id", "city")


def q_compact_string_partition(spark, sf):
    """Numeric-looking and null string partitions keep their folders through a compaction."""
    rows = fixtures.click(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("00"), F.col("category_id"))).alias("code"))
    path = scratch_path(spark, "compact-strings")
    rows.repartition(8).write.partitionBy("code").parquet(path)
    compact(spark, path, "code")
    return spark.read.schema("event_id long, code string").parquet(path)


def q_compact_map_table(spark, sf):
    """A table with a MAP column is compacted like any other."""
    rows = _catalog().RAW["community_daily"](spark, sf)
    path = scratch_path(spark, "compact-maps")
    rows.repartition(8).write.partitionBy("ds").parquet(path)
    compact(spark, path, "ds")
    return more.read_back(spark, path, rows)


def _ingest(spark, sf, parts: int = 1):
    """Defective listings through the ingest, in ``parts`` deliveries of which each starts on a fresh checkpoint."""
    # every message is made and published once, to the topic of its delivery
    rows = to_listing_message(more.defects(fixtures.listing(spark, sf)).where((F.col("unit_price") % parts).between(0, parts - 1)))
    out, topics = scratch_path(spark, "ingest"), scratch_path(spark, "raw-listings")
    fixtures.stage_log(rows, topics, F.col("core_data.unit_price") % parts)
    delivered = fixtures.listing(spark, sf).where(F.col("house_id").endswith("-2")).select("house_id")
    for part in range(parts):
        stream = more.read_listing_stream(spark, source="parquet", path=f"{topics}/part={part}")
        for query in jobs.listing_ingest_stream(stream, f"{out}/topic", f"{out}/rejects", scratch_path(spark, "ckpt"),
                                                delivered, more.AVAILABLE_NOW):
            more._run(query)
    return out


def q_stream_listing_ingest(spark, sf):
    """Messages that pass the contract, first per house, not delivered before."""
    return spark.read.schema("house_id string, trace_id string").parquet(
        f"{_ingest(spark, sf)}/topic").select("house_id", "trace_id")


def q_stream_listing_rejects(spark, sf):
    return spark.read.schema("house_id string, trace_id string, reasons array<string>").parquet(
        f"{_ingest(spark, sf)}/rejects").select("house_id", "trace_id", "reasons")


def q_stream_fresh_checkpoint(spark, sf):
    """Two runs of the fan-out on one table, the second on a fresh checkpoint: no run touches the other's rows."""
    out = scratch_path(spark, "fresh-fanout")
    msg = clicks.click_messages(fixtures.click(spark, sf))
    first = F.pmod(F.xxhash64("user_id"), F.lit(3)) == 0
    for rows in (msg.where(first), msg.where(~first)):
        path = fixtures.stage_json(rows, scratch_path(spark, "click-part"))
        src = read_click_stream(spark, source="text", path=path)
        more._run(batch_fanout(src, {out: clicks.click_ods}, ["dt"], scratch_path(spark, "ckpt"), more.AVAILABLE_NOW))
    return more.read_back(spark, out, clicks.click_ods(_catalog().click_src(spark, sf)))


def q_stream_ingest_fresh_checkpoint(spark, sf):
    """Two ingest runs on fresh checkpoints: houses that the first run delivered are skipped by the second."""
    return spark.read.schema("house_id string, trace_id string").parquet(
        f"{_ingest(spark, sf, 2)}/topic").select("house_id", "trace_id")


def q_stream_clicks_to_catalog(spark, sf):
    """The four sinks of the click statement set into the tables of a catalog database: rows of each table."""
    db = _database(spark, "ls_clicks")
    for query in jobs.run_click_pipeline(more._click_stream(spark, sf), db, scratch_path(spark, "ckpt"), more.AVAILABLE_NOW):
        more._run(query)
    out = None
    for name in ("ods_user_behavior", "dwd_user_behavior", "dws_category_metrics", "dws_behavior_funnel"):
        one = spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def q_stream_late_rows(spark, sf):
    """Three deliveries to a windowed aggregate; stragglers of the third are behind the watermark and dropped."""
    msg = clicks.click_messages(fixtures.click(spark, sf))
    middle = msg.agg(F.avg("ts")).first()[0] or 0
    part = F.when(F.col("ts") % 10 == 0, 2).when(F.col("ts") < middle, 0).otherwise(1)
    path, out, ck = scratch_path(spark, "late-clicks"), scratch_path(spark, "late-metrics"), scratch_path(spark, "ckpt")
    value = F.to_json(F.struct(*msg.columns)).alias("value")
    for i in range(3):
        msg.where(part == i).select(value).write.mode("append").text(path)
        src = read_click_stream(spark, source="text", path=path)
        more._run(jobs.category_metrics_stream(src, out, ck, more.AVAILABLE_NOW))
    return more.read_back(spark, out, clicks.category_window_metrics(_catalog().click_src(spark, sf)))


def q_compact_incremental(spark, sf):
    """Small loads of the older days are merged while the stream goes on; the newest load and later days stay."""
    msg = clicks.click_messages(fixtures.click(spark, sf))
    path, out, ck = scratch_path(spark, "click-loads"), scratch_path(spark, "loads"), scratch_path(spark, "ckpt")
    value = F.to_json(F.struct(*msg.columns)).alias("value")
    for i in range(4):
        msg.where(F.pmod(F.xxhash64("user_id"), F.lit(4)) == i).select(value).write.mode("append").text(path)
        src = read_click_stream(spark, source="text", path=path)
        more._run(batch_fanout(src, {out: clicks.click_ods}, ["dt"], ck, more.AVAILABLE_NOW))
        compact(spark, out, "dt")
    return more.read_back(spark, out, clicks.click_ods(_catalog().click_src(spark, sf)))


def q_upsert_fold(spark, sf):
    """Changes of four batches, folded by the compaction job in between and at the end."""
    ods, path = write_staged(_catalog().ods(spark, sf), "changes"), scratch_path(spark, "change-log")   # arrived messages
    for i in range(4):
        upsert_batch(ods.where(F.col("unit_price") % 4 == i), i, path, list(ODS_KEYS), more.LATEST, ["city"])
        if i % 2:
            compact(spark, path, "city", keys=list(ODS_KEYS), order_by=more.LATEST)
    return read_upserted(spark, path, list(ODS_KEYS), more.LATEST, ods.schema)


def q_source_view(spark, sf):
    """A session-scoped source view, read by SQL."""
    register_source(clicks.click_messages(fixtures.click(spark, sf)), "lakestrata_click_source")
    return spark.sql("SELECT behavior, count(*) AS n, max(ts) AS last_ts FROM lakestrata_click_source GROUP BY behavior")


def q_load_stamp(spark, sf):
    """Rows stamped with the load time, which is the same for a whole load."""
    flat = flatten_listing(to_listing_message(fixtures.listing(spark, sf)))
    now = F.current_timestamp()
    return flat.select("house_id", "trace_id", (F.col("etl_time").isNotNull() & (F.col("etl_time") <= now)).alias("stamped"))


def q_written_codec(spark, sf):
    """Compression codec of every file that a partitioned write leaves, by day."""
    path = scratch_path(spark, "codec")
    overwrite_partitions(clicks.click_ods(_catalog().click_src(spark, sf)), path, by="dt")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("dt").cast("string").alias("dt"), F.regexp_extract("path", "[.]([a-z0-9]+)[.]parquet$", 1).alias("codec")).distinct()


def q_topic_order(spark, sf):
    """Published messages, by topic partition in written order: how many follow a later one of their user."""
    path = scratch_path(spark, "ordered-topic")
    publish_events(clicks.click_messages(fixtures.click(spark, sf)), path=path, partitions=3)
    lines = spark.read.text(path).select("partition", "value", F.monotonically_increasing_id().alias("at")).select(
        "*", F.get_json_object("value", "$.user_id").alias("user_id"), F.get_json_object("value", "$.ts").cast("long").alias("ts"))
    before = F.lag("ts").over(Window.partitionBy("user_id").orderBy("at"))
    return lines.withColumn("before", before).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("partition").alias("partitions"),
        F.sum((F.col("before") > F.col("ts")).cast("long")).alias("out_of_order")).select(
        "user_id", "n", "partitions", F.coalesce("out_of_order", F.lit(0).cast("long")).alias("out_of_order"))


QUERIES = {
    "click_csv_scan": q_click_csv_scan,
    "catalog_roundtrip": q_catalog_roundtrip,
    "insert_by_name": q_insert_by_name,
    "daily_to_catalog": q_daily_to_catalog,
    "table_schemas": q_table_schemas,
    "append_by_dt": q_append_by_dt,
    "stream_restart": q_stream_restart,
    "stream_compact_stream": q_stream_compact_stream,
    "upsert_null_partition": q_upsert_null_partition,
    "compact_string_partition": q_compact_string_partition,
    "compact_map_table": q_compact_map_table,
    "stream_listing_ingest": q_stream_listing_ingest,
    "stream_listing_rejects": q_stream_listing_rejects,
    "stream_fresh_checkpoint": q_stream_fresh_checkpoint,
    "stream_ingest_fresh_checkpoint": q_stream_ingest_fresh_checkpoint,
    "stream_clicks_to_catalog": q_stream_clicks_to_catalog,
    "stream_late_rows": q_stream_late_rows,
    "compact_incremental": q_compact_incremental,
    "upsert_fold": q_upsert_fold,
    "source_view": q_source_view,
    "load_stamp": q_load_stamp,
    "written_codec": q_written_codec,
    "topic_order": q_topic_order,
}
