"""End-to-end pipelines: click statement set, listing ingestion, daily warehouse."""

import os

from pyspark.sql import functions as F

from lakestrata import catalog, catalog_more as more, fixtures
from lakestrata.operators.aggregate import latest_per_key
from lakestrata.operators.nested import to_listing_message
from lakestrata.plans import clicks, listings
from lakestrata.schemas import DIM_CATEGORY
from lakestrata.session import scratch_path
from lakestrata.sinks.files import publish_events
from lakestrata.sources.batch import (ensure_table, read_table, register_source)
from lakestrata.streaming import jobs
from lakestrata.streaming.sinks import read_upserted, upsert_batch
from lakestrata.streaming.sources import read_click_stream, read_listing_stream
from tests.conftest import SF0001, rows

NOW = {"availableNow": True}


def test_click_statement_set_four_sinks(spark):
    msgs = clicks.click_messages(fixtures.click(spark, SF0001))
    staged = fixtures.stage_json(msgs, scratch_path(spark, "topic"))
    out, ck = scratch_path(spark, "lake"), scratch_path(spark, "ck")
    src = read_click_stream(spark, "text", staged)
    for q in jobs.run_click_pipeline(src, out, ck, NOW):
        q.awaitTermination()
    batch_src = catalog.click_src(spark, SF0001)
    ods = spark.read.parquet(os.path.join(out, "ods_user_behavior"))
    dwd = spark.read.parquet(os.path.join(out, "dwd_user_behavior"))
    assert ods.count() == batch_src.count()
    assert dwd.count() == clicks.click_dwd(batch_src).count()
    assert set(ods.columns) >= {"user_id", "ts_ltz", "dt", "load_id"}
    funnel = spark.read.parquet(os.path.join(out, "dws_behavior_funnel"))
    assert funnel.count() > 0 and funnel.where(F.col("step_name").isNull()).count() == 0


def test_listing_ingestion_upserts_valid_rows(spark):
    msgs = to_listing_message(fixtures.listing(spark, SF0001))
    staged = fixtures.stage_json(msgs.repartition(2, "header.event_time"), scratch_path(spark, "topic"))
    target, ck = scratch_path(spark, "ods"), scratch_path(spark, "ck")
    q = jobs.run_listing_pipeline(read_listing_stream(spark, "text", staged, max_files=1),
                                       target, ck, NOW)
    q.awaitTermination()
    got = read_upserted(spark, target, ["house_id", "city"], ["event_time", "trace_id"])
    assert got.count() == got.select("house_id", "city").distinct().count()
    assert got.count() == catalog.ods(spark, SF0001).select("house_id", "city").distinct().count()


def test_change_log_in_halves_equals_latest_per_key(spark, tmp_dir):
    ods = catalog.ods(spark, SF0001)
    keys, order = ["house_id", "city"], ["event_time", "trace_id"]
    for i in (0, 1):
        upsert_batch(ods.where(F.col("event_time") % 2 == i), i, f"{tmp_dir}/log", keys, order, ["city"])
    got = read_upserted(spark, f"{tmp_dir}/log", keys, order, ods.schema)
    want = latest_per_key(ods, keys, order)
    assert rows(got, "house_id", "city", "trace_id") == rows(want, "house_id", "city", "trace_id")


def test_run_daily_writes_all_layers_and_reruns_idempotently(spark, tmp_dir):
    ods = catalog.ods(spark, SF0001)
    paths = listings.run_daily(ods, tmp_dir, tz="UTC", blacklist=("AFRICA",))
    assert len(paths) == 9
    counts = {n: spark.read.parquet(p).count() for n, p in paths.items()}
    listings.run_daily(ods, tmp_dir, tz="UTC", blacklist=("AFRICA",), since="20240103")
    again = {n: spark.read.parquet(p).count() for n, p in paths.items()}
    assert counts == again and counts["dwd_ershoufang_fact"] == catalog.dwd(spark, SF0001).count()


def test_publish_events_keeps_per_user_order(spark, tmp_dir):
    import glob
    import json as js
    msgs = clicks.click_messages(fixtures.click(spark, SF0001))
    # a hot user: a third of all events
    hot = msgs.withColumn("user_id", F.when(F.col("ts") % 3 == 0, F.lit("hot"))
                          .otherwise(F.col("user_id")))
    publish_events(hot, key="user_id", path=f"{tmp_dir}/topic", partitions=6)
    where = {}
    n = 0
    for f in sorted(glob.glob(f"{tmp_dir}/topic/partition=*/part-*")):
        spot = f.split("partition=")[1].split("/")[0]
        last = {}
        for r in map(js.loads, open(f)):
            assert last.get(r["user_id"], 0) <= r["ts"]      # in order within the file
            assert where.setdefault(r["user_id"], f) == f    # one file per user
            last[r["user_id"]] = r["ts"]
            n += 1
        assert int(spot) in range(6)
    assert n == msgs.count()


def test_ensure_table_read_table_register_source(spark, tmp_dir):
    ensure_table(spark, "lakestrata_test_dim", DIM_CATEGORY, location=f"{tmp_dir}/dim")
    ensure_table(spark, "lakestrata_test_dim", DIM_CATEGORY, location=f"{tmp_dir}/dim")
    assert read_table(spark, "lakestrata_test_dim").columns == ["category_id", "category_name"]
    register_source(fixtures.dim(spark, SF0001), "dim_category_src")
    assert spark.table("dim_category_src").count() == fixtures.table(spark, SF0001, "part").count()
    spark.sql("DROP TABLE lakestrata_test_dim")


def test_click_stream_fails_on_malformed_json(spark, tmp_dir):
    import pytest
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write('{"user_id":"u","item_id":"i","category_id":"c","behavior":"pv","ts":1,'
                '"event_time":"2024-01-01 00:00:00"}\n{broken\n')
    q = jobs.behavior_funnel_stream(read_click_stream(spark, "text", src),
                                         f"{tmp_dir}/out", f"{tmp_dir}/ck", NOW)
    with pytest.raises(Exception):
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def test_insert_by_name_into_ds_partitioned_table(spark, tmp_dir):
    from lakestrata.schemas import DWS_ORIENTATION_COLUMNS, conform
    from lakestrata.sinks.files import overwrite_partitions
    out = listings.orientation_daily(catalog.dwd(spark, SF0001))
    assert out.columns[0] == "ds"
    schema = conform(out, [c for c in DWS_ORIENTATION_COLUMNS if c != "ds"] + ["ds"]).schema
    ensure_table(spark, "lakestrata_test_orient", schema, ["ds"], location=f"{tmp_dir}/t")
    overwrite_partitions(out, "lakestrata_test_orient")
    back = spark.table("lakestrata_test_orient")
    assert rows(back, *out.columns) == rows(out)
    spark.sql("DROP TABLE lakestrata_test_orient")


def test_dimension_keys_must_be_unique(spark):
    import pytest
    from lakestrata.sources.batch import load_dimension
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "id int, name string")
    with pytest.raises(ValueError):
        load_dimension(dup, "id", "name")
    ok = load_dimension(spark.createDataFrame([(1, "a")], "id int, name string"), "id", "name")
    assert ok.schema.simpleString() == "struct<id:string,name:string>"


def test_cli_jobs(spark, tmp_dir):
    from lakestrata import cli
    ods_path = f"{tmp_dir}/ods"
    catalog.ods(spark, SF0001).write.parquet(ods_path)
    paths = cli.main(["daily", "--ods", ods_path, "--out", f"{tmp_dir}/wh", "--tz", "UTC",
                      "--blacklist", "AFRICA"], spark=spark)
    assert spark.read.parquet(paths["ads_top10_attention_houses_daily"]).count() > 0
    n = cli.main(["compact", "--path", paths["dwd_ershoufang_fact"], "--partition", "ds"],
                 spark=spark)
    assert n == 0 and spark.read.parquet(paths["dwd_ershoufang_fact"]).count() == \
        catalog.dwd(spark, SF0001).count()
    topic = fixtures.stage_json(clicks.click_messages(fixtures.click(spark, SF0001)),
                            f"{tmp_dir}/topic")
    cli.main(["clicks", "--path", topic, "--out", f"{tmp_dir}/lake", "--available-now",
              "--checkpoint", f"{tmp_dir}/ck"], spark=spark)
    assert spark.read.parquet(f"{tmp_dir}/lake/dws_category_metrics").count() > 0

    listing_topic = fixtures.stage_json(to_listing_message(more.defective_listing(spark, SF0001)), f"{tmp_dir}/listings")
    cli.main(["listings", "--path", listing_topic, "--target", f"{tmp_dir}/ods_log", "--rejects", f"{tmp_dir}/bad",
              "--available-now", "--checkpoint", f"{tmp_dir}/ck2"], spark=spark)
    cli.main(["ingest", "--path", listing_topic, "--target", f"{tmp_dir}/delivered", "--rejects", f"{tmp_dir}/bad2",
              "--available-now", "--max-files", "2", "--checkpoint", f"{tmp_dir}/ck3"], spark=spark)
    bad = spark.read.parquet(f"{tmp_dir}/bad").count()
    assert bad > 0 and bad == spark.read.parquet(f"{tmp_dir}/bad2").count()
    assert spark.read.parquet(f"{tmp_dir}/delivered").groupBy("house_id").count().where("count > 1").count() == 0
    n = cli.main(["compact", "--path", f"{tmp_dir}/ods_log", "--key", "house_id", "--key", "city", "--order", "event_time",
                  "--order", "trace_id"], spark=spark)
    # the daily job reads the change log resolved to the latest rows
    paths = cli.main(["daily", "--ods", f"{tmp_dir}/ods_log", "--out", f"{tmp_dir}/wh2", "--tz", "UTC", "--blacklist", "x"],
                     spark=spark)
    fact = spark.read.parquet(paths["dwd_ershoufang_fact"])
    assert fact.count() == fact.select("house_id", "city").distinct().count() > 0
    log = f"{tmp_dir}/clicks.csv"
    with open(log, "w") as f:
        f.write("u1,i,c,pv,1511544070\nu1,i,c,pv,1511544071\nu2,i,c,buy,5\nbroken\n")
    cli.main(["publish", "--csv", log, "--out", f"{tmp_dir}/published", "--tz", "UTC"], spark=spark)
    assert spark.read.text(f"{tmp_dir}/published").count() == 2


def test_run_daily_concurrent_loads_match_sequential(spark, tmp_dir):
    ods = catalog.ods(spark, SF0001)
    seq = listings.run_daily(ods, f"{tmp_dir}/a", tz="UTC", blacklist=("AFRICA",))
    par = listings.run_daily(ods, f"{tmp_dir}/b", tz="UTC", blacklist=("AFRICA",), concurrency=4)
    from pyspark.sql import types as T
    for name in seq:
        a, b = spark.read.parquet(seq[name]), spark.read.parquet(par[name])
        assert a.count() == b.count()
        # map columns cannot be compared by exceptAll; compare the other columns
        cols = [f.name for f in a.schema.fields if not isinstance(f.dataType, T.MapType)]
        assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0


def test_ensure_table_records_writer_properties(spark, tmp_dir):
    from lakestrata.functions import constants as K
    ensure_table(spark, "lakestrata_props_t", DIM_CATEGORY, location=f"{tmp_dir}/p",
                 properties={"write.target-file-size-bytes": K.TARGET_FILE_BYTES,
                             "write.metadata.previous-versions-max": 5})
    try:
        props = {r["key"]: r["value"] for r in
                 spark.sql("SHOW TBLPROPERTIES lakestrata_props_t").collect()}
        assert props["write.target-file-size-bytes"] == str(K.TARGET_FILE_BYTES)
        assert props["write.metadata.previous-versions-max"] == "5"
        assert props["compression"] == "zstd"
    finally:
        spark.sql("DROP TABLE lakestrata_props_t")
