"""Streaming: batch/stream equivalence, restart, late data, upsert idempotence."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from lakestrata import catalog, catalog_more as more, fixtures
from lakestrata.operators.nested import to_listing_message
from lakestrata.plans import clicks
from lakestrata.session import scratch_path, session_conf
from lakestrata.streaming import jobs
from lakestrata.sinks.compaction import compact
from lakestrata.streaming.sinks import read_upserted, upsert_batch
from lakestrata.streaming.sources import read_click_stream
from tests.conftest import SF0001, rows

NOW = {"availableNow": True}


def _write_msgs(path, name, msgs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for m in msgs:
            f.write(json.dumps(m) + "\n")


def _msg(t: dt.datetime, cat="c", behavior="pv"):
    return {"user_id": "u", "item_id": "i", "category_id": cat, "behavior": behavior,
            "ts": int(t.replace(tzinfo=dt.timezone.utc).timestamp()),
            "event_time": t.strftime("%Y-%m-%d %H:%M:%S")}


def _metrics(spark, src_dir, out, ck):
    q = jobs.category_metrics_stream(
        read_click_stream(spark, source="text", path=src_dir, max_files=1), out, ck, NOW)
    q.awaitTermination()
    return spark.read.parquet(out).drop("load_id")


def test_stream_equals_batch_on_closed_windows(spark):
    msgs = clicks.click_messages(fixtures.click(spark, SF0001))
    staged = fixtures.stage_json(msgs, scratch_path(spark, "topic"))
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    q = jobs.category_metrics_stream(read_click_stream(spark, "text", staged), out, ck, NOW)
    q.awaitTermination()
    streamed = spark.read.parquet(out).drop("load_id")
    batch = clicks.category_window_metrics(catalog.click_src(spark, SF0001))
    wm = catalog.click_src(spark, SF0001).agg(F.max("ts_ltz")).first()[0] - dt.timedelta(seconds=3)
    closed = batch.where(F.col("win_end") <= F.lit(wm).cast("timestamp_ntz"))
    assert rows(streamed) == rows(closed)
    # the last open window is not emitted in append mode (S5)
    assert batch.count() > streamed.count()


def test_restart_on_same_checkpoint_continues(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t0 = dt.datetime(2024, 1, 1, 0, 1, 0)
    _write_msgs(src, "a.json", [_msg(t0), _msg(t0 + dt.timedelta(minutes=15))])
    first = _metrics(spark, src, out, ck).count()
    assert first == 1                       # [00:00, 00:10) closed by the watermark
    _write_msgs(src, "b.json", [_msg(t0 + dt.timedelta(minutes=31))])
    second = _metrics(spark, src, out, ck)  # resumes: only the new file is read
    assert second.count() == 2
    assert rows(second.select("win_start", "pv_cnt"))[0][1] == 1


def test_late_rows_two_batches_behind_are_dropped(spark, tmp_dir):
    """Late rows are filtered with the previous batch's watermark (trap S4):
    a row arriving two batches after the watermark passed it is dropped."""
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t0 = dt.datetime(2024, 1, 1, 1, 0, 0)
    batches = [[_msg(t0)], [_msg(t0 + dt.timedelta(minutes=30))],
               [_msg(t0 + dt.timedelta(minutes=45))],
               [_msg(t0 + dt.timedelta(minutes=1))]]          # 44 minutes late
    for i, b in enumerate(batches):
        _write_msgs(src, f"{i}.json", b)
        os.utime(os.path.join(src, f"{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    got = _metrics(spark, src, out, ck)
    counts = {r["win_start"]: r["pv_cnt"] for r in got.collect()}
    assert counts[dt.datetime(2024, 1, 1, 1, 0)] == 1


def test_upsert_is_idempotent_and_keeps_city_changes(spark, tmp_dir):
    target = f"{tmp_dir}/ods"
    cols = "house_id string, city string, event_time long, trace_id string, price int"
    b0 = spark.createDataFrame([("h1", "A", 1, "t1", 10), ("h1", "A", 2, "t2", 20),
                                ("h2", "A", 1, "t3", 5)], cols)
    b1 = spark.createDataFrame([("h1", "A", 3, "t4", 30), ("h1", "B", 3, "t5", 99),
                                ("h2", "A", 0, "t0", 1)], cols)
    keys, order = ["house_id", "city"], ["event_time", "trace_id"]
    read = lambda: rows(read_upserted(spark, target, keys, order, b0.schema), "house_id", "city", "price")
    upsert_batch(b0, 0, target, keys, order, ["city"])
    upsert_batch(b1, 1, target, keys, order, ["city"])
    once = read()
    upsert_batch(b1, 1, target, keys, order, ["city"])   # replay of batch 1
    assert once == read() == [("h1", "A", 30), ("h1", "B", 99), ("h2", "A", 5)]
    # a fold keeps what readers see, also while the newest batch stays apart
    compact(spark, target, "city", keys=keys, order_by=order, everything=True)
    assert once == read()
    # without a schema the load column is left out
    assert set(read_upserted(spark, target, keys, order).columns) == set(b0.columns)


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_a_batch_writes_no_more_when_the_table_has_grown(spark, tmp_dir):
    """Bytes and files of an upserted batch do not depend on what the table holds (20 batches)."""
    keys, order = ["house_id", "city"], ["event_time"]
    sizes, before = [], 0
    for i in range(20):
        batch = spark.range(0, 400).selectExpr("cast(id % 300 as string) house_id", "'A' city",
                                               f"id + 1000 * {i} event_time", "repeat('x', 50) title")
        upsert_batch(batch, i, f"{tmp_dir}/t", keys, order, ["city"])
        now = _bytes(f"{tmp_dir}/t")
        sizes.append(now - before)
        before = now
    assert max(sizes) <= 1.2 * min(sizes)
    assert read_upserted(spark, f"{tmp_dir}/t", keys, order).count() == 300


def test_fresh_checkpoints_add_rows_and_a_retry_replaces_its_own(spark, tmp_dir):
    from lakestrata.streaming.sinks import append_stream, batch_fanout
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    t0 = dt.datetime(2024, 1, 1)
    _write_msgs(src, "a.json", [_msg(t0 + dt.timedelta(seconds=i)) for i in range(100)])
    for ck, want in (("c1", 100), ("c1", 100), ("c2", 200)):
        q = batch_fanout(read_click_stream(spark, "text", src), {f"{out}/fan": clicks.click_ods}, ["dt"], f"{tmp_dir}/{ck}", NOW)
        q.awaitTermination()
        p = append_stream(read_click_stream(spark, "text", src), f"{out}/append", f"{tmp_dir}/a{ck}", trigger=NOW)
        p.awaitTermination()
        assert spark.read.parquet(f"{out}/fan").count() == spark.read.parquet(f"{out}/append").count() == want
    # a batch whose commit was lost is run again under the same name
    for f in os.listdir(f"{tmp_dir}/c2/commits"):
        os.remove(f"{tmp_dir}/c2/commits/{f}")
    q = batch_fanout(read_click_stream(spark, "text", src), {f"{out}/fan": clicks.click_ods}, ["dt"], f"{tmp_dir}/c2", NOW)
    q.awaitTermination()
    assert spark.read.parquet(f"{out}/fan").count() == 200


def test_ingest_batches_read_what_arrives_and_not_what_was_delivered(spark, tmp_dir):
    """Twenty batches with houses seen before and new ones: input rows a batch stay flat, each house comes once."""
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    for i in range(20):
        msgs = [{"header": {"source": "s", "event_time": 100 * i + k, "trace_id": f"t{i}-{k}"},
                 "core_data": {"house_id": f"h{h}", "house_url": "u", "city": "c", "district": "d", "community": "m",
                               "total_price": 1.0, "unit_price": 2, "area_sqm": 3.0}}
                for k, h in enumerate([*range(10 * i, 10 * i + 10), *range(0, 10)])]
        _write_msgs(src, f"{i:02d}.json", msgs)
        os.utime(f"{src}/{i:02d}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    before = spark.createDataFrame([("h3",), ("h195",), (None,)], "house_id string")
    from lakestrata.streaming.sources import read_listing_stream
    queries = jobs.listing_ingest_stream(read_listing_stream(spark, "text", path=src, max_files=1), f"{out}/topic",
                                         f"{out}/rejects", f"{tmp_dir}/ck", before, NOW)
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None
    sizes = [p["numInputRows"] for p in queries[0].recentProgress if p["numInputRows"]]
    assert len(sizes) == 20 and set(sizes[1:]) == {20} and sizes[0] == 22
    got = spark.read.parquet(f"{out}/topic")
    assert sorted(r[0] for r in got.select("house_id").collect()) == sorted(f"h{i}" for i in range(200) if i not in (3, 195))
    assert got.where("house_id = 'h5'").first()["trace_id"] == "t0-5"


def test_late_rows_are_counted(spark, tmp_dir):
    from lakestrata.streaming.sinks import LateRows, late_rows
    src, t0 = f"{tmp_dir}/src", dt.datetime(2024, 1, 1, 1, 0, 0)
    late = LateRows()
    spark.streams.addListener(late)
    try:
        for i, minutes in enumerate((0, 60, 1)):      # the third row is behind the watermark
            _write_msgs(src, f"{i}.json", [_msg(t0 + dt.timedelta(minutes=minutes))])
            q = jobs.category_metrics_stream(read_click_stream(spark, "text", src), f"{tmp_dir}/out", f"{tmp_dir}/ck", NOW)
            q.awaitTermination()
        assert late_rows(q) == 1
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        assert late.dropped[str(q.id)] == 1
    finally:
        spark.streams.removeListener(late)


def test_merge_matches_null_keys():
    from lakestrata.streaming.sinks import merge_sql
    sql = merge_sql("db.t", "v", ["house_id", "city"], ["event_time"])
    assert "t.`city` <=> s.`city`" in sql and "t.`house_id` <=> s.`house_id`" in sql


def test_bounded_dedupe_forgets_keys_behind_the_watermark(spark, tmp_dir):
    from lakestrata.streaming.sinks import append_stream, dedupe_stream
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    # expired keys leave the state at the end of the batch that sees the
    # advanced watermark, so the key may re-appear from the batch after it
    batches = [[_msg(t0), _msg(t0 + dt.timedelta(seconds=1))],        # same key twice
               [_msg(t0 + dt.timedelta(hours=2), cat="x")],            # moves the watermark
               [_msg(t0 + dt.timedelta(hours=2, seconds=1), cat="y")],  # evicts "u|c"
               [_msg(t0 + dt.timedelta(hours=2, seconds=5))]]          # key "u|c" again, much later
    for i, b in enumerate(batches):
        _write_msgs(src, f"{i}.json", b)
        os.utime(os.path.join(src, f"{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    stream = read_click_stream(spark, "text", src, max_files=1).withColumn(
        "k", F.concat_ws("|", "user_id", "category_id"))
    q = append_stream(dedupe_stream(stream, "k", "ts_ltz", "10 minutes").drop("ts_ltz"), out, ck,
                      trigger=NOW)
    q.awaitTermination()
    got = spark.read.parquet(out).drop("load_id")
    # within the watermark the duplicate is dropped; after it the key may re-appear
    assert got.where("k = 'u|c'").count() == 2 and got.where("k = 'u|x'").count() == 1
    assert got.where("k = 'u|c' AND ts < 1704067300").count() == 1   # the t0+1s copy was dropped


def test_merge_into_parquet_table_is_refused_clearly(spark, tmp_dir):
    import pytest
    from lakestrata.sources.batch import ensure_table
    b = spark.createDataFrame([("h1", "A", 1, "t1")],
                              "house_id string, city string, event_time long, trace_id string")
    ensure_table(spark, "lakestrata_merge_t", b.schema, location=f"{tmp_dir}/t")
    try:
        with pytest.raises(ValueError, match="MERGE INTO"):
            upsert_batch(b, 0, "lakestrata_merge_t", ["house_id", "city"],
                         ["event_time", "trace_id"], ["city"])
    finally:
        spark.sql("DROP TABLE lakestrata_merge_t")


def test_topics_are_compressed_in_bounded_files(spark, tmp_dir, monkeypatch):
    from lakestrata import fixtures
    monkeypatch.setattr(fixtures, "TOPIC_FILE_ROWS", 1000)
    df = spark.range(5000).selectExpr("id", "concat('house-', id) AS house_id", "'a value that is long' AS text").coalesce(1)
    path = fixtures.stage_json(df, f"{tmp_dir}/topic")
    files = [f"{path}/{n}" for n in os.listdir(path) if n.startswith("part-")]
    assert len(files) == 5 and sum(os.path.getsize(f) for f in files) < 5000 * 20
    got = spark.read.schema(df.schema).json(path)
    assert got.count() == 5000 and got.exceptAll(df).isEmpty()
    stream = spark.readStream.text(path).selectExpr("get_json_object(value, '$.house_id') AS house_id")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start(
        f"{tmp_dir}/out").awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/out").distinct().count() == 5000


def test_first_per_key_shuffles_rows_once_and_keeps_the_first(spark, tmp_dir):
    from lakestrata.streaming.sinks import append_stream, first_per_key_stream
    check = "spark.sql.streaming.unsupportedOperationCheck"
    data = spark.range(4000).selectExpr("cast(id % 40 as string) k", "cast(abs(hash(id)) % 100 as int) t", "id v",
                                        "IF(id % 40 = 7 OR id % 3 = 0, array('bad'), cast(array() as array<string>)) why")
    data.repartition(7).write.parquet(f"{tmp_dir}/in")
    spark.createDataFrame([("3",), ("99",)], "k string").write.parquet(f"{tmp_dir}/seen")
    stream = spark.readStream.schema(data.schema).parquet(f"{tmp_dir}/in")
    seen = spark.readStream.schema("k string").parquet(f"{tmp_dir}/seen")
    first = first_per_key_stream(stream, "k", ["t", "v"], seen, unless="why")
    q = append_stream(first, f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger=NOW, sorts=True)
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    assert plan.count("Exchange") == 1 and "Arrow" not in plan
    assert spark.conf.get(check) == "true"
    want = data.where("size(why) = 0 AND k <> '3'").groupBy("k").agg(F.min(F.struct("t", "v")).alias("m")).select("k", "m.*")
    assert rows(spark.read.parquet(f"{tmp_dir}/out"), "k", "t", "v") == rows(want)
    assert want.count() == 38


def test_message_log_is_dealt_out_once_and_read_by_many_tasks(spark, tmp_dir, monkeypatch):
    from lakestrata.streaming.sources import read_listing_stream
    monkeypatch.setattr(fixtures, "LOG_BLOCK", 64 << 10)
    msgs = to_listing_message(fixtures.listing(spark, SF0001)).coalesce(1)
    log = fixtures.stage_log(msgs, f"{tmp_dir}/log", F.col("core_data.unit_price") % 2)
    for part in range(2):
        read = []
        src = read_listing_stream(spark, "parquet", f"{log}/part={part}", max_files=1, arrival=True)

        def run(batch, i):
            read.extend(batch.select("core_data.house_id", "header.trace_id", "arrival_offset").collect())
        src.writeStream.foreachBatch(run).option("checkpointLocation", f"{tmp_dir}/ck{part}").trigger(availableNow=True).start().awaitTermination()
        assert sorted(r[:2] for r in read) == rows(msgs.where(F.col("core_data.unit_price") % 2 == part).select(
            "core_data.house_id", "header.trace_id"))
        assert len({r.arrival_offset for r in read}) == len(read)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        assert spark.read.schema("value string").parquet(f"{log}/part=0").selectExpr("spark_partition_id() p").distinct().count() > 1
    finally:
        spark.conf.set(key, before)


def test_rejects_are_written_where_they_are_read(spark, tmp_dir):
    import glob
    rejects = spark.range(40).selectExpr("cast(id AS string) house_id", "array('missing:city') reasons").repartition(2)
    rejects.write.parquet(f"{tmp_dir}/src")
    stream = spark.readStream.schema(rejects.schema).parquet(f"{tmp_dir}/src")
    more._run(jobs.reject_stream(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck", NOW))
    assert len(glob.glob(f"{tmp_dir}/out/*/*.parquet")) == 2  # no shuffle
    assert rows(spark.read.schema(rejects.schema).parquet(f"{tmp_dir}/out").select("house_id")) == rows(rejects.select("house_id"))


def test_keys_of_a_first_per_key_stream_lie_on_disk(spark, tmp_dir):
    import glob
    from lakestrata.streaming.sinks import KEYED_CONF, append_stream, first_per_key_stream
    key = "spark.sql.streaming.stateStore.providerClass"
    with session_conf(spark, key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        before = {k: spark.conf.get(k, None) for k in KEYED_CONF}
        rows_ = "id string, t long, a string, b string"
        spark.createDataFrame([("x", 2, "\x01", None), ("x", 1, "a", ""), ("y", 1, None, "b")], rows_).write.parquet(f"{tmp_dir}/src")
        spark.createDataFrame([("y",)], "id string").write.parquet(f"{tmp_dir}/seen")
        first = first_per_key_stream(spark.readStream.schema(rows_).parquet(f"{tmp_dir}/src"), "id", ["t"],
                                     spark.readStream.schema("id string").parquet(f"{tmp_dir}/seen"))
        more._run(append_stream(first, f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger=NOW, sorts=True))
        assert {k: spark.conf.get(k, None) for k in KEYED_CONF} == before
    assert rows(spark.read.schema(rows_).parquet(f"{tmp_dir}/out").select("id", "t", "a", "b")) == [("x", 1, "a", "")]
    assert glob.glob(f"{tmp_dir}/ck/state/0/*/*.zip") and not glob.glob(f"{tmp_dir}/ck/state/0/*/*.delta")
