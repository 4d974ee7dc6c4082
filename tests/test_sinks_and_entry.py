"""Sinks (dynamic overwrite, compaction) and the driver contract."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakestrata.sinks import compaction
from lakestrata.sinks.compaction import compact, recover
from lakestrata.sinks.files import file_count, overwrite_partitions, topic_messages
from tests.conftest import SF0001, rows


def _files(path):
    out = {}
    for root, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                p = os.path.join(root, n)
                out[p] = os.path.getmtime(p)
    return out


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_dir):
    df = spark.createDataFrame([("20240101", 1), ("20240102", 2)], "ds string, v int")
    overwrite_partitions(df, tmp_dir, by="ds")
    before = {p: m for p, m in _files(tmp_dir).items() if "ds=20240101" in p}
    overwrite_partitions(spark.createDataFrame([("20240102", 3)], "ds string, v int"), tmp_dir,
                         by="ds")
    after = _files(tmp_dir)
    assert all(after.get(p) == m for p, m in before.items())
    got = spark.read.schema("v int, ds string").parquet(tmp_dir)
    assert rows(got, "ds", "v") == [("20240101", 1), ("20240102", 3)]


def test_compact_reduces_files_and_keeps_rows(spark, tmp_dir):
    df = spark.range(0, 5000).select((F.col("id") % 2).cast("string").alias("dt"), "id")
    df.repartition(20).write.partitionBy("dt").mode("append").parquet(tmp_dir)
    n_before = file_count(spark, tmp_dir)
    compact(spark, tmp_dir, "dt")
    assert file_count(spark, tmp_dir) < n_before
    got = spark.read.schema("id long, dt string").parquet(tmp_dir)
    assert got.count() == 5000 and got.agg(F.sum("id")).first()[0] == sum(range(5000))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["ds", "room_num", "hall_num", "bathroom_num"]


def test_every_query_has_an_oracle():
    own = {k for k in entry.queries() if not re.match(r"op\d+_|pipeline$", k)}
    assert own == set(entry.oracle_sql()) & own
    assert len(entry.queries()) >= 55


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from lakestrata.fixtures import TABLES
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF0001, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", sorted(entry.catalog.queries()))
def test_query_matches_oracle(spark, duck, key):
    from tools.oracle_check import digest
    got = digest(entry.queries()[key](spark, SF0001).toArrow())
    want = digest(duck.sql(entry.oracle_sql()[key]).to_arrow_table())
    assert got == want


def test_compact_keeps_folder_names_maps_and_stream_layout(spark, tmp_dir):
    rows_in = [(i, {"a": i}, v, b) for i, (v, b) in enumerate([("007", 1), ("7", 1), (None, 2), ("007", 2)] * 5)]
    df = spark.createDataFrame(rows_in, "id int, m map<string,int>, code string, batch_id long")
    df.repartition(6).write.mode("append").partitionBy("code", "batch_id").parquet(tmp_dir)
    before = file_count(spark, tmp_dir)
    compact(spark, tmp_dir, "code")
    back = spark.read.schema("id int, m map<string,int>, code string, batch_id long").parquet(tmp_dir)
    key = lambda r: r[0]
    assert sorted(((r.id, dict(r.m), r.code, r.batch_id) for r in back.collect()), key=key) == sorted(rows_in, key=key)
    assert file_count(spark, tmp_dir) < before
    assert {d for d in os.listdir(tmp_dir) if "=" in d} == {"code=007", "code=7", "code=__HIVE_DEFAULT_PARTITION__"}


def test_upsert_keeps_null_partition_rows_and_survives_a_crash_in_the_write(spark, tmp_dir, monkeypatch):
    from lakestrata.streaming import sinks
    batch = lambda *r: spark.createDataFrame(list(r), "house_id string, city string, t int")
    go = lambda b, i: sinks.upsert_batch(b, i, f"{tmp_dir}/t", ["house_id", "city"], ["t"], ["city"])
    go(batch(("h1", None, 1), ("h2", "A", 1)), 0)
    real = sinks.overwrite_partitions

    def dies(df, target, by):
        """Writes one row, then fails."""
        real(df.limit(1), target, by)
        raise RuntimeError("executor lost")
    monkeypatch.setattr(sinks, "overwrite_partitions", dies)
    second = batch(("h3", None, 2), ("h4", "A", 2), ("h2", "A", 3))
    with pytest.raises(RuntimeError):
        go(second, 1)
    monkeypatch.setattr(sinks, "overwrite_partitions", real)
    go(second, 1)
    go(second, 1)
    got = sinks.read_upserted(spark, f"{tmp_dir}/t", ["house_id", "city"], ["t"])
    assert rows(got, "house_id", "t") == [("h1", 1), ("h2", 3), ("h3", 2), ("h4", 2)]


def _loads(spark, path, loads, per_load=300):
    for n, load in enumerate(loads):
        df = spark.range(n * per_load, (n + 1) * per_load).selectExpr("cast(id % 2 as string) dt", "id", f"'{load}' load_id")
        df.repartition(2).write.mode("append").partitionBy("dt", "load_id").parquet(path)


def test_compact_merges_closed_loads_and_leaves_the_rest(spark, tmp_dir):
    big = spark.range(100_000).selectExpr("'9' dt", "id", "'q-0000000000' load_id").coalesce(1)
    big.write.mode("append").partitionBy("dt", "load_id").parquet(tmp_dir)
    _loads(spark, tmp_dir, ["q-0000000001", "q-0000000002", "q-0000000003", "r-0000000007"])
    before = _files(tmp_dir)
    n = compact(spark, tmp_dir, "dt", target_bytes=100_000)
    after = _files(tmp_dir)
    # the newest load of each query and the large partition are the same files as before
    stay = {p for p in before if "dt=9" in p or "q-0000000003" in p or "r-0000000007" in p}
    assert {p: before[p] for p in stay} == {p: after[p] for p in after if p in before}
    assert n == len(after) - len(stay) == 2 and not any("q-0000000001" in p for p in after)
    got = spark.read.schema("id long, dt string, load_id string").parquet(tmp_dir)
    assert got.where("dt != '9'").count() == 1200 and got.select("id", "dt").distinct().count() == 101_200
    assert compact(spark, tmp_dir, "dt", target_bytes=100_000) == 0        # nothing left to do
    assert _files(tmp_dir) == after


@pytest.mark.parametrize("target", [20_000, 60_000])
def test_compacted_files_are_about_the_target(spark, tmp_dir, target):
    df = spark.range(40_000).selectExpr("cast(id % 2 as string) dt", "uuid() u")
    df.repartition(24).write.mode("append").partitionBy("dt").parquet(tmp_dir)
    compact(spark, tmp_dir, "dt", target_bytes=target * 10)
    sizes = [os.path.getsize(p) for p in _files(tmp_dir)]
    total = sum(sizes)
    assert len(sizes) <= total / (target * 10) + 4 and max(sizes) <= 1.6 * target * 10


@pytest.mark.parametrize("step", ["remove", "data", "moves", "deletes"])
def test_compaction_survives_a_crash_at_every_step(spark, tmp_dir, monkeypatch, step):
    _loads(spark, tmp_dir, ["q-0000000001", "q-0000000002", "q-0000000003"])
    want = rows(spark.read.schema("id long, dt string").parquet(tmp_dir).select("id", "dt"))
    real_rewrite, real_finish = compaction._rewrite, compaction.finish

    def dies(*args, **kw):
        raise RuntimeError("driver lost")

    def half(spark_, path, folder):
        """Moves (and, for the later step, deletes) some files, then dies."""
        fs, root = compaction._fs(spark_, f"{folder}/data")
        one = fs.listFiles(root, True)
        while one.hasNext():
            p = one.next().getPath()
            if p.getName().endswith(".parquet"):
                inner = p.toString().split("/data/")[1]
                target = spark_._jvm.org.apache.hadoop.fs.Path(f"{path}/{inner}")
                fs.mkdirs(target.getParent())
                fs.rename(p, target)
                if step == "moves":
                    break
        if step == "deletes":
            old = spark_.read.text(f"{folder}/remove").first()[0]
            fs.delete(spark_._jvm.org.apache.hadoop.fs.Path(old), False)
        raise RuntimeError("driver lost")
    if step == "remove":
        def rewrite(session, path, folder, job, picked, *rest):
            session.createDataFrame(picked[["path"]]).write.text(f"{folder}/remove")
            raise RuntimeError("driver lost")
        monkeypatch.setattr(compaction, "_rewrite", rewrite)
    else:
        monkeypatch.setattr(compaction, "finish", dies if step == "data" else half)
    with pytest.raises(RuntimeError):
        compact(spark, tmp_dir, "dt")
    monkeypatch.setattr(compaction, "_rewrite", real_rewrite)
    monkeypatch.setattr(compaction, "finish", real_finish)
    assert recover(spark, tmp_dir) == (step != "remove")
    read = spark.read.schema("id long, dt string").parquet(tmp_dir).select("id", "dt")
    assert rows(read) == want
    compact(spark, tmp_dir, "dt")
    assert rows(spark.read.schema("id long, dt string").parquet(tmp_dir).select("id", "dt")) == want
    assert not os.listdir(f"{tmp_dir}/_compact")


@pytest.mark.parametrize("arrow", ["true", "false"])
def test_compact_with_and_without_arrow(spark, tmp_dir, monkeypatch, arrow):
    """Without Arrow the plan's counts come from pandas as longs, which no row number of a partition may be."""
    df = spark.range(400).selectExpr("id", "cast(id % 3 as string) AS dt")
    df.repartition(6).write.partitionBy("dt").mode("append").parquet(tmp_dir)
    session = compaction._strings_session(spark)
    session.conf.set("spark.sql.execution.arrow.pyspark.enabled", arrow)
    monkeypatch.setattr(compaction, "_strings_session", lambda _: session)
    assert compact(spark, tmp_dir, "dt") == 3
    assert rows(spark.read.schema("id long, dt string").parquet(tmp_dir)) == rows(df)


def test_compact_catalog_table(spark, tmp_dir):
    from lakestrata.sources.batch import ensure_table
    df = spark.range(3000).selectExpr("id", "cast(id % 3 as string) dt")
    ensure_table(spark, "lakestrata_compact_t", df.schema, ["dt"], location=f"{tmp_dir}/t")
    try:
        for i in range(4):
            df.where(f"id % 4 = {i}").write.insertInto("lakestrata_compact_t")
        assert compact(spark, "lakestrata_compact_t", "dt") == 3
        assert rows(spark.table("lakestrata_compact_t")) == rows(df)
        assert file_count(spark, f"{tmp_dir}/t") == 3
    finally:
        spark.sql("DROP TABLE lakestrata_compact_t")


def test_topic_messages_are_written_by_one_task_a_partition_in_order(spark):
    from tests.test_plans import plan
    df = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', cast(id % 50 as string)) user_id", "5000 - id ts", "id item")
    out = topic_messages(df, partitions=4)
    assert "REPARTITION" in plan(out) or "repartitionbyid" in plan(out).lower() or "Exchange" in plan(out)
    parts = out.rdd.glom().collect()
    spots = [{r["partition"] for r in p} for p in parts]
    assert all(len(s) <= 1 for s in spots) and sum(len(s) for s in spots) == len(set().union(*spots))
    import json
    for p in parts:
        seen = {}
        for r in p:
            ts = json.loads(r["value"])["ts"]
            assert seen.get(r["key"], 0) <= ts
            seen[r["key"]] = ts


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_upsert_deals_rows_out_once(spark, tmp_dir, adaptive):
    """A batch is shuffled by key only, and written unsorted, from the tasks that picked; reads carry no unused column."""
    from lakestrata.streaming.sinks import read_upserted, upsert_batch
    from tests.test_plans import plan
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.adaptive.enabled", adaptive)
    df = session.range(4000).selectExpr("concat('h', id % 1000) AS k", "concat('c', id % 1000 % 3) AS city", "id AS t",
                                        "repeat(cast(id AS string), 20) AS wide")
    keys = ["k", "city"]
    for i in (0, 1, 2):
        upsert_batch(df.where(F.col("t") % 3 == i), i, f"{tmp_dir}/log", keys, ["t"], ["city"])
    log = read_upserted(session, f"{tmp_dir}/log", keys, ["t"], df.schema)
    assert rows(log) == rows(df.where("t >= 3000"))
    assert int(session.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1
    narrow = plan(log.select("k", "t"))
    exchange = narrow[narrow.rindex("Exchange\n"):].split("\n\n")[0]
    assert "wide" not in exchange and ", Partial" not in narrow
    assert compact(session, f"{tmp_dir}/log", "city", keys=keys, order_by=["t"], everything=True) == 3
    assert rows(read_upserted(session, f"{tmp_dir}/log", keys, ["t"], df.schema)) == rows(log)


def test_table_schemas_explodes_one_row_a_table(spark):
    from tests.test_plans import plan
    p = plan(entry.queries()["table_schemas"](spark, SF0001))
    # every generator reads the one row of flags of an aggregate (a filter on its count in between)
    assert p.count("+- Generate") + p.count(":- Generate") == 14
    tree = [ln.strip(" :+-") for ln in p.split("\n\n")[0].splitlines()]
    below = [next(x for x in tree[i + 1:] if not x.startswith(("Project", "Filter", "LocalLimit"))) for i, x in enumerate(tree)
             if x.startswith("Generate")]
    assert all("Aggregate" in x for x in below)


def test_writes_leave_no_shuffle_files(spark, tmp_dir):
    import glob
    import time

    from lakestrata.session import write_staged
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}
    df = spark.range(2000).selectExpr("id", "cast(id % 3 as string) dt")
    before = files()
    overwrite_partitions(df, f"{tmp_dir}/t", by="dt")
    write_staged(df.repartition("id"), "no-shuffle-left")
    for _ in range(50):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert rows(spark.read.schema("id long, dt string").parquet(f"{tmp_dir}/t")) == rows(df)


def test_overlapping_settings_restore_the_first_value(spark):
    from lakestrata.session import session_conf
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    one, two = session_conf(spark, key, "true"), session_conf(spark, key, "true")
    one.__enter__()
    two.__enter__()  # of another thread, say
    one.__exit__(None, None, None)
    assert spark.conf.get(key) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(key) == before == "false"


def test_rows_of_few_partitions_are_written_in_place(spark, tmp_dir):
    from lakestrata.sinks.files import OPEN_FILES, InPlace, clustered, place
    for days, in_place in ((OPEN_FILES, True), (OPEN_FILES + 1, False)):
        df = spark.range(500).selectExpr("id", f"cast(id % {days} as string) ds")
        by = place(df, "ds")
        assert isinstance(by, InPlace) == in_place and list(by) == ["ds"]
        assert ("Rebalance" in clustered(df, by)._jdf.queryExecution().optimizedPlan().toString()) != in_place
        overwrite_partitions(df, f"{tmp_dir}/{days}", by=by)
        assert rows(spark.read.schema("id long, ds string").parquet(f"{tmp_dir}/{days}")) == rows(df)
