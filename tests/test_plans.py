"""Plan-shape checks: the scale properties the design relies on are asserted
on the physical plans, not only described."""

import contextlib
import io

from pyspark.sql import functions as F

from lakestrata import catalog
from lakestrata.operators.aggregate import latest_per_key
from lakestrata.plans import clicks, listings
from tests.conftest import SF0001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_k_is_group_limited_on_both_sides_of_the_shuffle(spark):
    p = plan(listings.top_attention_houses(catalog.dwd_table(spark, SF0001)))
    assert p.count("WindowGroupLimit") >= 2
    assert "Partial" in p and "Final" in p


def test_latest_per_key_is_group_limited(spark):
    p = plan(latest_per_key(catalog.ods(spark, SF0001), ["house_id", "city"],
                            ["event_time", "trace_id"]))
    assert p.count("WindowGroupLimit") >= 2


def test_incremental_load_prunes_partitions_and_columns(spark):
    p = plan(listings.orientation_daily(catalog.dwd_table(spark, SF0001), since="20240103"))
    assert "PartitionFilters: [isnotnull(ds" in p and ">= 20240103" in p
    # the second pass of the medians: total_price, unit_price, orientation
    read = [ln for ln in p.splitlines() if ln.startswith("ReadSchema") and "__q_" not in ln and "house_count" not in ln]
    assert read and all(ln.split("struct<")[1].count(":") <= 3 for ln in read)


def test_aggregates_have_a_partial_step(spark):
    p = plan(listings.house_type_daily(catalog.dwd_table(spark, SF0001)))
    # partial aggregate below the exchange, final above it
    assert p.count("ObjectHashAggregate") + p.count("HashAggregate") >= 2


def test_fixed_size_dimensions_are_broadcast(spark):
    p = plan(catalog.listing(spark, SF0001))
    assert "BroadcastHashJoin" in p
    assert "Scan parquet" in p and "ReadSchema: struct<r_regionkey:int,r_name:string>" in p


def test_no_python_udf_in_the_headline_plans(spark):
    dwd = catalog.dwd_table(spark, SF0001)
    src = catalog.click_src(spark, SF0001)
    for df in (listings.community_daily(dwd), listings.city_overview_daily(dwd),
               listings.price_range_distribution(dwd), clicks.category_window_metrics(src),
               clicks.behavior_funnel_windows(src)):
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_hot_tags_are_limited_before_collecting(spark):
    p = plan(listings.community_daily(catalog.dwd_table(spark, SF0001)))
    assert "WindowGroupLimit" in p and "Generate" in p


def test_hot_ranks_do_not_join_pairs(spark):
    dwd = catalog.dwd_table(spark, SF0001).withColumn("ds", F.lit("20240101"))  # one hot day
    p = plan(listings.hot_communities(dwd))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_scans_read_only_what_is_used_and_are_not_repartitioned(spark):
    for key, most in (("ring_road", 5), ("category_window_metrics", 4)):
        p = plan(catalog.RAW[key](spark, SF0001))
        fact = "lineitem" if key == "ring_road" else "events"
        scans = p.split("Location: InMemoryFileIndex")
        read = [s.split("ReadSchema: struct<")[1].split(">")[0] for s in scans if f"{fact}.parquet" in s.split("ReadSchema")[0]]
        assert read and all(r.count(":") <= most for r in read)
        assert "REPARTITION_BY" not in p


def test_ranks_with_cutoff_reads_its_input_twice(spark):
    p = plan(listings.hot_communities(catalog.dwd_table(spark, SF0001)))
    assert p.count("WindowGroupLimit") <= 4 and p.count("Scan ExistingRDD") <= 2



def test_latest_listings_are_sorted_once_after_the_shuffle(spark):
    keys, order = ["house_id", "city"], ["event_time", "trace_id"]
    query = catalog.RAW["upsert_latest_per_key"](spark, SF0001)
    ods = catalog.ods(spark, SF0001)
    few, many = (latest_per_key(ods, keys, order, few=x) for x in (True, False))
    for df, picks in ((query, 0), (few, 0), (many, 1)):
        assert plan(df).count("Arguments: [house_id") >= 1 and plan(df).count(", Partial") == picks
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
