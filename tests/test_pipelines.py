"""Listing warehouse and click tables on hand-made rows (traps S3, S9-S12)."""

import datetime as dt

from pyspark.sql import functions as F

from lakestrata.operators.nested import flatten_listing, parse_listing_json, to_listing_message
from lakestrata.plans import clicks, listings
from lakestrata.sources.batch import normalise_click_log, read_click_csv
from tests.conftest import rows

DWD_COLS = ("ds string, city string, district string, neighborhood string, community string, "
            "house_id string, trace_id string, total_price double, unit_price int, "
            "area_sqm double, room_num int, hall_num int, bathroom_num int, orientation string, "
            "decoration string, build_year int, tags array<string>, attention_count int, "
            "visit_30_days int, house_url string, title string")


def _dwd(spark, data):
    base = dict(ds="20240101", city="C", district="D", neighborhood="N", community="M",
                house_id="h", trace_id="t", total_price=100.0, unit_price=10, area_sqm=50.0,
                room_num=2, hall_num=1, bathroom_num=1, orientation="S", decoration="x",
                build_year=2000, tags=["a"], attention_count=1, visit_30_days=1,
                house_url="u", title="t")
    names = [c.split()[0] for c in DWD_COLS.split(", ")]
    return spark.createDataFrame([tuple({**base, **d}[n] for n in names) for d in data], DWD_COLS)


def test_hot_communities_heat_filter(spark):
    df = _dwd(spark, [dict(community="out1", attention_count=0, visit_30_days=0),
                      dict(community="out2", attention_count=None, visit_30_days=5),
                      dict(community="in", attention_count=3, visit_30_days=0)])
    out = listings.hot_communities(df)
    assert rows(out, "community", "rank_by_attention", "rank_by_visit") == [("in", 1, 1)]


def test_community_daily_null_district_gets_empty_map_unless_null_safe(spark):
    df = _dwd(spark, [dict(district=None), dict(district=None, tags=["a", "b"])])
    plain = listings.community_daily(df).first()
    assert (plain["house_count"], dict(plain["room_type_distribution"]), plain["hot_tags"]) == \
        (2, {}, [])
    safe = listings.community_daily(df, null_safe=True).first()
    assert dict(safe["room_type_distribution"]) == {"2-1-1": 2} and safe["hot_tags"] == ["a", "b"]


def test_city_overview_excludes_rows_without_room_info(spark):
    df = _dwd(spark, [dict(total_price=100.0), dict(total_price=900.0, room_num=None)])
    r = listings.city_overview_daily(df).first()
    assert (r["total_house_count"], r["avg_total_price"]) == (1, 100.0)
    c = listings.community_daily(df).first()
    assert (c["house_count"], c["avg_total_price"]) == (2, 500.0)


def test_price_range_drops_non_positive_and_shares_sum_to_100(spark):
    df = _dwd(spark, [dict(total_price=p) for p in (99.99, 100.0, 999.99, 1000.0, 0.0, -1.0, None)])
    out = listings.price_range_distribution(df)
    assert rows(out, "price_range", "house_count", "percentage") == [
        ("0-100万", 1, 25.0), ("100-200万", 1, 25.0), ("1000万以上", 1, 25.0),
        ("900-1000万", 1, 25.0)]


def test_top_attention_ties_are_deterministic(spark):
    df = _dwd(spark, [dict(house_id=f"h{i:02d}", trace_id=f"t{i}", attention_count=5)
                      for i in range(15)])
    out = listings.top_attention_houses(df)
    assert [r["house_id"] for r in out.orderBy("rank").collect()] == [f"h{i:02d}" for i in range(10)]


def test_nested_round_trip_and_bad_json(spark):
    flat = spark.createDataFrame([("h1", "C", 1704067200, 12)],
                                 "house_id string, city string, event_time long, unit_price int")
    msg = to_listing_message(flat)
    good = msg.select(F.to_json(F.struct("header", "core_data", "ext_attributes")).alias("value"))
    bad = spark.createDataFrame([("{not json",), ('{"core_data":{"house_id":"h2","unit_price":"n/a"}}',)],
                                "value string")
    out = flatten_listing(parse_listing_json(good.unionByName(bad)), with_etl_time=False)
    assert rows(out, "house_id", "unit_price") == [("h1", 12), ("h2", None)]


def test_unknown_behaviour_makes_zero_row_but_leaves_dwd(spark):
    t = dt.datetime(2024, 1, 1, 0, 10, 0)
    src = spark.createDataFrame([("u", "i", "c", "unknown", t), ("u", "i", "c", "pv", t),
                                 ("u", "i", "d", "unknown", t)],
                                "user_id string, item_id string, category_id string, "
                                "behavior string, ts_ltz timestamp")
    src = src.withColumn("ts", F.lit(0).cast("long")).withColumn("event_time", F.lit(""))
    m = clicks.category_window_metrics(src)
    assert rows(m, "category_id", "pv_cnt", "cart_cnt") == [("c", 1, 0), ("d", 0, 0)]
    # the event at exactly 00:10:00 belongs to the window it starts
    assert rows(m.select(F.col("win_start").cast("string")).distinct()) == [("2024-01-01 00:10:00",)]
    assert clicks.click_dwd(src).count() == 1


def test_click_csv_and_normalise(spark, tmp_dir):
    path = f"{tmp_dir}/log.csv"
    with open(path, "w") as f:
        f.write("1,2,3,pv\n1,2,3,pv,900000000,x\n1,2,3,pv,abc\n1,2,3,pv,1\n"
                "1,2,3,pv,900000000\n1,2,3,buy,2000000000\n1,2,3,pv,2000000001\n")
    log = read_click_csv(spark, path)
    assert log.count() == 5
    out = normalise_click_log(log, tz="UTC")
    assert rows(out, "ts", "event_time") == [(900000000, "1998-07-09 16:00:00"),
                                             (2000000000, "2033-05-18 03:33:20")]
