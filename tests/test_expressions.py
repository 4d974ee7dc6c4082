"""Golden rows for the projection expressions (PRJ-*, FIL-10)."""

from pyspark.sql import functions as F

from lakestrata.functions import expressions as X
from tests.conftest import rows


def test_price_buckets_half_open(spark):
    df = spark.createDataFrame([(99.99,), (100.0,), (999.99,), (1000.0,), (0.5,)], "p double")
    got = dict(rows(df.select("p", X.price_range("p").alias("r"))))
    assert got == {99.99: "0-100万", 100.0: "100-200万", 999.99: "900-1000万",
                   1000.0: "1000万以上", 0.5: "0-100万"}


def test_price_bucket_null_falls_through_like_sql_case(spark):
    df = spark.createDataFrame([(None,)], "p double")
    assert df.select(X.price_range("p")).first()[0] == "1000万以上"


def test_year_segments(spark):
    df = spark.createDataFrame([(1989,), (1990,), (2009,), (2010,), (None,)], "y int")
    got = dict(rows(df.select("y", X.year_segment("y").alias("s"))))
    assert got == {1989: "1990前", 1990: "1990-2000", 2009: "2000-2010", 2010: "2010后",
                   None: "未知"}


def test_floor_ratio_defaults_to_zero(spark):
    df = spark.createDataFrame([("低楼层",), ("中楼层",), ("高楼层",), ("未知",), (None,)], "f string")
    got = dict(rows(df.select("f", X.floor_ratio("f").alias("r"))))
    assert got == {"低楼层": 0.25, "中楼层": 0.5, "高楼层": 0.75, "未知": 0.0, None: 0.0}


def test_ring_road(spark):
    df = spark.createDataFrame([("五环至六环外",), ("三环内",), ("城郊",), (None,)], "d string")
    got = dict(rows(df.select("d", X.ring_road("d").alias("r"))))
    assert got == {"五环至六环外": "五环至六环", "三环内": "三环", "城郊": "", None: None}


def test_room_type_is_null_if_any_part_null(spark):
    df = spark.createDataFrame([(2, 1, 1), (2, None, 1)], "r int, h int, b int")
    assert rows(df.select(X.room_type("r", "h", "b"))) == [("2-1-1",), (None,)]


def test_null_if_sentinel(spark):
    df = spark.createDataFrame([("TODO_MAPPING",), ("A",)], "d string")
    assert rows(df.select(X.null_if("d"))) == [("A",), (None,)]


def test_ds_from_epoch_is_session_independent(spark):
    df = spark.createDataFrame([(1704153599,)], "e long")  # 2024-01-01 23:59:59 UTC
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        r = df.select(X.ds_from_epoch("e", "UTC"), X.ds_from_epoch("e", "Asia/Shanghai"),
                      X.ds_from_epoch("e", None)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(r) == ("20240101", "20240102", "20240102")


def test_parse_event_time_bad_text_is_null(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07",), ("not-a-time",)], "s string")
    got = rows(df.select(X.instant_to_wall(X.parse_event_time("s")).cast("string")))
    assert got == [("2024-01-01 00:00:07",), (None,)]


def test_ts_range_boundaries(spark):
    df = spark.createDataFrame([("abc",), ("1",), ("900000000",), ("2000000000",),
                                ("2000000001",)], "t string")
    assert rows(df.where(X.ts_in_range("t"))) == [("2000000000",), ("900000000",)]


def test_funnel_step_has_no_else(spark):
    df = spark.createDataFrame([("pv",), ("buy",), ("unknown",)], "b string")
    got = dict(rows(df.select("b", X.funnel_step("b"))))
    assert got == {"pv": "1-浏览(PV)", "buy": "4-购买(Buy)", "unknown": None}


def test_pct_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(1, 32), (1, 3)], "n long, t long")
    got = rows(df.select(X.pct(F.col("n"), F.col("t"))))
    assert got == [(3.13,), (33.33,)]
