"""Serving analyses over the DWD fact (BI-1 .. BI-5).

The reference names these notebook analyses but ships no code, so each is
a plain grouped query with a fixed definition stated in its docstring.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X


def market_overview(dwd: DataFrame) -> DataFrame:
    """Per day and decoration: listings of the day, the day's average unit
    price, listings with that decoration and their share of the day (BI-1)."""
    day = dwd.groupBy("ds").agg(F.count(F.lit(1)).alias("total_listings"),
                                F.avg("unit_price").alias("avg_unit_price"))
    deco = (dwd.where(F.col("decoration").isNotNull())
            .groupBy("ds", "decoration").agg(F.count(F.lit(1)).alias("decoration_count")))
    out = deco.join(day, "ds")
    return out.select("ds", "decoration", "total_listings", "avg_unit_price", "decoration_count",
                      X.pct(F.col("decoration_count"), F.col("total_listings"))
                      .alias("decoration_share"))


def neighborhood_heat(dwd: DataFrame) -> DataFrame:
    """Per city and neighbourhood: listings, summed and average attention and visits (BI-2)."""
    return dwd.groupBy("city", "neighborhood").agg(
        F.count(F.lit(1)).alias("listing_count"),
        F.sum("attention_count").cast("long").alias("total_attention"),
        F.sum("visit_30_days").cast("long").alias("total_visits"),
        F.avg("attention_count").alias("avg_attention"),
        F.avg("visit_30_days").alias("avg_visits"))


def price_structure(dwd: DataFrame) -> DataFrame:
    """Per price range x build-year segment: listings, average area and the
    price/area correlation (BI-3)."""
    base = (dwd.where(F.col("total_price") > 0)
            .withColumn("price_range", X.price_range("total_price"))
            .withColumn("segment", X.year_segment("build_year")))
    return base.groupBy("price_range", "segment").agg(
        F.count(F.lit(1)).alias("listing_count"),
        F.avg("area_sqm").alias("avg_area_sqm"),
        F.corr("total_price", "area_sqm").alias("price_area_corr"))


def type_orientation(dwd: DataFrame) -> DataFrame:
    """Per room type x orientation (NULL orientation is a group): listings and
    average unit price; rows without full room info are left out (BI-4)."""
    base = (dwd.dropna(subset=["room_num", "hall_num", "bathroom_num"])
            .withColumn("room_type", X.room_type("room_num", "hall_num", "bathroom_num")))
    return base.groupBy("room_type", "orientation").agg(
        F.count(F.lit(1)).alias("listing_count"),
        F.avg("unit_price").alias("avg_unit_price"))


def high_attention_profile(dwd: DataFrame, top_share: float = 0.1) -> DataFrame:
    """High-attention listings versus the rest, per day (BI-5).

    A listing is *high* when fewer than ``top_share`` of the day's listings
    have strictly more attention than it.  Everything is pre-aggregated per
    (day, attention value) first -- counts and sums, one row per distinct
    value -- so the running count, the high/rest split and the averages are
    computed on that small histogram and no raw row is joined or sorted.
    """
    base = dwd.where(F.col("attention_count").isNotNull())
    measures = ("total_price", "area_sqm", "build_year", "attention_count")
    hist = base.groupBy("ds", "attention_count").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(c).cast("double").alias(f"__s_{c}") for c in measures],
        *[F.count(c).alias(f"__c_{c}") for c in measures])
    w = Window.partitionBy("ds").orderBy(F.col("attention_count").desc())
    tagged = (hist.withColumn("__above", F.sum("__n").over(w) - F.col("__n"))
              .withColumn("__total", F.sum("__n").over(Window.partitionBy("ds")))
              .withColumn("segment", F.when(
                  F.col("__above") < F.col("__total") * F.lit(Decimal(str(top_share))), "high")
                  .otherwise("rest")))
    names = {"total_price": "avg_total_price", "area_sqm": "avg_area_sqm",
             "build_year": "avg_build_year", "attention_count": "avg_attention"}
    return tagged.groupBy("ds", "segment").agg(
        F.sum("__n").alias("listing_count"),
        *[(F.sum(f"__s_{c}") / F.sum(f"__c_{c}")).alias(names[c]) for c in measures])


QUERIES = {
    "bi_market_overview": market_overview,
    "bi_neighborhood_heat": neighborhood_heat,
    "bi_price_structure": price_structure,
    "bi_type_orientation": type_orientation,
    "bi_high_attention_profile": high_attention_profile,
}
