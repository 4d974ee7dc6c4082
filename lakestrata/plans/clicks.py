"""Click-stream pipeline: messages -> ODS / DWD -> 10-minute metrics -> views (WH-10 .. WH-14).

Every function works on a batch *or* a streaming DataFrame; the streaming
wiring (watermark, output mode, sinks) lives in ``lakestrata.streaming``.
Event time ``ts_ltz`` is a TIMESTAMP (an instant, as watermarks require)
whose UTC reading is the event's wall clock, so window boundaries fall on
wall-clock multiples in any session zone; wall-clock outputs are written
back as TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expressions as X
from ..operators.aggregate import count_by_value
from ..schemas import (BEHAVIOR_FUNNEL_COLUMNS, CATEGORY_METRICS_COLUMNS, CLICK_DWD_COLUMNS,
                       CLICK_ODS_COLUMNS)

FMT = "yyyy-MM-dd HH:mm:ss"


def click_messages(click: DataFrame) -> DataFrame:
    """Click events with a wall-clock ``ts_ltz`` -> producer messages
    (``ts`` epoch seconds, ``event_time`` text)."""
    return click.select("user_id", "item_id", "category_id", "behavior",
                        F.unix_timestamp(F.col("ts_ltz").cast("timestamp_ntz")).alias("ts"),
                        F.date_format(F.col("ts_ltz").cast("timestamp_ntz"), FMT)
                        .alias("event_time"))


def with_event_time(messages: DataFrame, fmt: str = FMT) -> DataFrame:
    """Source table with computed ``ts_ltz = TO_TIMESTAMP(event_time)``."""
    return messages.withColumn("ts_ltz", X.parse_event_time("event_time", fmt))


def _ntz(col: str):
    return X.instant_to_wall(col).alias(col)


def click_ods(src: DataFrame) -> DataFrame:
    """ODS: every message plus its date partition ``dt`` (WH-10)."""
    return (src.withColumn("dt", X.event_date("ts_ltz"))
            .select(*[_ntz(c) if c == "ts_ltz" else F.col(c) for c in CLICK_ODS_COLUMNS]))


def click_dwd(src: DataFrame) -> DataFrame:
    """DWD: known behaviours only, ``event_time`` pruned (WH-10, FIL-2, PRJ-17)."""
    return (src.where(F.col("behavior").isNotNull() & F.col("behavior").isin(list(K.BEHAVIORS)))
            .withColumn("dt", X.event_date("ts_ltz"))
            .select(*[_ntz(c) if c == "ts_ltz" else F.col(c) for c in CLICK_DWD_COLUMNS]))


def _window_bounds(window: str = K.WINDOW_SIZE):
    return F.window("ts_ltz", window)


def category_window_metrics(src: DataFrame, window: str = K.WINDOW_SIZE) -> DataFrame:
    """Per tumbling window and category: pv/cart/fav/buy counts (WH-11, STR-2, AGG-6).

    Any non-NULL behaviour counts as a row, so unknown behaviours produce
    all-zero rows, as in the reference.
    """
    agg = (src.where(F.col("behavior").isNotNull())
           .groupBy(_window_bounds(window).alias("w"), "category_id")
           .agg(*count_by_value("behavior", ("pv", "cart", "fav", "buy"),
                                ("pv_cnt", "cart_cnt", "fav_cnt", "buy_cnt"))))
    return agg.select(X.instant_to_wall("w.start").alias("win_start"),
                      X.instant_to_wall("w.end").alias("win_end"),
                      *CATEGORY_METRICS_COLUMNS[2:])


def behavior_funnel_windows(src: DataFrame, window: str = K.WINDOW_SIZE) -> DataFrame:
    """Per tumbling window and behaviour: step name and count (WH-12, PRJ-14)."""
    agg = (src.where(F.col("behavior").isin(list(K.BEHAVIORS)))
           .groupBy(_window_bounds(window).alias("w"), "behavior")
           .agg(F.count(F.lit(1)).alias("trigger_cnt")))
    return agg.select(X.instant_to_wall("w.start").alias("win_start"),
                      X.instant_to_wall("w.end").alias("win_end"),
                      "behavior", X.funnel_step("behavior").alias("step_name"), "trigger_cnt"
                      ).select(*BEHAVIOR_FUNNEL_COLUMNS)


def view_category_metrics(metrics: DataFrame, dim: DataFrame) -> DataFrame:
    """All-time totals per category name; categories without a name drop out (WH-13, JOIN-4).

    The size of the dimension is not assumed: AQE turns the join into a
    broadcast once it has measured it.
    """
    joined = metrics.join(dim, "category_id", "inner")
    return joined.groupBy("category_name").agg(
        *[F.sum(c).cast("long").alias(f"total_{c[:-4]}") for c in
          ("pv_cnt", "cart_cnt", "fav_cnt", "buy_cnt")])


def view_behavior_funnel(funnel: DataFrame) -> DataFrame:
    """All-time total per funnel step (WH-14)."""
    return funnel.groupBy("step_name").agg(F.sum("trigger_cnt").cast("long").alias("trigger_cnt"))
