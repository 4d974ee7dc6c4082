"""Aggregation operators (AGG-*).

The aggregates are hash/object-hash aggregates with a partial (map-side)
step, so a hot group is pre-reduced in every task before the shuffle; the
per-key picks (``latest_per_key``, the top-n in ``top_values``) are
group-limited windows, which cut each key to n rows per task before the
shuffle.  Collected arrays only ever hold *distinct keys* of a group (room
types, tags), never rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.expressions import pct
from ..session import write_staged
from .rank import top_n_per_group


def approx_median(col, accuracy: int = K.MEDIAN_ACCURACY) -> Column:
    """``PERCENTILE_APPROX(col, 0.5, accuracy)`` (AGG-3): a mergeable sketch of bounded size per group,
    off by at most ``rows / accuracy`` ranks.  The warehouse tables use ``with_medians``, which is exact."""
    c = F.col(col) if isinstance(col, str) else col
    return F.percentile_approx(c, 0.5, accuracy)


def price_stats(count_name: str = "house_count") -> list[Column]:
    """The count/avg block shared by the DWS tables."""
    return [
        F.count(F.lit(1)).alias(count_name),
        F.avg("total_price").alias("avg_total_price"),
        F.avg("unit_price").alias("avg_unit_price"),
        F.avg("area_sqm").alias("avg_area_sqm"),
    ]


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the keys are those of ``left``."""
    side = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(side, same, how).drop(*[f"__r_{k}" for k in keys])


PRICE_MEDIANS = {"total_price": "median_total_price", "unit_price": "median_unit_price"}
# A sketch of this accuracy keeps every value of a group of up to accuracy / 5 rows.  Its ranks are off
# by at most rows / accuracy, so the bracket of ten times that holds the median of any group.
_ACCURACY = 10_000
_SURE, _MARGIN = _ACCURACY // 5, 10 / _ACCURACY


def with_medians(df: DataFrame, keys: Sequence[str], medians: Mapping[str, str], numbers: Sequence[Column]) -> DataFrame:
    """One row per group of ``keys`` with ``numbers`` and the exact discrete medians of columns (AGG-3).

    ``medians`` maps a numeric column to its output; the median is the least value with at least half of the
    group's values at or below it, as a double, at every group size.  The first pass takes a quantile sketch
    per group next to the numbers.  It is exact for small groups; for the others it gives a narrow bracket
    around the median (0.2% of the rows).  A second pass counts their values below the bracket and
    each value inside, and a running sum over those counts ends at the median.  Both passes reduce in
    every task before their shuffle, so no task ever holds or sorts the values of a hot group.
    """
    sketch = [F.percentile_approx(F.col(c).cast("double"), F.array(*[F.lit(0.5 + d) for d in (-_MARGIN, 0.0, _MARGIN)]),
                                  _ACCURACY).alias(f"__q_{c}") for c in medians]
    sizes = [F.count(c).alias(f"__n_{c}") for c in medians]
    groups = write_staged(df.groupBy(*keys).agg(*numbers, *sketch, *sizes), "groups")
    large = reduce(lambda a, b: a | b, [F.col(f"__n_{c}") > _SURE for c in medians])
    brackets = groups.where(large).select(*keys, *[c for m in medians for c in (f"__q_{m}", f"__n_{m}")])
    values = null_safe(df.select(*keys, *medians), brackets, keys, "inner").select(*keys, F.explode(F.array(*[
        F.struct(F.lit(out).alias("of"), F.col(c).cast("double").alias("v"), F.col(f"__q_{c}")[0].alias("lo"),
                 F.col(f"__q_{c}")[2].alias("hi"), F.floor((F.col(f"__n_{c}") + 1) / 2).alias("middle"))
        for c, out in medians.items()])).alias("x")).select(*keys, "x.*")
    counts = (values.where("v <= hi").groupBy(*keys, "of", "middle", F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("v"))
              .agg(F.count(F.lit(1)).alias("n")))
    upto = F.sum("n").over(Window.partitionBy(*keys, "of").orderBy(F.col("v").asc_nulls_first())
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # the rows below the bracket come first (v is NULL there); the sketch's bound says they never reach the middle
    reached = counts.withColumn("upto", upto).where("upto >= middle").withColumn(
        "v", F.when(F.col("v").isNull(), F.raise_error(F.lit("median outside its bracket")).cast("double")).otherwise(F.col("v")))
    found = reached.groupBy(*keys).agg(*[F.min(F.when(F.col("of") == out, F.col("v"))).alias(f"__m_{c}")
                                         for c, out in medians.items()])
    kept = [c for c in groups.columns if not c.startswith(("__q_", "__n_"))]
    return null_safe(groups, found, keys).select(*kept, *[
        F.coalesce(f"__m_{c}", F.col(f"__q_{c}")[1]).alias(out) for c, out in medians.items()])


def count_by_value(col: str, values: Sequence[str], names: Sequence[str]) -> list[Column]:
    """Conditional-count pivot ``SUM(CASE WHEN col = v THEN 1 ELSE 0 END)`` (AGG-6)."""
    return [F.sum(F.when(F.col(col) == F.lit(v), 1).otherwise(0)).cast("long").alias(n)
            for v, n in zip(values, names)]


def distribution_map(df: DataFrame, group_cols: Sequence[str], key_col: str,
                     out_name: str) -> DataFrame:
    """Per group: ``MAP(key -> count)`` over non-NULL keys (AGG-9).

    Counts per (group, key) first (partial aggregate), then collects the
    distinct keys of each group into a map: the map size is bounded by the
    number of distinct keys, not by rows.
    """
    counts = (df.where(F.col(key_col).isNotNull())
              .groupBy(*group_cols, key_col).agg(F.count(F.lit(1)).alias("__n")))
    return counts.groupBy(*group_cols).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key_col), F.col("__n"))))
        .alias(out_name))


def top_values(df: DataFrame, group_cols: Sequence[str], array_col: str, out_name: str,
               n: int = K.HOT_TAGS_N) -> DataFrame:
    """Per group: the ``n`` most frequent array elements, ties -> larger value first (AGG-10).

    explode -> count per (group, value) -> top-n per group (window group
    limit, applied map-side before the shuffle) -> ordered array.
    """
    exploded = (df.select(*group_cols, F.explode(array_col).alias("__v"))
                .where(F.col("__v").isNotNull() & (F.col("__v") != "")))
    counts = exploded.groupBy(*group_cols, "__v").agg(F.count(F.lit(1)).alias("__n"))
    top = top_n_per_group(counts, group_cols, [F.col("__n").desc(), F.col("__v").desc()], n,
                          rank_col=None)
    ordered = F.sort_array(F.collect_list(F.struct("__n", "__v")), asc=False)
    return top.groupBy(*group_cols).agg(
        F.slice(F.transform(ordered, lambda x: x["__v"]), 1, n).alias(out_name))


def share_of_total(df: DataFrame, within: Sequence[str], count_col: str, out_name: str,
                   scale: int = 2) -> DataFrame:
    """Percentage of each group's count in the total of its ``within`` partition (AGG-7).

    The input is already grouped (a handful of rows per partition), so the
    total is a window sum over that small frame rather than a second scan.
    """
    total = F.sum(count_col).over(Window.partitionBy(*within))
    return df.withColumn(out_name, pct(F.col(count_col), total, scale))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                   earliest: bool = False, total_order: bool = True, few: bool = False) -> DataFrame:
    """One row per key: the one with the greatest (or least) ``order_cols`` (AGG-11).

    ``row_number() = 1`` per key: Catalyst runs it as a WindowGroupLimit on
    both sides of the shuffle, so each task forwards at most one row per key
    and a hot key costs no more than a cold one.  With ``total_order`` one
    64-bit hash of the remaining columns breaks ties, so the pick is
    deterministic even when ``order_cols`` tie, and the sort stays narrow.

    ``few`` says that no key has many rows (versions of a listing).  Rows are then dealt out by key first and
    sorted once, in the tasks that pick; a pick before the shuffle would sort all rows of its task, wide as they
    are, to drop next to none, and a task that reads compressed columns or widens rows in a join has to spill them.
    A key that is hot after all costs its task a long, spilling sort.
    """
    if few:
        df = df.repartition(*[F.col(f"`{k}`") for k in keys])
    order = [F.col(c).asc() if earliest else F.col(c).desc() for c in order_cols]
    tie = row_tie(df, keys, order_cols) if total_order else None
    return top_n_per_group(df, keys, order if tie is None else [*order, tie.desc()], 1, rank_col=None)


def row_tie(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> Column | None:
    """One 64-bit hash of the columns beside ``keys`` and ``order_cols``, which tells rows that tie apart."""
    rest = [F.col(f"`{f.name}`") for f in df.schema.fields
            if f.name not in order_cols and f.name not in keys and not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*rest) if rest else None


def empty_map_if_null(col: str) -> Column:
    return F.coalesce(F.col(col), F.create_map().cast("map<string,bigint>")).alias(col)


def empty_array_if_null(col: str) -> Column:
    return F.coalesce(F.col(col), F.array().cast("array<string>")).alias(col)
