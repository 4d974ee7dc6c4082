"""Ranking operators (WIN-1, WIN-2, TOP-1, TOP-2).

``top_n_per_group`` is ``row_number() <= n``: Catalyst inserts a
WindowGroupLimit on both sides of the shuffle, so each task forwards at most
``n`` rows per group and a hot group costs no more than a cold one.

``ranks_with_cutoff`` computes *exact* row numbers for every row whose rank
in any of several orderings is within a cutoff, without sorting a whole
partition group in one task:

1. candidates = union of the top-``cutoff`` rows of each ordering (group-limited),
   written once;
2. per group, the sorted candidate sort-keys form a small array per ordering
   (<= cutoff x orderings);
3. in one pass every row counts, per ordering, how many candidates sort at or
   before it (an interpreted array filter), and rows are histogrammed by
   (ordering, count);
4. candidate j's row number is 1 + the number of rows whose count is < j,
   read off the small per-group histogram array (no join of pairs).

Sort keys are null-free structs that encode the SQL null ordering
(ASC NULLS FIRST / DESC NULLS LAST), so struct comparison is the order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, write_staged

OrderSpec = Sequence[tuple[str, bool]]  # (column, ascending)


def top_n_per_group(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column],
                    n: int, rank_col: str | None = "rn") -> DataFrame:
    """Rows ranked 1..n per partition group by ``row_number`` (group-limited)."""
    w = Window.partitionBy(*partition_cols).orderBy(*order)
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def _orderings(spec: OrderSpec) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in spec]


def _sort_key(df: DataFrame, spec: OrderSpec) -> Column:
    """Null-free struct whose natural order equals ``ORDER BY spec``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for i, (c, asc) in enumerate(spec):
        col, dt = F.col(c), types[c]
        if isinstance(dt, T.StringType):
            zero = F.lit("")
        elif isinstance(dt, T.NumericType):
            zero = F.lit(0).cast(dt)
        else:
            raise TypeError(f"unsupported order column type {dt} for {c}")
        value = F.coalesce(col, zero)
        if asc:
            fields += [col.isNotNull().alias(f"n{i}"), value.alias(f"v{i}")]
        else:
            if not isinstance(dt, T.NumericType):
                raise TypeError(f"descending order needs a numeric column: {c}")
            fields += [col.isNull().alias(f"n{i}"), (-value).alias(f"v{i}")]
    return F.struct(*fields)


def ranks_with_cutoff(df: DataFrame, partition_cols: Sequence[str],
                      rankings: Mapping[str, OrderSpec], cutoff: int,
                      materialize_input: bool = True) -> DataFrame:
    """Rows ranked within ``cutoff`` by at least one ordering, with all their ranks.

    Equivalent to computing ``row_number() OVER (PARTITION BY p ORDER BY spec)``
    for every ranking and keeping rows where any rank <= cutoff.  Each spec
    must end in columns that make the order total (tie-breakers).

    The input is read twice (candidates, then one pass that places every row
    among them in all orderings), so it is checkpointed once (reliably, into
    the shared checkpoint folder) unless ``materialize_input=False`` (pass an
    already-written table).  The candidates, at most cutoff x orderings per
    group, are written once too; their joins are left to the planner, which
    then knows their size.
    """
    if materialize_input:
        df = cut_lineage(df)
    names, part = list(rankings), list(partition_cols)
    keys = {name: f"__k_{name}" for name in names}
    keyed = df.select("*", *[_sort_key(df, rankings[n]).alias(k) for n, k in keys.items()])
    first = keys[names[0]]
    tops = [top_n_per_group(keyed, part, _orderings(rankings[n]), cutoff, rank_col=None) for n in names]
    cands = write_staged(reduce(DataFrame.unionByName, tops).dropDuplicates(part + [first]), "rank-candidates")

    # NULL is a group of its own in PARTITION BY, so groups are joined null-safely
    def by_group(side: DataFrame, *aggs: Column) -> tuple[DataFrame, list[Column]]:
        own = [f"__g_{p}" for p in part]
        made = side.groupBy(*[F.col(p).alias(o) for p, o in zip(part, own)]).agg(*aggs)
        return made, [F.col(p).eqNullSafe(F.col(o)) for p, o in zip(part, own)]

    arrays, same = by_group(cands, *[F.array_sort(F.collect_list(k)).alias(f"__a{i}")
                                     for i, k in enumerate(keys.values())])
    # per ordering: how many candidates sort at or before the row
    place = [_count_at_or_before(f"__a{i}", k) for i, k in enumerate(keys.values())]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("o"), p.alias("le")) for i, p in enumerate(place)]))
    hist = (keyed.select(*part, *keys.values()).join(arrays, same).select(*part, each.alias("__p"))
            .groupBy(*part, "__p").agg(F.count(F.lit(1)).alias("__n")))
    counts, _ = by_group(hist, F.collect_list(F.struct("__p.o", "__p.le", F.col("__n").alias("n"))).alias("__h"))
    counts = counts.select(*[F.col(f"__g_{p}").alias(f"__c_{p}") for p in part], "__h")
    same_counts = [F.col(p).eqNullSafe(F.col(f"__c_{p}")) for p in part]
    placed = cands.join(arrays, same).select(*cands.columns, *[p.alias(f"__j{i}") for i, p in enumerate(place)])
    ranks = [_rows_before(i).alias(n) for i, n in enumerate(names)]
    return placed.join(counts, same_counts).select(*[F.col(f"`{c}`") for c in df.columns], *ranks)


def _count_at_or_before(array: str, key: str) -> Column:
    return F.size(F.filter(array, lambda c: c <= F.col(key)))


def _rows_before(i: int) -> Column:
    """1 + the rows of ordering ``i`` with fewer candidates at or before them than the candidate has."""
    below = F.filter("__h", lambda h: (h["o"] == i) & (h["le"] < F.col(f"__j{i}")))
    return (F.aggregate(below, F.lit(0).cast("long"), lambda n, h: n + h["n"]) + 1).cast("int")
