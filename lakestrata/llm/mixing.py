"""Mixing sources to target weights by capped water-filling (DataFrame operations only).

Targets.  Every source gets ``weight`` shares of the total; a source cannot
give more than ``max_epochs`` times its own words.  Sources above that cap are
clamped, their excess is shared among the others by weight, and so on until
no source is above its cap.  Each round is one aggregate over the sources
table and moves two numbers to the driver; the clamped set only grows, so
the rounds end.

Sample.  A source with target ``t`` and ``s`` words takes every document
``floor(t / s)`` times and a seeded fraction once more: documents are ordered
by a seeded hash and taken while the middle of the document lies before the
remaining words, so a source misses its target by at most half a document.
The running sum is computed in two levels (4,096 hash ranges per source, then
inside a range), so no task ever sorts a whole source.

Edge cases: a null text has size 0; null sources form one source, last in
order; a null id hashes as the empty text; repeated rows are sampled one by
one; an empty table gives an empty result; a source without words has
target 0.  Documents of size 0 carry no words, whatever their repetitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, fresh, stage

WORDS = r"[^\x20\x09-\x0D]+"
RANGE_DIGITS = 3  # hex digits of the seeded hash that name a range: 4,096 ranges per source


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def seeded_hash(doc_id: Column, text: Column, seed: int) -> Column:
    """Place of a document in its source's order, from its id and text: rows that share an id (or have none) are
    spread over the ranges by their texts."""
    of_text = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), of_text)
                             .cast("binary")), 1, 16)


def source_key(source: Column) -> Column:
    """A key that is never null: ``n`` for null, ``s`` + the name otherwise."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def rank_sources(sources: DataFrame, key: str = "skey", source: str = "source") -> DataFrame:
    """Global 0-based ``rank`` by code point, null last, without one task sorting all sources:
    range partitions are counted, then numbered inside."""
    order = F.col(source).asc_nulls_last()
    part = stage(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    before = (part.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
              .select("part", "before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return (part.join(before, "part").withColumn("rank", F.col("before") + inside)
            .drop("part", "before"))


def water_fill(sources: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    """Add ``target`` to a table with ``size`` and ``weight`` per source."""
    cap = F.col("size") * F.lit(max_epochs)
    first = sources.agg(F.sum("size"), F.sum("weight")).first()
    total, share, over = first[0] or 0, first[1] or 0, None
    rest, level_share = total, share
    while share:
        level = rest / level_share if level_share else float("inf")
        capped = cap <= F.col("weight") * F.lit(float(level))
        row = sources.agg(F.sum(F.when(capped, F.col("size"))), F.sum(F.when(~capped, F.col("weight"))),
                          F.sum(capped.cast("long"))).first()
        if row[2] == over:
            break
        rest, level_share, over = total - max_epochs * (row[0] or 0), row[1] or 0, row[2]
    if not share:
        return sources.withColumn("target", F.lit(0.0))
    level = rest / level_share if level_share else float("inf")
    share_of = F.col("weight") * F.lit(float(rest)) / F.lit(float(level_share or 1))
    return sources.withColumn(
        "target", F.when(cap <= F.col("weight") * F.lit(float(level)), cap.cast("double")).otherwise(share_of))


def _assign(sized: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """``sized`` (source, skey, piece, h, size, ...) with target, source_size and copies."""
    carried = sized.columns
    pieces = stage(sized.groupBy("skey", "piece").agg(F.sum("size").alias("piece_size"),
                                                      F.max("source").alias("source")), "pieces")
    sources = pieces.groupBy("skey").agg(F.sum("piece_size").alias("size"), F.max("source").alias("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = rank_sources(sources).withColumn("weight", cycle[(F.col("rank") % len(weights)).cast("int")])
    targets = water_fill(stage(ranked, "ranked"), max_epochs).select(
        "skey", F.col("size").alias("source_size"), "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = (pieces.join(targets, "skey")
            .withColumn("before", F.sum("piece_size").over(Window.partitionBy("skey").orderBy("piece"))
                        - F.col("piece_size"))
            .withColumn("whole", whole.cast("long"))
            .withColumn("left_words", F.col("target") - F.col("whole") * F.col("source_size"))
            .select("skey", "piece", "before", "whole", "left_words", "source_size", "target"))
    run = Window.partitionBy("skey", "piece").orderBy("h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    start = F.col("before") + F.sum("size").over(run) - F.col("size")
    extra = (F.col("left_words") > 0) & (2 * start + F.col("size") <= 2 * F.col("left_words"))
    return (sized.join(plan, ["skey", "piece"])
            .withColumn("copies", F.col("whole") + F.when(extra, 1).otherwise(0))
            .select(*map(col, carried), "source_size", "target", "copies"))


def _keys(docs: DataFrame, seed: int) -> list[Column]:
    h = seeded_hash(F.col("doc_id"), F.col("text"), seed)
    return [source_key(F.col("source")).alias("skey"), F.substring(h, 1, RANGE_DIGITS).alias("piece"), h.alias("h")]


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3.0,
        seed: int = 42) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken words of every document."""
    sized = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *_keys(docs, seed)), "sized")
    return _assign(sized, weights, max_epochs).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3.0,
                    seed: int = 42) -> DataFrame:
    """The mixed corpus: each document row repeated as often as the mix takes it.

    All columns are carried inside one struct, so their names cannot clash."""
    (whole,) = fresh([], "row")
    sized = docs.select(F.struct(*map(col, docs.columns)).alias(whole), "doc_id", "source",
                        n_words(F.col("text")).alias("size"), *_keys(docs, seed))
    taken = _assign(sized, weights, max_epochs).where(F.col("copies") > 0)
    each = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return taken.select(whole, each.alias("copy")).select(
        *[F.col(whole).getField(c).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 16) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
         sum(w) OVER (ORDER BY 3.0 * source_size / w, w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM s WINDOW before AS (ORDER BY 3.0 * source_size / w, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT rest AS l_rest, share AS l_share FROM f
  WHERE 3 * source_size > w * CAST(rest AS DOUBLE) / CAST(share AS DOUBLE)
  ORDER BY 3.0 * source_size / w, w, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN l_rest IS NULL OR 3 * source_size <= w * (CAST(l_rest AS DOUBLE) / CAST(l_share AS DOUBLE))
              THEN CAST(3 * source_size AS DOUBLE)
              ELSE w * CAST(l_rest AS DOUBLE) / CAST(l_share AS DOUBLE) END AS target
  FROM s LEFT JOIN l ON true),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN target - whole * source_size > 0
                                  AND 2 * start + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
