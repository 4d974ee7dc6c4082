"""Nested listing message <-> flat ODS rows (PRJ-1, PRJ-2, FIL-5).

Pure projections: struct construction followed by field access is folded
away by the optimizer, so a nest/flatten round trip costs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CORE_DATA, HEADER, ODS_LISTING_COLUMNS


def to_listing_message(flat: DataFrame) -> DataFrame:
    """Flat listing fields -> ``header`` / ``core_data`` / ``ext_attributes`` structs."""
    cols = set(flat.columns)

    def pick(name, dtype):
        return (F.col(name) if name in cols else F.lit(None)).cast(dtype).alias(name)

    header = F.struct(*[pick(f.name, f.dataType) for f in HEADER.fields])
    core = F.struct(*[pick(f.name, f.dataType) for f in CORE_DATA.fields])
    ext = F.struct(
        pick("tags", "array<string>"),
        F.struct(pick("attention_count", "int"), pick("visit_30_days", "int")).alias("follow_info"),
        pick("subway_info", "string"),
        F.struct(pick("p1_desc", "string"), pick("p2_desc", "string")).alias("raw_info"),
    )
    return flat.select(header.alias("header"), core.alias("core_data"), ext.alias("ext_attributes"))


def flatten_listing(nested: DataFrame, with_etl_time: bool = True) -> DataFrame:
    """Nested message -> flat ODS row; rows without ``house_id`` are dropped.

    ``raw_info.p1_desc``/``p2_desc`` become ``raw_p1_desc``/``raw_p2_desc``;
    ``etl_time`` is the load time stamp (omit it for reproducible output).
    Columns beside the message (where and when it arrived) are kept at the end.
    """
    h, c, e = "header", "core_data", "ext_attributes"
    beside = [n for n in nested.columns if n not in (h, c, e)]
    core_fields = [f.name for f in CORE_DATA.fields if f.name != "house_id"]
    out = nested.where(F.col(f"{c}.house_id").isNotNull()).select(
        F.col(f"{c}.house_id").alias("house_id"),
        *[F.col(f"{h}.{n}").alias(n) for n in ("source", "event_time", "version", "trace_id",
                                                "batch_id")],
        *[F.col(f"{c}.{n}").alias(n) for n in core_fields],
        F.col(f"{e}.tags").alias("tags"),
        F.col(f"{e}.follow_info.attention_count").alias("attention_count"),
        F.col(f"{e}.follow_info.visit_30_days").alias("visit_30_days"),
        F.col(f"{e}.subway_info").alias("subway_info"),
        F.col(f"{e}.raw_info.p1_desc").alias("raw_p1_desc"),
        F.col(f"{e}.raw_info.p2_desc").alias("raw_p2_desc"),
        F.current_timestamp().alias("etl_time"),
        *[F.col(n) for n in beside],
    )
    ordered = [c for c in ODS_LISTING_COLUMNS if c in out.columns] + beside
    out = out.select(*ordered)
    return out if with_etl_time else out.drop("etl_time")


def parse_listing_json(values: DataFrame, value_col: str = "value",
                       mode: str = "PERMISSIVE") -> DataFrame:
    """JSON text -> nested message (SRC-3).

    PERMISSIVE: a field of the wrong type becomes NULL, a wholly broken
    record becomes a struct of NULLs (removed later by the ``house_id``
    filter).  FAILFAST makes a bad record fail the job.  Other columns are kept.

    A message is a row made by a generator, so that a filter on its fields stays above the parser: put below,
    as into a join that the text is made from, it would build and parse every text a second time.
    """
    from ..schemas import LISTING_MESSAGE
    parsed = F.from_json(F.col(value_col), LISTING_MESSAGE, {"mode": mode})
    beside = [c for c in values.columns if c != value_col]
    return values.select(*beside, F.inline(F.array(parsed))).select(*LISTING_MESSAGE.fieldNames(), *beside)
