"""Data-quality operators: contract validation, defaults, de-duplication (DQ-*, PRJ-18)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from .aggregate import latest_per_key

# Contract of the listing producer (field names follow the stream schema).
# Required strings may be empty but not absent; counts and years may be absent but, if given, are integers.
REQUIRED_STRINGS = ("source", "house_id", "house_url", "city", "district", "community")
REQUIRED_NUMBERS = ("total_price", "unit_price", "area_sqm")
OPTIONAL_INTEGERS = ("event_time", "room_num", "hall_num", "bathroom_num", "floor_total", "build_year")
COUNT_DEFAULTS = {"room_num": 0, "hall_num": 0, "bathroom_num": 0, "floor_total": 0}
CONTRACT_TYPES = {"total_price": "double", "unit_price": "double", "area_sqm": "double",
                  "room_num": "int", "hall_num": "int", "bathroom_num": "int",
                  "floor_total": "int", "build_year": "int"}
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _checks(required_strings: Sequence[str], required_numbers: Sequence[str], optional_integers: Sequence[str],
            schema: T.StructType | None = None) -> list:
    """The reason of every rule for the current row, null where it is kept.

    A column that ``schema`` declares as a number of the rule's kind holds one wherever it is not null: no value is
    written out as text and read again to find that."""
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in required_strings]
    for c in required_numbers:
        numeric = isinstance(types.get(c), (T.FloatType, T.DoubleType, *WHOLE))
        number = F.col(c) if numeric else F.col(c).cast("string").try_cast("double")
        checks.append(F.when(number.isNull(), F.lit(f"not_numeric:{c}")))
    for c in optional_integers:
        if not isinstance(types.get(c), WHOLE):
            checks.append(F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("long").isNull(),
                                 F.lit(f"not_integer:{c}")))
    return checks


def rejection_reasons(required_strings: Sequence[str] = REQUIRED_STRINGS,
                      required_numbers: Sequence[str] = REQUIRED_NUMBERS,
                      optional_integers: Sequence[str] = OPTIONAL_INTEGERS):
    """``array<string>`` of failed rules for the current row (empty when valid)."""
    return _listed(_checks(required_strings, required_numbers, optional_integers))


def _listed(checks: list):
    """The reasons that are given.  Only a row that fails a rule makes a list of all of them."""
    failed = F.coalesce(*checks, F.lit(None).cast("string"))
    return F.when(failed.isNotNull(), F.filter(F.array(*checks), lambda x: x.isNotNull())).otherwise(
        F.array().cast("array<string>"))


def with_reasons(df: DataFrame, required_strings: Sequence[str] = REQUIRED_STRINGS,
                 required_numbers: Sequence[str] = REQUIRED_NUMBERS,
                 reasons_col: str = "reasons") -> DataFrame:
    """Rows with the rules they fail; optional integers are checked where the frame has them.

    Streams keep this column and split inside ``foreachBatch``: a filter on all rules at once, over columns
    that are fields of one parsed message, makes the optimizer infer a constraint for every combination of them.
    """
    given = [c for c in OPTIONAL_INTEGERS if c in df.columns]
    return df.withColumn(reasons_col, _listed(_checks(required_strings, required_numbers, given, df.schema)))


def validate(df: DataFrame, required_strings: Sequence[str] = REQUIRED_STRINGS,
             required_numbers: Sequence[str] = REQUIRED_NUMBERS,
             reasons_col: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """Split into (valid rows, rejected rows + ``reasons``) (DQ-1).

    Rows are told apart by the first rule they fail, which stops there and makes no array; only
    rejected rows get the list of all.  Nothing is collected.
    """
    given = [c for c in OPTIONAL_INTEGERS if c in df.columns]
    failed = F.coalesce(*_checks(required_strings, required_numbers, given, df.schema), F.lit(None).cast("string"))
    rejected = with_reasons(df.where(failed.isNotNull()), required_strings, required_numbers, reasons_col)
    return df.where(failed.isNull()), rejected


def apply_contract(df: DataFrame, types: Mapping[str, str] = CONTRACT_TYPES,
                   defaults: Mapping[str, object] = COUNT_DEFAULTS,
                   array_defaults: Sequence[str] = ("tags",),
                   version_col: str | None = "version") -> DataFrame:
    """Coerce to the contract types (``try_cast``) and fill defaults (PRJ-18).

    Columns the frame has: counts 0, lists and the ``raw_info`` map empty, the version; a missing
    ``event_time`` is the time of the load, a missing ``trace_id`` an id of UUID form made from the
    row as it came, so that a retried task gives it again.
    """
    out = df
    if "trace_id" in out.columns:
        row = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).cast("binary"))
        form = F.concat_ws("-", *[F.substring(row, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
        out = out.withColumn("trace_id", F.coalesce("trace_id", form))
    if "event_time" in out.columns:
        out = out.withColumn("event_time", F.coalesce("event_time", F.unix_seconds(F.current_timestamp())))
    if "raw_info" in out.columns and isinstance(df.schema["raw_info"].dataType, T.MapType):
        out = out.withColumn("raw_info", F.coalesce("raw_info", F.create_map().cast(df.schema["raw_info"].dataType)))
    for c, t in types.items():
        if c in out.columns:
            out = out.withColumn(c, F.col(c).try_cast(t))
    for c, v in defaults.items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(types.get(c, "int"))))
    for c in array_defaults:
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.array().cast("array<string>")))
    if version_col and version_col in out.columns:
        out = out.withColumn(version_col, F.coalesce(F.col(version_col), F.lit(K.DEFAULT_VERSION)))
    return out


def dedupe_first(df: DataFrame, key: Sequence[str] | str, order_cols: Sequence[str],
                 total_order: bool = True) -> DataFrame:
    """First-write-wins: keep the earliest row per key (DQ-2, batch form)."""
    keys = [key] if isinstance(key, str) else list(key)
    return latest_per_key(df, keys, order_cols, earliest=True, total_order=total_order)


def anti_delivered(df: DataFrame, delivered: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Drop rows whose key was delivered by an earlier run (DQ-3, JOIN-5)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(delivered.select(*keys), keys, "left_anti")


def city_blacklist(df: DataFrame, cities: Sequence[str] = K.CITY_BLACKLIST,
                   col: str = "city") -> DataFrame:
    """``city NOT IN (...)``; NULL cities are dropped too, as in SQL (FIL-1)."""
    return df.where(~F.col(col).isin(list(cities)))
