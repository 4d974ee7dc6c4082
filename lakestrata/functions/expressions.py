"""Column expressions for the projection operators (all built-in, codegen'd).

Every function takes and returns ``Column`` objects so the expressions stay
inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

_EPOCH = "1970-01-01 00:00:00"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_to_ntz(col, tz: str | None = "UTC") -> Column:
    """Epoch seconds -> wall-clock TIMESTAMP_NTZ in ``tz``.

    With ``tz=None`` the session time zone is used (what ``from_unixtime``
    does); with an explicit zone the result does not depend on the session.
    """
    c = _c(col)
    if tz is None:
        return F.timestamp_seconds(c).cast("timestamp_ntz")
    utc = F.timestamp_add("SECOND", c, F.to_timestamp_ntz(F.lit(_EPOCH)))
    if tz.upper() == "UTC":
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def ds_from_epoch(col, tz: str | None = "UTC", fmt: str = "yyyyMMdd") -> Column:
    """Partition key ``yyyyMMdd`` from epoch seconds (PRJ-3)."""
    c = _c(col)
    if tz is None:
        return F.from_unixtime(c, fmt)
    return F.date_format(epoch_to_ntz(c, tz), fmt)


def epoch_to_string(col, tz: str | None = "UTC",
                    fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Readable local time of epoch seconds (PRJ-12)."""
    return ds_from_epoch(col, tz, fmt)


def null_if(col, sentinel: str = K.DISTRICT_SENTINEL) -> Column:
    """Sentinel value -> NULL (PRJ-4)."""
    c = _c(col)
    return F.when(c == F.lit(sentinel), F.lit(None).cast("string")).otherwise(c)


def floor_ratio(col, ratios: Mapping[str, float] = K.FLOOR_RATIOS,
                default: float = K.FLOOR_RATIO_DEFAULT) -> Column:
    """Ordinal floor label -> ratio; unknown and NULL give ``default`` (PRJ-5)."""
    c = _c(col)
    out = None
    for label, ratio in ratios.items():
        out = (F.when(c == label, F.lit(float(ratio))) if out is None
               else out.when(c == label, F.lit(float(ratio))))
    return out.otherwise(F.lit(float(default))).cast("double")


def ring_road(col, pattern: str = K.RING_ROAD_PATTERN) -> Column:
    """First ring-road mention; '' when absent, NULL for NULL (PRJ-6)."""
    return F.regexp_extract(_c(col), pattern, 1)


def room_type(room, hall, bath) -> Column:
    """``room-hall-bath`` key; NULL if any part is NULL (PRJ-7, ``concat``)."""
    return F.concat(_c(room).cast("string"), F.lit("-"), _c(hall).cast("string"),
                    F.lit("-"), _c(bath).cast("string"))


def bucketize(col, edges: Sequence, labels: Sequence[str],
              null_label: str | None = None) -> Column:
    """Half-open numeric buckets as one searched CASE (PRJ-8/9).

    ``labels`` has one more entry than ``edges``.  Without ``null_label`` a
    NULL input falls through to the last label, exactly like the SQL
    ``CASE WHEN x < e1 .. ELSE last END``; with it, NULL gets ``null_label``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have len(edges) + 1 entries")
    c = _c(col)
    out = F.when(c < F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        out = out.when(c < F.lit(edge), F.lit(label))
    if null_label is None:
        return out.otherwise(F.lit(labels[-1]))
    return out.when(c >= F.lit(edges[-1]), F.lit(labels[-1])).otherwise(F.lit(null_label))


def price_range(col) -> Column:
    return bucketize(col, K.PRICE_EDGES, K.PRICE_LABELS)


def year_segment(col) -> Column:
    return bucketize(col, K.YEAR_EDGES, K.YEAR_LABELS, null_label=K.YEAR_UNKNOWN)


def parse_event_time(col, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Wall-clock text -> TIMESTAMP; unparsable text gives NULL instead of failing (PRJ-10).

    The text is read as a wall clock without any zone (``to_timestamp_ntz``,
    reached only for text that parses, so ANSI mode never raises) and turned
    into the instant whose UTC reading is that wall clock.  Watermarks need
    an instant; reading the wall clock as UTC makes 10-minute windows, dates
    and outputs independent of the session time zone and of DST.  Use
    ``instant_to_wall`` to write the wall clock back out.
    """
    c = _c(col)
    wall = F.when(F.try_to_timestamp(c, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))
    return wall_to_instant(wall)


def wall_to_instant(col) -> Column:
    """TIMESTAMP_NTZ wall clock -> TIMESTAMP whose UTC reading is that wall clock
    (second precision, as the source text)."""
    return F.timestamp_seconds(F.unix_timestamp(_c(col)))


def instant_to_wall(col) -> Column:
    """Inverse of ``wall_to_instant``: the UTC reading as TIMESTAMP_NTZ."""
    return epoch_to_ntz(F.unix_seconds(_c(col)), "UTC")


def event_date(col) -> Column:
    """Event instant -> DATE of its wall clock (PRJ-11)."""
    return F.to_date(instant_to_wall(col))


def funnel_step(col, steps: Mapping[str, str] = K.FUNNEL_STEPS) -> Column:
    """Behaviour -> funnel step label, NULL for anything else (PRJ-14)."""
    c = _c(col)
    out = None
    for behaviour, label in steps.items():
        out = (F.when(c == behaviour, F.lit(label)) if out is None
               else out.when(c == behaviour, F.lit(label)))
    return out


def pct(n, total, scale: int = 2) -> Column:
    """``ROUND(n * 100.0 / total, scale)`` in exact decimal arithmetic, as double (PRJ-15)."""
    ratio = _c(n) * F.lit(Decimal("100.0")) / _c(total)
    return F.round(ratio, scale).cast("double")


def ts_in_range(col, lo: int = K.TS_MIN, hi: int = K.TS_MAX) -> Column:
    """Integer-parsable and inside ``[lo, hi]`` (FIL-10)."""
    v = _c(col).try_cast("long")
    return v.isNotNull() & v.between(lo, hi)
