"""Text columns of wide rows packed for a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PACK, _END, _NULL = "__texts", "\x01", "\x02"


def text_columns(df: DataFrame, but: Sequence[str]) -> list[str]:
    """The columns that can be packed, without the ones of ``but`` (by which rows are dealt out or sorted)."""
    return [f.name for f in df.schema.fields if f.dataType == T.StringType() and f.name not in but]


def pack_texts(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """The text columns ``texts`` joined to one, to be moved: a row of Spark's has a length and an offset for each text, which
    differ from row to row, so that they compress worse than the texts themselves.

    ``unpack_texts`` gives the same values back.  A row with a text that has one of the two control characters
    which end a text or stand for NULL, or bytes that are no text, keeps its columns."""
    columns = [F.col(f"`{c}`") for c in texts]
    every = F.concat_ws("", *columns)
    joined = F.concat_ws(_END, *[F.coalesce(c, F.lit(_NULL)) for c in columns])
    packed = df.withColumn(_PACK, F.when(
        ~every.contains(_END) & ~every.contains(_NULL) & F.is_valid_utf8(every), joined))
    return packed.withColumns({c: F.when(F.col(_PACK).isNull(), F.col(f"`{c}`")) for c in texts})


def unpack_texts(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """The rows that ``pack_texts`` was given.  A text is split once, into a column of its own, for all that are in it."""
    parts = df.withColumn(_PACK, F.split(_PACK, _END, -1))
    return parts.withColumns({c: F.when(F.col(_PACK).isNull(), F.col(f"`{c}`")).when(F.get(_PACK, i) != _NULL, F.get(_PACK, i))
                              for i, c in enumerate(texts)}).drop(_PACK)
