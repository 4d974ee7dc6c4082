"""Helpers shared by the training-data operators.

Row identity.  Operators that decide about documents never assume that
``doc_id`` is unique or present: a row is addressed by ``doc_id`` plus a
64-bit hash of the columns its decision depends on (``row_key``), compared
null-safely.  Equal rows therefore always get equal decisions.

Written tables.  ``stage`` writes a table into the shared checkpoint folder
and reads it back: lineage is cut, nothing is kept in executor memory, and a
lost executor costs at most the tasks it was running.  ``release`` removes
the folders once a job's outputs are written.
"""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_STAGED: dict[str, list[str]] = {}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (as ``--py-files`` does) unless it is on their path already."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, app = os.path.dirname(package), spark.sparkContext.applicationId
    if app in _SHIPPED or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="lakestrata-py-"), "lakestrata.zip")  # read by the driver only
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def with_package(fn: Callable) -> Callable:
    """``fn(spark, ...)``, with the package shipped first."""
    @functools.wraps(fn)
    def run(spark, *args):
        ship_package(spark)
        return fn(spark, *args)
    return run


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove every table this application staged; call it after the results are written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _STAGED.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names that clash with none of ``taken`` (case-insensitively)."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(cols: Sequence[str]) -> Column:
    """Hash of the columns a decision depends on, nulls told apart from empty strings."""
    parts = [x for c in cols for x in (col(c), col(c).isNull())]
    return F.xxhash64(*parts)


def whole_row_key(df: DataFrame) -> Column:
    """Hash of a whole row; columns that hold maps, which have no hash of their own, by their JSON."""
    return F.xxhash64(*[F.to_json(F.struct(col(f.name))) if "map<" in f.dataType.simpleString() else x
                        for f in df.schema.fields for x in (col(f.name), col(f.name).isNull())])


def filter_by_rows(docs: DataFrame, rows: DataFrame, key_cols: Sequence[str], keep: bool) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, row_key) occurs (``keep``) or does not occur in ``rows``.

    ``rows`` has columns ``doc_id`` and ``row_hash``.
    """
    d, h = fresh(docs.columns, "rows_doc", "rows_hash")
    side = rows.select(F.col("doc_id").alias(d), F.col("row_hash").alias(h))
    cond = col("doc_id").eqNullSafe(F.col(d)) & (row_key(key_cols) == F.col(h))
    return docs.join(side, cond, "left_semi" if keep else "left_anti").select(*map(col, docs.columns))


def text_slices(batch, column: str = "text", rows: int = 4096, limit: int = 8 << 20) -> Iterator:
    """Consecutive slices of an Arrow batch with at most ``rows`` rows and about ``limit`` bytes of text."""
    import numpy as np
    import pyarrow.compute as pc
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(size, dtype=np.int64), 0
    while at < len(total):
        done = total[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(total, done + limit, side="right"))))
        yield batch.slice(at, end - at)
        at = end


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id's text modulo ``m`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m
