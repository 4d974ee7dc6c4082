"""Incremental compaction of partitioned Parquet tables (SNK-7, SNK-8).

``compact`` looks at the file listing only, picks small files that can be
merged, packs them into bins of about the target size within their
partition, and rewrites each bin to one file.  Other files, and partitions with
nothing to merge, are not touched or read.

Streams write loads (``load_id`` partitions, ``streaming.sinks``).  Loads of one
partition are merged into one; the newest load of every query is left alone,
because it is the only one that a retried batch may still replace.  So compaction
runs beside the streams that write to the table.

A change log (upserts) is folded by the same job: with ``keys`` only the latest
row per key of the picked files is kept.  Any subset of files may be folded,
readers pick the latest row of what is left.

Swap.  The new files are written to ``_compact/<job>/data`` below the table (hidden from
readers) after the list of files they replace.  Once both are committed
(``_SUCCESS``), new files are moved in and old ones deleted; a job that died in
between is finished by ``recover`` (``compact`` calls it first), one that died
earlier is dropped.  Every step may be repeated.  Between the moves and the deletions a reader
can see rows twice, and a reader that listed files before may fail on a
deleted one; table formats with snapshots have their own compaction.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators.aggregate import latest_per_key
from .files import is_table, location, write_unsorted

LOAD_COL = "load_id"
JOBS = "_compact"
SMALL = 0.75                 # of the target: smaller files are merged
FILES_A_JOB = 10_000         # files planned at once; the job repeats until nothing is left


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _strings_session(spark: SparkSession) -> SparkSession:
    """A session of its own that reads partition values as the strings they are in folder names."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return own


def _files(session: SparkSession, path: str) -> DataFrame:
    """One row per data file: path, size, partition columns (from the listing, contents are not read)."""
    return (session.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
            .select("*", F.col("_metadata.file_path").alias("uri")).drop("content", "modificationTime"))


def _pick(files: DataFrame, parts: Sequence[str], target_bytes: int, everything: bool) -> DataFrame:
    """Files to merge: path, uri, partition, bin (number inside the partition) and bins (of the partition)."""
    has_load = LOAD_COL in files.columns
    if has_load:
        query = F.regexp_extract(LOAD_COL, r"^(.*)-\d{10}$", 1)
        newest = F.max(LOAD_COL).over(Window.partitionBy("query"))
        open_load = (F.col("query") != "") & (F.col(LOAD_COL) == F.col("newest"))
        loads = (files.select(LOAD_COL).distinct().withColumn("query", query).withColumn("newest", newest)
                 .where(open_load).select(LOAD_COL))
        files = files.join(loads, LOAD_COL, "left_anti")
    if not everything:
        files = files.where(F.col("length") < SMALL * target_bytes)
    # a key of the partition that is never null
    one = F.to_json(F.struct(*[F.col(f"`{c}`") for c in parts])) if parts else F.lit("")
    of_part = Window.partitionBy("part")
    before = F.sum("length").over(of_part.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    sized = files.withColumn("part", one).select(
        "path", "uri", "part", F.count(F.lit(1)).over(of_part).alias("n"),
        F.greatest(F.lit(1), F.ceil(F.sum("length").over(of_part) / target_bytes)).cast("int").alias("bins"),
        F.floor(F.coalesce(before, F.lit(0)) / target_bytes).cast("int").alias("bin"))
    return sized.where("n > bins").drop("n").orderBy("part", "bin", "path").limit(FILES_A_JOB)


def compact(spark: SparkSession, path: str, partition_cols: Sequence[str] | str = (),
            target_bytes: int = K.TARGET_FILE_BYTES, keys: Sequence[str] = (), order_by: Sequence[str] = (),
            everything: bool = False) -> int:
    """Merge the small files of a folder or catalog table into files of about ``target_bytes``.

    The partition columns are those of the folder names; ``partition_cols`` only has to name some of them.  With
    ``keys`` and ``order_by`` the picked files are folded to the latest row per key; ``everything`` picks
    large files too.  Returns the number of files written.
    """
    table, path = path, location(spark, path) if is_table(path) else path.rstrip("/")
    recover(spark, path)
    session, written = _strings_session(spark), 0
    while _exists(spark, path):
        files = _files(session, path)
        parts = [c for c in files.columns if c not in ("path", "length", "uri", LOAD_COL)]
        unknown = set([partition_cols] if isinstance(partition_cols, str) else partition_cols) - set(files.columns)
        if unknown and files.take(1):
            raise ValueError(f"{path} is not partitioned by {sorted(unknown)}")
        job = uuid.uuid4().hex
        picked = _pick(files, parts, target_bytes, everything).toPandas()   # at most FILES_A_JOB rows
        if picked.empty:
            break
        folder = os.path.join(path, JOBS, job)
        written += _rewrite(session, path, folder, job, picked, parts, LOAD_COL in files.columns, keys, order_by)
        finish(spark, path, folder)
        if everything:
            break
    if table != path and written:
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
    return written


def _rewrite(session, path, folder, job, picked, parts, has_load, keys, order_by) -> int:
    # declared types: those inferred from pandas depend on whether Arrow is on
    plan = session.createDataFrame(picked[["path", "uri", "part", "bin", "bins"]],
                                   "path string, uri string, part string, bin int, bins int")
    plan.select("path").write.text(os.path.join(folder, "remove"))
    # numbers of the bins over all partitions
    starts = picked.groupby("part", sort=True)["bins"].first().cumsum()
    first = session.createDataFrame([(p, int(e - b)) for (p, e), b in zip(
        starts.items(), picked.groupby("part", sort=True)["bins"].first())], "part string, start int")
    of_file = F.broadcast(plan.join(first, "part").select("uri", "bin", "bins", "start"))   # at most FILES_A_JOB rows
    rows = (session.read.option("basePath", path).option("mergeSchema", "true").parquet(*picked["path"])
            .withColumn("uri", F.col("_metadata.file_path")))
    columns = [c for c in rows.columns if c not in ("uri", LOAD_COL)]
    rows = rows.join(of_file, "uri").select(*columns, "bin", "bins", "start")
    number = F.col("start") + F.col("bin")
    bins = int(picked.groupby("part")["bins"].first().sum())
    if keys:
        number = F.col("start") + F.pmod(F.xxhash64(*keys), F.col("bins")).cast("int")
        if set(parts) <= set(keys):
            # rows of a key have one partition and so one bin: dealt out once, the latest is picked in the bin's task
            dealt = rows.select(*columns, number.alias("__bin")).repartitionById(bins, F.col("__bin"))
            out = latest_per_key(dealt, ["__bin", *keys], order_by).select(*columns)
        else:
            out = latest_per_key(rows.drop("bin"), keys, order_by, few=True).repartitionById(bins, number).select(*columns)
    else:
        out = rows.repartitionById(bins, number).select(*columns)
    by = list(parts)
    if has_load:
        out, by = out.withColumn(LOAD_COL, F.lit(f"compact-{job}")), [*by, LOAD_COL]
    write_unsorted(session)
    w = out.write.option("compression", "zstd").mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*by) if by else w).parquet(os.path.join(folder, "data"))
    return _files(session, os.path.join(folder, "data")).count()


def finish(spark: SparkSession, path: str, folder: str) -> None:
    """Swap in a committed job: move its files into the table, delete what they replace, drop the job."""
    data = os.path.join(folder, "data")
    fs, root = _fs(spark, data)
    base = fs.makeQualified(root).toString()
    moved = fs.listFiles(root, True)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    while moved.hasNext():
        source = moved.next().getPath()
        inner = source.toString()[len(base) + 1:]
        if inner.startswith("_") or not inner.endswith(".parquet"):
            continue
        target = Path(os.path.join(path, inner))
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target) and not fs.exists(target):
            raise OSError(f"cannot move {source} to {target}")
    for row in spark.read.text(os.path.join(folder, "remove")).toLocalIterator():
        old = Path(row[0])
        fs.delete(old, False)
        parent = old.getParent()
        if parent.getName().startswith(f"{LOAD_COL}=") and fs.exists(parent) and not any(
                s.getPath().getName().endswith(".parquet") for s in fs.listStatus(parent)):
            fs.delete(parent, True)
    fs.delete(Path(folder), True)


def recover(spark: SparkSession, path: str) -> int:
    """Finish committed compaction jobs that died in the swap, drop the others; returns how many were finished."""
    jobs, done = os.path.join(path, JOBS), 0
    if not _exists(spark, jobs):
        return 0
    fs, p = _fs(spark, jobs)
    for s in fs.listStatus(p):
        folder = s.getPath().toString()
        if all(_exists(spark, os.path.join(folder, x, "_SUCCESS")) for x in ("remove", "data")):
            finish(spark, path, folder)
            done += 1
        else:
            _delete(spark, folder)
    return done
