"""Streaming sinks: idempotent loads, keyed upserts, de-duplication (SNK-3/4/6, STR-3/7/8).

Loads.  Every sink writes a micro-batch as one *load*: a partition
``load_id=<query id>-<batch id>`` below the table's own partitions, replaced
by a dynamic overwrite.  A retried batch replaces its own rows; a query that
starts on a fresh checkpoint has a new query id, so it never touches rows that
another run delivered.  ``sinks.compaction`` merges the loads of a partition
while streams go on writing.

Upserts.  A folder is upserted by appending changes: a batch is reduced to
its latest row per key and written as a load, so what a batch reads and writes
depends on the batch alone.  ``read_upserted`` picks the latest row per key on
read, and the compaction job folds old changes in.  Catalog tables of formats
with row-level operations are merged instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.aggregate import latest_per_key, row_tie
from ..operators.texts import pack_texts, text_columns, unpack_texts
from ..session import session_conf
from ..sinks.files import InPlace, is_table, overwrite_partitions
from ..sources.batch import ensure_table

LOAD_COL = "load_id"

# While a query starts that keeps a key per row for good (``first_per_key_stream``): its sort is let through, and its keys
# lie on the executors' disks.  Spark's default state store holds them on the heap, about 175 bytes each.
_STATE = "spark.sql.streaming.stateStore."
KEYED_CONF = {
    "spark.sql.streaming.unsupportedOperationCheck": "false",
    _STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STATE + "rocksdb.trackTotalNumberOfRows": "false",  # else every key is looked up once more as it is put
}


def load_name(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch that no other batch of any query has, and that a retry gets again.

    The query id is Spark's: it is kept in the checkpoint and is new on a fresh one."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query or 'batch'}-{batch_id:010d}"


def write_load(df: DataFrame, target: str, load: str, partition_by: Sequence[str] = (), columns: type = list) -> None:
    """Write ``df`` as one load of a folder or catalog table (SNK-3, SNK-6)."""
    overwrite_partitions(df.withColumn(LOAD_COL, F.lit(load)), target, by=columns([*partition_by, LOAD_COL]))


def ensure_load_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create a catalog table that streams can write loads to, if it is absent."""
    columns = T.StructType([*schema.fields, T.StructField(LOAD_COL, T.StringType())])
    ensure_table(spark, name, columns, [*partition_by, LOAD_COL])


def _columns(partition_by: Sequence[str] | str | None) -> list[str]:
    return [partition_by] if isinstance(partition_by, str) else list(partition_by or ())


def each_batch(df: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None,
               name: str | None = None, sorts: bool = False) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``run``.

    ``sorts`` is for a stream that sorts the tasks of a micro-batch (``first_per_key_stream``): Spark takes any sort for one
    of the whole endless stream, and refuses it when the query starts.  Its state is kept on disk (``KEYED_CONF``; a query
    restarted on its checkpoint keeps the store it was started with)."""
    w = df.writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    with ExitStack() as settings:
        for key, value in KEYED_CONF.items() if sorts else ():
            settings.enter_context(session_conf(df.sparkSession, key, value))
        return w.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def append_stream(df: DataFrame, target: str, checkpoint: str,
                  partition_by: Sequence[str] | str | None = None, trigger: dict | None = None,
                  name: str | None = None, sorts: bool = False) -> StreamingQuery:
    """Append every batch to a folder or catalog table as a load; windowed aggregates emit
    each window once, after the watermark closes it."""
    parts = _columns(partition_by)
    if is_table(target):
        ensure_load_table(df.sparkSession, target, df.schema, parts)
    return each_batch(df, lambda batch, i: write_load(batch, target, load_name(batch, i), parts), checkpoint, trigger, name,
                      sorts)


def batch_fanout(df: DataFrame, outputs: dict, partition_by: Sequence[str],
                 checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """One source read, several stateless sinks (SNK-5).

    ``outputs`` maps a folder or catalog table to a ``DataFrame -> DataFrame``
    function.  Each micro-batch is persisted once and written to every
    target as the same load, so a retried batch replaces its own rows everywhere.
    """
    for target, fn in outputs.items():
        if is_table(target):
            ensure_load_table(df.sparkSession, target, fn(df).schema, partition_by)

    def run(batch, batch_id):
        load = load_name(batch, batch_id)
        batch = batch.persist()
        try:
            for target, fn in outputs.items():
                write_load(fn(batch), target, load, partition_by)
        finally:
            batch.unpersist()
    return each_batch(df, run, checkpoint, trigger)


# ----------------------------------------------------------------- upserts --

def upsert_batch(batch: DataFrame, batch_id: int, target: str, keys: Sequence[str],
                 order_by: Sequence[str], partition_by: Sequence[str]) -> None:
    """Upsert one micro-batch: last write per key wins.

    Into a folder, the batch's latest row per key is appended as a load; nothing that is
    there is read or rewritten.  Into a catalog table it is merged with ``MERGE INTO``.

    Rows are dealt out once, by key, and written where they were picked: adaptive execution has sized those tasks
    already, so a load has at most one file per task and partition, which compaction merges.  Without it
    the tasks are many and small, and rows are brought together by partition before the write.
    """
    if is_table(target):
        merge_batch(batch, batch_id, target, keys, order_by)
        return
    sized = batch.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    write_load(latest_per_key(batch, keys, order_by, few=True), target, load_name(batch, batch_id), partition_by,
               InPlace if sized else list)


def read_upserted(spark: SparkSession, target: str, keys: Sequence[str], order_by: Sequence[str],
                  schema: T.StructType | None = None, total_order: bool = True) -> DataFrame:
    """The rows of an upserted folder: of all changes, the latest row per key.

    A filter on key columns is pushed below the pick, so partitions that are part of the key (city) are pruned.
    The hash that tells ties apart is made by the scan: the shuffle carries no column that only the hash needs."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    changes = reader.parquet(target)
    columns = schema.fieldNames() if schema is not None else [c for c in changes.columns if c != LOAD_COL]
    changes = changes.select(*columns)
    tie, order = row_tie(changes, keys, order_by) if total_order else None, list(order_by)
    if tie is not None:
        changes, order = changes.withColumn("__tie", tie), [*order, "__tie"]
    return latest_per_key(changes, keys, order, total_order=False, few=True).select(*columns)


def merge_sql(table: str, view: str, keys: Sequence[str], order_by: Sequence[str]) -> str:
    """``MERGE INTO`` by null-safe key equality; an existing row is replaced only by one that is not older."""
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    newer = (f"struct({', '.join(f's.`{c}`' for c in order_by)}) >= "
             f"struct({', '.join(f't.`{c}`' for c in order_by)})")
    return (f"MERGE INTO {table} t USING {view} s ON {on} WHEN MATCHED AND {newer} THEN UPDATE SET * "
            f"WHEN NOT MATCHED THEN INSERT *")


def merge_batch(batch: DataFrame, batch_id: int, table: str, keys: Sequence[str],
                order_by: Sequence[str]) -> None:
    """Upsert one micro-batch into a catalog table with ``MERGE INTO``.

    For table formats with row-level operations (Iceberg, Delta): the batch
    is reduced to its latest row per key, then merged, so replaying a batch
    changes nothing.  Plain Parquet tables cannot merge; use a folder for them.
    """
    spark = batch.sparkSession
    view = f"lakestrata_upsert_{abs(hash(table))}_{batch_id}"
    latest_per_key(batch, keys, order_by).createOrReplaceTempView(view)
    try:
        spark.sql(merge_sql(table, view, keys, order_by))
    except Exception as e:  # the engine reports an unsupported table operation
        if "UNSUPPORTED_FEATURE" in str(e):
            raise ValueError(f"{table} does not support MERGE INTO; upsert into a folder "
                             f"path (change log) or a row-level table format") from e
        raise
    finally:
        spark.catalog.dropTempView(view)


def upsert_stream(df: DataFrame, target: str, keys: Sequence[str], order_by: Sequence[str],
                  checkpoint: str, partition_by: Sequence[str] = ("city",),
                  trigger: dict | None = None) -> StreamingQuery:
    """Keyed upsert of a stream into a partitioned table (SNK-4, STR-7); see ``upsert_batch``."""
    return each_batch(df, lambda batch, i: upsert_batch(batch, i, target, keys, order_by, partition_by), checkpoint, trigger)


# ----------------------------------------------------------- de-duplication --

def dedupe_stream(df: DataFrame, key: Sequence[str] | str, event_time: str | None = None,
                  delay: str | None = None) -> DataFrame:
    """First-write-wins per key in a stream (STR-8, DQ-2).

    Without ``event_time`` the seen-key state grows without bound, exactly as
    the reference's ever-growing key set; with it, keys are forgotten once the
    watermark passes them (``dropDuplicatesWithinWatermark``), which bounds
    state but lets a key re-appear after ``delay``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if event_time is None:
        return df.dropDuplicates(keys)
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def first_per_key_stream(df: DataFrame, key: str, order_by: Sequence[str], seen: DataFrame,
                         unless: str | None = None) -> DataFrame:
    """First row per key of a stream, skipping the keys of the stream ``seen`` (DQ-2, DQ-3, STR-8).

    Within a micro-batch the least row by ``order_by`` is first (rows of a key meet in one task of
    the batch; ties are broken by a hash of the row).  Keys of earlier batches are kept in the
    state store by ``dropDuplicates``, which looks up the batch's keys only: what a batch reads does
    not grow with what was delivered.  ``seen`` fills the same state in the first batch.  Rows whose list
    column ``unless`` is not empty (reasons of a rejection) are left out before, as rows without a key are.

    Rows are shuffled once: dealt out by key and sorted there, they reach ``dropDuplicates``, which keeps the first row
    it meets, in the tasks that hold its state.  Their texts are moved as one (``pack_texts``), and the hash is made only
    where rows are compared that tie.  Start the query with ``sorts=True``.
    """
    old = "__seen"
    kept = [f for f in df.schema.fields if f.name != unless]
    mark = F.array(F.lit(0))
    if unless:  # a generator: a filter would be pushed below the parsed message, with all rules that the list is made of
        mark = F.when(F.coalesce(F.array_size(unless), F.lit(0)) == 0, mark)
    rows = df.where(F.col(key).isNotNull()).select(*[F.col(f"`{f.name}`") for f in kept], F.explode(mark).alias(old))
    texts = [c for c in text_columns(df, (key, *order_by)) if c != unless]
    marks = seen.select(key).withColumn(old, F.lit(-1))
    dealt = pack_texts(rows, texts).unionByName(marks, allowMissingColumns=True).repartition(F.col(key))
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in dealt.schema.fields if not isinstance(f.dataType, T.MapType)])
    # of a key that was seen, the marked row comes first
    first = dealt.sortWithinPartitions(key, old, *order_by, tie).dropDuplicates([key])
    return unpack_texts(first.where(F.col(old) == 0), texts).select(*[F.col(f"`{f.name}`") for f in kept])


# -------------------------------------------------------------------- late --

class LateRows(StreamingQueryListener):
    """Counts rows dropped behind the watermark, by query id (STR-4).  ``spark.streams.addListener(LateRows())``."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query dropped behind the watermark, over the progress reports it still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
