"""Bounded labelled samples and models trained in one task, shared by the classifiers.

Training reads at most ``rows`` labelled documents, the ones with the smallest
seeded hash of their id.  Candidates are first chosen in the narrow labels
table (which also bounds the broadcast that fetches their texts) and cut again
after the join, so repeated ids cannot exceed the bound.  The model is trained
in one task on that bounded sample and comes back as one small row.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int = SAMPLE_ROWS,
                    seed: int = 42) -> DataFrame:
    """text and label (0/1) of at most ``rows`` labelled documents; ``allowed`` tests ``doc_id``."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    usable = F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & allowed
    chosen = (labels.select("doc_id", F.col(label).cast("int").alias("label")).where(usable).distinct()
              .orderBy(order, "doc_id", "label").limit(rows))
    got = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return got.orderBy(order, "doc_id", "label", F.xxhash64("text")).limit(rows).select("text", "label")


def train_in_one_task(examples: DataFrame, train: Callable) -> object:
    """``train(rows)`` over the bounded table ``examples``, run in one task; returns its (picklable) model.

    ``rows`` is a list of dicts in a fixed order."""
    names = examples.columns

    def run(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows))], pa.binary())], names=["model"])

    order = [F.xxhash64(*[F.col(c) for c in names])]
    one = examples.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "model binary")
    row = one.first()  # no row: the planner saw that there are no examples
    return pickle.loads(row["model"]) if row else train([])
