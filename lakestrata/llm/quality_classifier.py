"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features of a text: its lower-cased words and word shapes (letters and digits
replaced by their class) as hashed 1- and 2-grams, plus one feature for a word
that repeats its predecessor; counts, scaled to length one.  Training is
FTRL-proximal with per-coordinate rates and L1, which leaves a sparse weight
vector; a score is the logistic of one sparse dot product.

Edge cases: a null or empty text has no features and scores by the bias alone;
null ids count as the empty text for the fold and are never learnt from;
labels other than 0 and 1 are ignored; repeated rows are scored one by one;
without any label every score is 0.5; other columns are not read.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod
from .training import SAMPLE_ROWS, labelled_sample, train_in_one_task

BITS = 18
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 1.0, 3
THRESHOLD = 0.3
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SHAPE = bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else
               ord("0") if 48 <= b <= 57 else b for b in range(256))
_MASK, _PAIR, _SHAPES, _SAME = np.uint32((1 << BITS) - 1), np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), 0


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed feature numbers and their values (unit length)."""
    raw = (text or "").encode()
    words = raw.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    w = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    s = np.fromiter(map(zlib.crc32, raw.translate(_SHAPE).split()), np.uint32, len(words)) * _SHAPES
    pairs = [(x[:-1] * _PAIR) ^ (x[1:] + np.uint32(k)) for k, x in enumerate((w, s), 1)]
    same = np.zeros(int((w[1:] == w[:-1]).sum()), np.uint32)
    hashed = np.concatenate([w, s, *pairs])
    every = np.concatenate([(hashed ^ (hashed >> np.uint32(15))) & _MASK, same])
    ids, count = np.unique(every, return_counts=True)
    value = count.astype(np.float32)
    return ids.astype(np.int64), value / np.float32(np.sqrt((value * value).sum()))


def train_ftrl(rows: list[dict]) -> tuple[np.ndarray, float]:
    """FTRL-proximal over ``rows`` (label, ids, vals); returns weights and bias."""
    size = (1 << BITS) + 1  # the last coordinate is the bias
    z, n = np.zeros(size), np.zeros(size)
    data = [(np.append(np.frombuffer(r["ids"], np.int64), size - 1),
             np.append(np.frombuffer(r["vals"], np.float32), np.float32(1)).astype(np.float64), r["label"]) for r in rows]

    def weight(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(data)):
            ids, x, y = data[k]
            zi, ni = z[ids], n[ids]
            w = weight(zi, ni)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[ids], n[ids] = zi + g - step * w, ni + g * g
    w = weight(z, n)
    return w[:-1].astype(np.float32), float(w[-1])


def _features(batches):
    for batch in batches:
        made = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array([i.tobytes() for i, _ in made], pa.binary()),
             pa.array([v.tobytes() for _, v in made], pa.binary())], names=["label", "ids", "vals"])


def fit(docs: DataFrame, labels: DataFrame, allowed, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Train on at most ``rows`` labelled documents for which ``allowed`` (a test of doc_id) holds."""
    sample = labelled_sample(docs, labels, "quality", allowed, rows)
    made = sample.mapInArrow(_features, "label int, ids binary, vals binary")
    return train_in_one_task(made, train_ftrl)


def _score(batches, model):
    weights, bias = model.value
    for batch in batches:
        texts, out = batch.column("text"), []
        for i in range(0, len(texts), 256):
            for t in texts.slice(i, 256).to_pylist():
                ids, x = features(t)
                out.append(1 / (1 + np.exp(-np.clip(float(weights[ids] @ x) + bias, -35, 35))))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(out, pa.float64())],
                                         names=["doc_id", "held_out", "score"])


def score(docs: DataFrame, model: tuple[np.ndarray, float], held_out) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; the broadcast model has 2^BITS weights (1 MB)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select("doc_id", "text", held_out.alias("held_out"))
    kind = src.schema["doc_id"].dataType.simpleString()
    made = src.mapInArrow(partial(_score, model=shared), f"doc_id {kind}, held_out boolean, score double")
    return made.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    return score(docs, fit(docs, labels, ~held_out), held_out)
