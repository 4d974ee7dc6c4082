"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly.

A word is the bag of its hashed character n-grams (3 to 5, with word marks)
and itself; a text is the average of all its words' subword vectors and of
``NEUTRAL`` zero vectors, so that a few words alone decide little; a linear
softmax over that average gives the two classes.  Subwords seen in fewer than
``MIN_DOCS`` training texts keep the zero vector.  Embeddings and softmax are
trained together by Adagrad in numpy, so a misspelling that was never seen
still shares most n-gram vectors with the word it is made from.

The class difference of the softmax is linear in the average, so scoring folds
each subword's vector to one number; a worker remembers the sums of the
strings it has met (bounded) and looks each up once per batch.

Edge cases: a null or empty text scores by the bias alone; null ids count as
the empty text for the fold and are never learnt from; labels other than 0 and
1 are ignored; repeated rows are scored one by one; without any label every
score is 0.5; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, text_slices
from .training import SAMPLE_ROWS, labelled_sample, train_in_one_task

BITS, DIM, GAIN = 17, 8, 30.0
RATE, EPOCHS, BATCH = 0.1, 5, 16
NEUTRAL, MIN_DOCS = 300, 5
GRAMS = (3, 4, 5)
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
THRESHOLD = 0.7
MEMO_WORDS, MEMO_CHARS = 200_000, 64
WORDS = re.compile(r"[^\W_]+(?:[^\w\s]+[^\W_]+)*")  # letters and digits, also with signs between them


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Subword numbers of many words (each word itself and its n-grams, in marks) and the word each belongs to."""
    marked = [f"<{w}>" for w in words]
    c = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    word = np.repeat(np.arange(len(marked)), size)
    at = np.arange(len(c)) - np.repeat(np.cumsum(size) - size, size)
    power = np.cumprod(np.full(max(int(size.max(initial=0)), *GRAMS) + 1, _BASE))  # also without any word
    whole = np.add.reduceat(c * power[at], np.cumsum(size) - size) if len(marked) else np.zeros(0, np.uint64)
    hashes, owners = [whole], [np.arange(len(marked))]
    for n in GRAMS:
        starts = np.flatnonzero(at + n <= size[word])
        hashes.append(sum((c[starts + k] * power[k] for k in range(n)), np.zeros(len(starts), np.uint64)))
        owners.append(word[starts])
    salted = [(h + np.uint64(k)) * _MIX >> np.uint64(64 - BITS) for k, h in enumerate(hashes)]
    return np.concatenate(salted).astype(np.int64), np.concatenate(owners)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct subword numbers of a text and their shares of the average."""
    words: dict[str, int] = {}
    for w in WORDS.findall((text or "").lower()):
        words[w] = words.get(w, 0) + 1
    ids, owner = subwords(list(words))
    times = np.fromiter(words.values(), np.int64, len(words))[owner]
    u, at = np.unique(ids, return_inverse=True)
    share = np.bincount(at, weights=times, minlength=len(u))
    return u.astype(np.int32), (share / (share.sum() + NEUTRAL)).astype(np.float32)


def train_softmax(rows: list[dict]) -> tuple[np.ndarray, float]:
    """Joint training over ``rows`` (label, ids, vals); returns each subword's class difference and the bias."""
    rng = np.random.default_rng(0)
    emb = rng.uniform(-1, 1, (1 << BITS, DIM)) / DIM
    out, bias = rng.normal(0, 0.5, (DIM, 2)), np.zeros(2)
    emb_sq, out_sq, bias_sq = np.full(1 << BITS, 1e-8), np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
    seen, data = np.zeros(1 << BITS, np.int64), []
    for r in rows:
        seen[np.frombuffer(r["ids"], np.int32)] += 1
    for i, r in enumerate(rows):
        ids, x = np.frombuffer(r["ids"], np.int32), np.frombuffer(r["vals"], np.float32)
        data.append((ids[seen[ids] >= MIN_DOCS], x[seen[ids] >= MIN_DOCS], r["label"]))
        rows[i] = None  # the raw bytes are not needed any more
    emb[seen < MIN_DOCS] = 0
    if not data:
        return np.zeros(1 << BITS, np.float32), 0.0
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for k in range(0, len(order), BATCH):
            some = [data[i] for i in order[k:k + BATCH]]
            hidden = np.array([x @ emb[ids] if len(ids) else np.zeros(DIM) for ids, x, _ in some])
            logit = GAIN * hidden @ out + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            err = p / p.sum(axis=1, keepdims=True)
            err[np.arange(len(some)), [y for *_, y in some]] -= 1
            err /= len(some)
            back = GAIN * err @ out.T
            g = GAIN * hidden.T @ err
            for (ids, x, _), b in zip(some, back):
                grad = x[:, None] * b
                emb_sq[ids] += (grad * grad).mean(axis=1)
                emb[ids] -= RATE * grad / np.sqrt(emb_sq[ids])[:, None]
            out_sq += g * g
            out -= RATE * g / np.sqrt(out_sq)
            gb = err.sum(axis=0)
            bias_sq += gb * gb
            bias -= RATE * gb / np.sqrt(bias_sq)
    return (GAIN * emb @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _bags(batches):
    for batch in batches:
        made = [bag(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array([i.tobytes() for i, _ in made], pa.binary()),
             pa.array([v.tobytes() for _, v in made], pa.binary())], names=["label", "ids", "vals"])


def fit(docs: DataFrame, labels: DataFrame, allowed, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Train on at most ``rows`` labelled documents for which ``allowed`` (a test of doc_id) holds."""
    sample = labelled_sample(docs, labels, "toxic", allowed, rows)
    return train_in_one_task(sample.mapInArrow(_bags, "label int, ids binary, vals binary"), train_softmax)


class Scorer:
    """Scores of whole texts; a batch's distinct space-separated strings are numbered by Arrow and summed once."""

    def __init__(self, model: tuple[np.ndarray, float]):
        self.weight, self.bias = model
        self.memo: dict[str, tuple[float, int]] = {}

    def sums(self, strings: list[str]) -> np.ndarray:
        """Class differences and number of the subwords of the words in each string."""
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        new = [s for s in strings if s not in memo]
        for i in range(0, len(new), 8192):  # bounds the arrays of all characters and n-grams
            some = new[i:i + 8192]
            found = [WORDS.findall(s.lower()) for s in some]
            owner = np.repeat(np.arange(len(some)), list(map(len, found)))
            ids, word = subwords([w for ws in found for w in ws])
            where = owner[word]
            total = np.bincount(where, weights=self.weight[ids], minlength=len(some)).tolist()
            n = np.bincount(where, minlength=len(some)).tolist()
            memo.update(zip(some, zip(total, n)))
        out = np.array(list(map(memo.__getitem__, strings)), float)
        for s in new:
            if len(s) > MEMO_CHARS:
                del memo[s]
        return out

    def batch(self, texts: list) -> np.ndarray:
        lists = pc.split_pattern(pa.array([t or "" for t in texts], pa.large_string()), " ")
        numbered, first = lists.values.dictionary_encode(), lists.offsets.to_numpy()
        each = self.sums(numbered.dictionary.to_pylist())[numbered.indices.to_numpy()]
        total, n = np.add.reduceat(each, first[:-1], axis=0).T
        return 1 / (1 + np.exp(-np.clip(total / (n + NEUTRAL) + self.bias, -35, 35)))

    def score(self, text: str | None) -> float:
        return float(self.batch([text])[0])


def _score(batches, model):
    scorer = Scorer(model.value)
    for batch in batches:
        out = [scorer.batch(part.column("text").to_pylist()) for part in text_slices(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(np.concatenate([np.zeros(0), *out]))],
            names=["doc_id", "held_out", "score"])


def score(docs: DataFrame, model: tuple[np.ndarray, float], held_out) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; the broadcast model has 2^BITS numbers (0.5 MB)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select("doc_id", "text", held_out.alias("held_out"))
    kind = src.schema["doc_id"].dataType.simpleString()
    made = src.mapInArrow(partial(_score, model=shared), f"doc_id {kind}, held_out boolean, score double")
    return made.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    return score(docs, fit(docs, labels, ~held_out), held_out)
