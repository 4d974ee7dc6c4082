"""Substring dedup: windows of 50 words that also start in a document with a smaller id.

Every word covered by such a window is removed.  Three steps, all judged on the
input:

1. Prefilter.  A window is represented by its anchor, the least hash of its 26
   grams of 25 words: equal windows have equal anchors, so an anchor occurs at
   least as often as any of its windows.  Each task adds the anchors of its
   texts to a count-min sketch (two rows of cells that saturate at 2), written in
   slices; the slices of all tasks are merged.  Merged counts only overestimate, so
   a window whose anchor is estimated below 2 occurs once, and no repeated window
   is lost.  What the driver gathers and broadcasts is one bit a cell, at most
   ``2 * 2^MAX_BITS`` bits (16 MB).
2. Exact groups of bundles.  Windows that follow each other and share an anchor (13 on
   average) are one bundle, keyed by 128 bits of hash of all its words.  Second
   pass: bundles whose anchor is estimated repeated are emitted and grouped
   exactly.  Equal bundles hold equal windows, so each one with a smaller id in its
   group is removed whole.
3. Exact groups of windows.  Where an anchor has several different bundles (the ends
   of repeated passages, near copies), the first document of each bundle emits its
   single windows, which are grouped exactly by 128 bits of hash.  A window of a
   document that an earlier bundle represents is found through that document: its
   first holder has a smaller id still, so no match is lost.

The sketch has four cells an anchor up to ``MAX_BITS``.  Beyond about 10 GB of text it
lets more and more single anchors through and in the end all of them; the exact groups
then take one row for about 13 words.  The result is the same at every size.

Hot groups: bundles and windows are counted with partial aggregates, and the joins
back are merge joins whose hot keys AQE splits, so no group is ever gathered.

Edge cases: a null text has no words and an empty result text; fewer than 50 words have no
window; null ids are larger than all others and not smaller than each other; rows
with equal ids never remove each other; repeated rows get equal results; an empty
table gives an empty result; only doc_id and text are read.  Very long texts are
hashed in pieces of 2^20 bytes and 2^19 words; about six bytes a byte of text are held.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, stage, text_slices

WINDOW, GRAM = 50, 25
CELLS_PER_ANCHOR, MIN_BITS, MAX_BITS, SLICE_BITS = 4, 18, 26, 18
PIECE_BYTES, PIECE_WORDS, LONGEST_BUNDLE = 1 << 20, 1 << 19, 26
BYTE_BASE, GRAM_BASE, OTHER_BASE = 0x9E3779B97F4A7C1B, 0xD1B54A32D192ED03, 0xABC98388FB8FAC03   # odd multipliers
CELL_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
KEY = ["v", "r1", "r2", "n"]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _power(base: int, k: int) -> np.ndarray:
    return np.array([pow(base, k, 1 << 64)], np.uint64)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _bytes_of(batch) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the batch's texts, one after the other, and the offsets of the texts."""
    texts = pa.array(batch.column("text").fill_null("").cast(pa.large_binary()))
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8), offsets - lo


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the number of words before each text (and in all).

    A word's hash is a polynomial in its bytes, taken from prefix sums over all bytes; pieces carry the sum on.
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    cut = np.zeros(size, bool)                                # a text begins here
    cut[offsets[:-1][offsets[:-1] < size]] = True
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1] | cut[1:]
    ends[:-1] &= ~word[1:] | cut[1:]
    table = mix(np.arange(1, 257, dtype=np.uint64))
    up, down = _powers(BYTE_BASE, PIECE_BYTES), _powers(_inverse(BYTE_BASE), PIECE_BYTES)
    before, after, unshift, total = [], [], [], np.zeros(1, np.uint64)
    for a in range(0, size, PIECE_BYTES):
        b = min(a + PIECE_BYTES, size)
        sums = total + _power(BYTE_BASE, a) * np.concatenate(
            [np.zeros(1, np.uint64), np.cumsum(table[data[a:b]] * up[:b - a])])
        s = np.flatnonzero(starts[a:b])
        before.append(sums[s])
        unshift.append(down[s] * _power(_inverse(BYTE_BASE), a))
        after.append(sums[np.flatnonzero(ends[a:b]) + 1])
        total = sums[-1:]
    hashes = mix((np.concatenate(after) - np.concatenate(before)) * np.concatenate(unshift))
    return hashes, np.searchsorted(np.flatnonzero(starts), offsets)


class Windows:
    """Window starts of a run of words: positions, text numbers, anchors and hashes of any span of words."""

    def __init__(self, words: np.ndarray, first: np.ndarray, a: int):
        """Windows that start at word ``a`` or up to PIECE_WORDS behind; ``first``: the number of words before each text."""
        own = words[a:a + PIECE_WORDS + WINDOW - 1]
        m, self.a = len(own), a
        text = np.searchsorted(first, np.arange(a, a + m), side="right") - 1
        self._sums, self._down = [], []
        for base in (GRAM_BASE, OTHER_BASE):
            sums = np.zeros(m + 1, np.uint64)
            np.cumsum(own * _powers(base, PIECE_WORDS + WINDOW)[:m], out=sums[1:])
            self._sums.append(sums)
            self._down.append(_powers(_inverse(base), PIECE_WORDS + WINDOW))
        n = m - WINDOW + 1
        least = mix(self.span(np.arange(m - GRAM + 1), GRAM, 0))
        for width in (1, 2, 4, 8):                         # least of 2, 4, 8 and 16 grams
            least = np.minimum(least[:-width], least[width:])
        rest = WINDOW - GRAM + 1 - 16
        self.anchor = np.minimum(least[:n], least[rest:rest + n])
        self.text = text[:n]
        self.valid = text[:n] == text[WINDOW - 1:]

    def span(self, start, size, which: int) -> np.ndarray:
        """Hash of ``size`` words from ``start`` (counted from the first word of this run)."""
        return (self._sums[which][start + size] - self._sums[which][start]) * self._down[which][start]

    def bundles(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of each bundle."""
        n = len(self.anchor)
        new = np.ones(n, bool)
        new[1:] = ((self.anchor[1:] != self.anchor[:-1]) | (self.text[1:] != self.text[:-1])
                   | (self.valid[1:] != self.valid[:-1]))
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, n))
        parts = -(-size // LONGEST_BUNDLE)                 # equal grams in a row (one word over and over)
        head = np.repeat(at, parts)
        head += LONGEST_BUNDLE * (np.arange(len(head)) - np.repeat(np.cumsum(parts) - parts, parts))
        size = np.diff(np.append(head, n))
        ok = self.valid[head]
        return head[ok], size[ok]


def _windows(batch):
    """(slice of the batch, number of words before each text, its runs of windows) for all texts of the batch."""
    for part in text_slices(batch, limit=2 << 20):
        words, first = word_hashes(*_bytes_of(part))
        runs = (Windows(words, first, a) for a in range(0, len(words) - WINDOW + 1, PIECE_WORDS))
        yield part, first, runs


def cells(anchor: np.ndarray, bits: int) -> list[np.ndarray]:
    return [anchor * f >> np.uint64(64 - bits) for f in CELL_FACTORS]


def _sketch(batches, bits):
    """The task's sketch in compressed slices: row, slice, counts."""
    import zstandard
    counts = np.zeros((2, 1 << bits), np.uint8)
    for batch in batches:
        for _, _, runs in _windows(batch):
            for w in runs:
                anchors = w.anchor[w.bundles()[0]]
                for row, at in zip(counts, cells(anchors, bits)):
                    at, n = np.unique(at, return_counts=True)
                    row[at] = np.minimum(row[at] + np.minimum(n, 2), 2)
    pack = zstandard.ZstdCompressor(level=1)
    for row in range(2):
        slices = counts[row].reshape(-1, 1 << SLICE_BITS)
        used = np.flatnonzero(slices.any(axis=1))
        for some in np.array_split(used, max(1, len(used) // 64)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), row, np.int32)), pa.array(some.astype(np.int32)),
                 pa.array([pack.compress(slices[k].tobytes()) for k in some], pa.binary())], names=["row", "slice", "counts"])


def _merge(batches):
    """Sum the slices of all tasks, which come sorted; bits of the cells that reached 2."""
    import zstandard
    unpack, now, total = zstandard.ZstdDecompressor(), None, None

    def made():
        bits = np.packbits(total >= 2, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()),
                                           pa.array([bits], pa.binary())], names=["row", "slice", "bits"])
    for batch in batches:
        for row, at, packed in zip(*(c.to_pylist() for c in batch.columns)):
            counts = np.frombuffer(unpack.decompress(packed), np.uint8)
            if now == (row, at):
                total = np.minimum(total + counts, 2)
                continue
            if now is not None:
                yield made()
            now, total = (row, at), counts
    if now is not None:
        yield made()


def repeated_cells(src: DataFrame):
    """Broadcast bits of the sketch cells with a count of 2 or more, and the sketch's size."""
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    anchors = size / 6 / ((WINDOW - GRAM + 2) / 2)
    bits = int(np.clip(np.ceil(np.log2(CELLS_PER_ANCHOR * anchors + 1)), MIN_BITS, MAX_BITS))
    slices = src.mapInArrow(partial(_sketch, bits=bits), "row int, slice int, counts binary")
    merged = (slices.repartition("row", "slice").sortWithinPartitions("row", "slice")
              .mapInArrow(_merge, "row int, slice int, bits binary"))
    out = np.zeros((2, 1 << bits - SLICE_BITS, 1 << SLICE_BITS - 3), np.uint8)
    for row, at, packed in merged.toLocalIterator():      # 2 * 2^(bits - SLICE_BITS) rows at most, whatever the corpus
        out[row, at] = np.frombuffer(packed, np.uint8)
    return src.sparkSession.sparkContext.broadcast(out.tobytes()), bits


def _bundles(batches, sketch, bits):
    """Bundles whose anchor is estimated repeated."""
    rows = np.frombuffer(sketch.value, np.uint8).reshape(2, -1)
    for batch in batches:
        for part, first, runs in _windows(batch):
            for w in runs:
                head, n = w.bundles()
                v = w.anchor[head]
                hit = np.ones(len(v), bool)
                for row, at in zip(rows, cells(v, bits)):
                    hit &= row[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
                head, n, v = head[hit], n[hit], v[hit]
                text = w.text[head]
                size = n + WINDOW - 1
                pick = pa.array(text)
                signed = lambda x: pa.array(x.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [signed(v), signed(mix(w.span(head, size, 0))), signed(mix(w.span(head, size, 1))),
                     pa.array(n.astype(np.int32)), part.column("doc_id").take(pick), part.column("row_hash").take(pick),
                     pa.array((w.a + head - first[text]).astype(np.int32))], names=[*KEY, "doc_id", "row_hash", "lo"])


def _single_windows(batches):
    """Hashes of the windows that ``needs`` (first window, number of windows) names."""
    for batch in batches:
        for part, first, runs in _windows(batch):
            needs = part.column("needs")
            owner = np.repeat(np.arange(len(needs)), needs.value_lengths().to_numpy())
            spans = needs.flatten()
            lo = spans.field("lo").to_numpy() + first[owner]
            hi = lo + spans.field("n").to_numpy()
            wanted = np.zeros(int(first[-1]) + 1, np.int32)
            np.add.at(wanted, lo, 1)
            np.add.at(wanted, hi, -1)
            wanted = np.cumsum(wanted) > 0
            for w in runs:
                at = np.flatnonzero(w.valid & wanted[w.a:w.a + len(w.valid)])
                text = w.text[at]
                pick = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(w.span(at, WINDOW, k)).view(np.int64)) for k in (0, 1)]
                    + [part.column("doc_id").take(pick), part.column("row_hash").take(pick),
                       pa.array((w.a + at - first[text]).astype(np.int32))], names=["w1", "w2", "doc_id", "row_hash", "lo"])


def _several() -> list:
    """Aggregates of a group: its smallest id, and whether it holds ids that are larger (null: largest)."""
    low, high = F.min("doc_id"), F.max("doc_id")
    return [low.alias("least"), ((low != high) | (low.isNotNull() & F.max(F.col("doc_id").isNull()))).alias("several")]


def _smaller_exists():
    return F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash and the spans of words (first, number) to remove of each text that loses some."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", "text", row_key(["text"]).alias("row_hash"))
    sketch, bits = repeated_cells(src)
    found = stage(src.mapInArrow(partial(_bundles, sketch=sketch, bits=bits),
                                 f"v long, r1 long, r2 long, n int, doc_id {kind}, row_hash long, lo int"), "bundles")
    groups = stage(found.groupBy(*KEY).agg(*_several()), "bundle-groups")
    mixed = groups.groupBy("v").agg((F.count(F.lit(1)) > 1).alias("mixed")).where("mixed")
    judged = groups.join(mixed.hint("merge"), "v", "left").select(
        *KEY, "least", "several", F.col("mixed").isNotNull().alias("mixed")).where("several OR mixed")
    known = stage(found.join(judged.hint("merge"), KEY).select(
        "doc_id", "row_hash", "lo", "n", _smaller_exists().alias("gone"), "mixed").where("gone OR mixed"), "judged")
    needs = stage(known.where("NOT gone").select("doc_id", "row_hash", "lo", "n").distinct()
                  .groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("lo", "n")).alias("needs")), "needs")
    same = lambda a, b: (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
                         & (F.col(f"{a}.row_hash") == F.col(f"{b}.row_hash")))
    texts = src.alias("d").join(needs.hint("merge").alias("n"), same("d", "n")).select("d.*", "n.needs")
    single = stage(texts.mapInArrow(_single_windows, f"w1 long, w2 long, doc_id {kind}, row_hash long, lo int"), "windows")
    first = single.groupBy("w1", "w2").agg(*_several()).where("several")
    later = single.join(first.hint("merge"), ["w1", "w2"]).where(_smaller_exists())
    size = F.lit(WINDOW - 1)
    spans = known.where("gone").select("doc_id", "row_hash", "lo", (F.col("n") + size).alias("n")).unionByName(
        later.select("doc_id", "row_hash", "lo", F.lit(WINDOW).alias("n")))
    return spans.distinct().groupBy("doc_id", "row_hash").agg(
        F.sort_array(F.collect_list(F.struct(F.col("lo").alias("first_word"), F.col("n").alias("n_words")))).alias("spans"))


def _rebuild(batches):
    kind = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32())]))
    for batch in batches:
        for part in text_slices(batch, rows=1024):
            n_words, n_removed, runs, kept = [], [], [], []
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                words = (text or "").encode().split()
                n_words.append(len(words))
                own, left, at = [], [], 0
                for s in spans or ():                         # by first word
                    a, b = s["first_word"], s["first_word"] + s["n_words"]
                    if own and a <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], b)
                    else:
                        own.append([a, b])
                for a, b in own:
                    left += words[at:a]
                    at = b
                left += words[at:]
                n_removed.append(len(words) - len(left))
                runs.append([{"first_word": a, "n_words": b - a} for a, b in own])
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(runs, kind),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "runs", "text"])


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, n_words, n_removed, the removed ``runs`` of words and the words left, joined by spaces."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    gone = stage(repeated_spans(docs), "spans")
    src = docs.select("doc_id", "text", row_key(["text"]).alias("row_hash"))
    cond = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.row_hash") == F.col("g.row_hash"))
    both = src.alias("d").join(gone.hint("merge").alias("g"), cond, "left").select("d.doc_id", "d.text", "g.spans")
    return both.mapInArrow(_rebuild, f"doc_id {kind}, n_words long, n_removed long, "
                                     "runs array<struct<first_word:int,n_words:int>>, text string")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    return dedup_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
f AS (SELECT h, min(doc_id) AS least FROM s GROUP BY h),
g AS (SELECT s.r, s.i FROM s JOIN f USING (h) WHERE f.least < s.doc_id OR (s.doc_id IS NULL AND f.least IS NOT NULL)),
p AS (
  SELECT d.r, u.i, u.word FROM d, LATERAL (SELECT unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i) u),
k AS (
  SELECT p.r, p.i, p.word,
         count(g.i) OVER (PARTITION BY p.r ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM p LEFT JOIN g ON p.r = g.r AND p.i = g.i),
o AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM k GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(o.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(o.kept, '')) AS kept_sha256
FROM d LEFT JOIN o ON d.r = o.r
"""
