"""SimHash near-duplicates with Golay-code fuzzy hashing.

Fingerprint: 64 bits, bit set if it is set in over half of the shingles'
XXH64 values.  Two fingerprints link at ``MAX_BITS`` = 2 or fewer differing
bits; groups are the connected components.

Candidates.  The 64 bits are cut into three segments (22, 21, 21 bits), each
read as a word of the perfect binary Golay code [23, 12, 7].  Two errors over
three segments leave, for one of the ordered pairs (0,1), (1,2), (2,0), a
first segment without error and a second one with at most one.  A key is the
first segment's bits with a codeword index near the second one:

* a word within distance 2 of its codeword has that one codeword within
  distance 4; a word at distance 3 has its own and five at distance 4;
* words one bit apart have different parity; the even one's own codeword is at
  most 4 away from the odd one.  So even words emit their own codeword's index
  and odd words all codewords within 4, and any two words at distance 0 or 1
  share a key.

That is about 9 keys of 36 bits per distinct fingerprint, whatever the corpus.

Verification.  Keys with up to ``DIRECT`` fingerprints are joined with
themselves and checked bit by bit.  Fingerprints of fuller keys are linked
exactly without pairing them: each emits itself and its one-bit neighbours,
and fingerprints that meet at a point are within two bits of each other (both
are within one bit of it), at most 65 distinct ones can meet, and any two at
distance 2 or less do meet.  No pair within the distance is lost and work
stays in proportion to the number of fingerprints.

Equal documents share one fingerprint and are collapsed before any join.

Edge cases: a null text counts as empty; texts without words have fingerprint
zero and link like any other; null ids take part but are never the smallest id
unless a group has no other; repeated rows link to each other; an empty table
gives an empty result; only doc_id and text are read; a very long text is hashed
in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, fresh, row_key, stage, whole_row_key

SHINGLE, MAX_BITS, SEED = 3, 2, 42
PIECE = 1 << 22                              # bytes of a text that are hashed at a time
SEGMENTS = ((0, 22), (22, 21), (43, 21))     # first bit, width
PAIRS = ((0, 1), (1, 2), (2, 0))             # exact segment, fuzzy segment
DIRECT = 32
GENERATOR = 0b101011100011                   # fixed value: x^11+x^9+x^7+x^6+x^5+x+1

_UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_EACH = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def word_pieces(raw: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in lists, each of a piece of about ``size`` bytes that ends at white space."""
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + size)
        end = gap.start() if gap else len(raw)
        yield raw[at:end].split()
        at = end


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, as an unsigned integer."""
    from xxhash import xxh64_intdigest
    n, count, words = 0, np.zeros((8, 8), np.int64), []
    for piece in word_pieces((text or "").encode().translate(_UPPER)):
        words = words + piece if words else piece
        if len(words) < width:
            continue
        own = len(words) - width + 1
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
        h = np.zeros(-(-own // 255) * 255, np.uint64)
        h[:own] = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, own)
        # eight bit counters per 64-bit integer: blocks of 255 hashes cannot overflow a byte
        sums = ((h >> _SHIFTS) & _EACH).reshape(8, -1, 255).sum(axis=2, dtype=np.uint64)
        count += sums.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)  # [bit in byte, byte]
        n, words = n + own, words[own:]
    if not n:      # fewer words than a shingle: the whole sequence
        return int(xxh64_intdigest(b" ".join(words), SEED)) if words else 0
    return int.from_bytes(np.packbits(2 * count > n, axis=0, bitorder="little").tobytes(), "little")


def _fingerprints(batches, width):
    for batch in batches:
        texts, out = batch.column("text"), []
        for i in range(0, len(texts), 256):
            out += [fingerprint(t, width) for t in texts.slice(i, 256).to_pylist()]
        fp = pa.array(np.array(out, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_hash"), fp],
                                         names=["doc_id", "row_hash", "fp"])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, row_hash, fp (signed 64-bit) of every row of ``docs`` (doc_id, text)."""
    src = docs.select("doc_id", "text", row_key(["text"]).alias("row_hash"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(partial(_fingerprints, width=width), f"doc_id {kind}, row_hash long, fp long")


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of single bits, and per syndrome the errors of weight 3 or less (first) and 4 (0 where none)."""
    bit = []
    for k in range(23):
        r = 1 << k
        for j in range(22, 10, -1):
            if r >> j & 1:
                r ^= GENERATOR << (j - 11)
        bit.append(r)
    errors, filled = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for weight in range(5):
        for at in combinations(range(23), weight):
            s = 0
            for k in at:
                s ^= bit[k]
            errors[s, filled[s]] = sum(1 << k for k in at)
            filled[s] += 1
    return np.array(bit, np.int64), errors


def codeword_indices(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Golay indices of 23-bit words: (n, 6) candidates and which of them count."""
    bit, errors = _golay()
    s = np.zeros_like(word)
    for k in range(23):
        s ^= np.where(word >> k & 1, bit[k], 0)
    near = errors[s]
    odd = np.bitwise_count(word) % 2 == 1
    use = near != 0
    use[:, 1:] &= odd[:, None]
    use[:, 0] = True
    return (word[:, None] ^ near) >> 11, use


def _keys(batches):
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        part = [(fp >> np.uint64(a) & np.uint64((1 << w) - 1)).astype(np.int64) for a, w in SEGMENTS]
        rows, keys = [], []
        for k, (exact, fuzzy) in enumerate(PAIRS):
            index, use = codeword_indices(part[fuzzy])
            at, which = np.nonzero(use)
            rows.append(at)
            keys.append(k << 40 | part[exact][at] << 12 | index[at, which])
        at = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(fp.view(np.int64)[at])],
                                         names=["key", "fp"])


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b), a < b, that connect exactly the fingerprints ``MAX_BITS`` or fewer bits apart.

    ``distinct`` has one column ``fp``, each value once."""
    keys = stage(distinct.select("fp").mapInArrow(_keys, "key long, fp long"), "golay-keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = stage(keys.join(shared, "key"), "shared-keys")
    few = live.where(F.col("n") <= DIRECT).select("key", "fp")
    other = few.select("key", F.col("fp").alias("b"))
    direct = (few.select("key", F.col("fp").alias("a")).join(other, "key")
              .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)))
    bits = F.array(F.lit(0).cast("long"), *[F.lit((1 << k) - (1 << 64 if k == 63 else 0)).cast("long")
                                            for k in range(64)])
    full = live.where(F.col("n") > DIRECT).select("fp").distinct()
    points = full.select("fp", F.explode(bits).alias("bit")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("point"))
    met = points.groupBy("point").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    star = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a < b")
    return direct.select("a", "b").unionByName(star).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), root the smallest node reachable.

    Alternating large-star and small-star steps; every step is an aggregate and
    a join whose hot nodes can be split, and is written to the shared folder.
    Only counts and checksums reach the driver."""
    def sums(e):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = stage(edges.select("a", "b"), "links")
    state = sums(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        large = stage(large, "large-star")
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low, "b")
        small = (joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
                 .unionByName(joined.select(F.col("m").alias("a"), "b")).distinct())
        edges = stage(small, "small-star")
        before, state = state, sums(edges)
        if state == before:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def group_roots(prints: DataFrame) -> DataFrame:
    """(fp, root) of every distinct fingerprint of the written table ``prints``."""
    distinct = prints.select("fp").distinct()
    comp = components(links(distinct))
    return distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    prints = stage(fingerprints(docs, width).select("doc_id", "fp"), "fingerprints")
    roots = stage(group_roots(prints), "roots")
    smallest = (prints.groupBy("fp").agg(F.min("doc_id").alias("doc")).join(roots, "fp")
                .groupBy("root").agg(F.min("doc").alias("component_id")))
    ids = stage(roots.join(smallest, "root").select("fp", "component_id"), "component-ids")
    return prints.join(ids, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """One row of every group of near-duplicates, with all its columns: the smallest (doc_id, text hash)."""
    prints = stage(fingerprints(docs, width), "fingerprints")
    pick = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")
    chosen = (prints.groupBy("fp").agg(F.min(pick).alias("p")).join(group_roots(prints), "fp")
              .groupBy("root").agg(F.min("p").alias("p")))
    key, seen = fresh(docs.columns, "group_key", "group_row")
    name = lambda d, h: F.concat_ws(":", F.coalesce(d.cast("string"), F.lit("null")), h.cast("string"))
    side = stage(chosen.select(name(F.col("p.doc_id"), F.col("p.row_hash")).alias(key)), "chosen")
    rows = docs.withColumn(key, name(col("doc_id"), row_key(["text"]))).join(side, key, "left_semi")
    first = F.row_number().over(Window.partitionBy(key).orderBy(whole_row_key(docs)))
    return rows.withColumn(seen, first).where(F.col(seen) == 1).select(*map(col, docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    return near_duplicates(documents(spark, sf_dir))
