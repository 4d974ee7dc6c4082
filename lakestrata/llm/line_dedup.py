"""Line dedup: globally repeated passages of lines, by content-defined chunks.

Chunks.  Lines are hashed, and a rolling hash over the last ``WINDOW`` lines decides
which lines are anchors (three of four; lines of ``LONG_WORDS`` words always, lines of
fewer than ``ANCHOR_WORDS`` never).  A chunk boundary lies before and after every anchor, so chunks are anchors
and the lines between two anchors.  Boundaries depend on the lines next to them only: whatever is
inserted before a passage, its inner chunks are the same.  With a window of one line a passage of two
lines has a whole chunk in 15 of 16 cases, one of three lines in 63 of 64.

Repeated chunks.  Chunks are keyed by 128 bits of hash and counted over the whole
corpus.  For keys that occur twice or more the bytes of the chunk and the 128-bit hashes of the lines of its
two neighbours are fetched (a bitmap sized by the number of those keys keeps most other chunks out of that shuffle).
Per key the smallest and the largest content are aggregated (partially in every task, and by salted key
after the shuffle, so a chunk that is everywhere is never gathered); equal ones prove all copies
equal.  A key with differing contents is resolved by grouping on the content itself.

Runs.  Every copy but the first by (doc_id, text hash, position) is laid against that first copy and
extended line by line into its neighbours as long as the line hashes agree.  Spans of one text with the same
alignment (the same first text at the same distance) that overlap or touch are one run.  A run
is removed if it has two lines with words and ``MIN_WORDS`` words, or ``LONG_WORDS`` words.  Closing braces
and other short lines that happen to repeat are therefore kept.

Each removed line has an equal line at an earlier place that the run was laid against, so the first copy of
every line stays.

Edge cases: a null text has one empty line and nothing to remove, and stays
null; null ids sort after all others; rows equal in id and text are one
document and get the same result; blank lines around a run stay; a document may lose all its lines; an empty
table gives an empty result; only doc_id and text are read; a very long text is held once as a list of lines.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, stage

WINDOW, ANCHOR_WORDS, MIN_WORDS, LONG_WORDS, SALTS = 1, 3, 10, 50, 32
MOST_LINES = 64            # of a chunk without an anchor
MIN_BITS, MAX_BITS, BITS_PER_KEY = 16, 28, 8
_MASK, _BASE = (1 << 64) - 1, 0x9E3779B97F4A7C15
KEY = ["k1", "k2"]
PLACE = ["no_id", "doc_id", "row_hash", "chunk"]


def rolling(hashes: list[int], width: int = WINDOW) -> list[int]:
    """Rolling polynomial hash over the last ``width`` line hashes, ending at each line."""
    out, value, drop = [], 0, pow(_BASE, width, 1 << 64)
    for i, h in enumerate(hashes):
        value = (value * _BASE + h - (hashes[i - width] * drop if i >= width else 0)) & _MASK
        out.append(value)
    return out


def chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, end line) of every chunk, in order; blank lines lie in no chunk or inside one."""
    from xxhash import xxh3_64_intdigest
    rolled = rolling([xxh3_64_intdigest(x) for x in lines])
    out, at, last = [], None, 0          # lines since the last anchor: first and last one with words

    def between(end):
        return [] if at is None else [(at, end)]
    for i, line in enumerate(lines):
        n = len(line.split())
        if not n:
            continue
        if n >= LONG_WORDS or (n >= ANCHOR_WORDS and rolled[i] >> 32 & 3):
            out += between(last) + [(i, i + 1)]
            at = None
        else:
            if at is not None and i - at >= MOST_LINES:
                out += between(last)
                at = None
            at, last = i if at is None else at, i + 1
    return out + between(last)


def _chunk_rows(batches, wanted, bits):
    """Keys and places of the chunks; with ``wanted`` (a bitmap of keys) only those in it, with content and neighbours."""
    from xxhash import xxh3_128_digest, xxh3_128_intdigest
    content, bitmap = wanted is not None, wanted.value if wanted is not None else b""
    sign = lambda v: v - (1 << 64) if v >> 63 else v
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            rows, k1, k2, at, first, n, bodies = [], [], [], [], [], [], ([], [], [])
            for r, text in enumerate(part.column("text").to_pylist()):
                lines = (text or "").encode().split(b"\n")
                own = chunks(lines)
                for c, (a, b) in enumerate(own):
                    whole = b"\n".join(lines[a:b])
                    digest = xxh3_128_intdigest(whole)
                    if content:
                        bit = digest >> 64 & (1 << bits) - 1
                        if not bitmap[bit >> 3] >> (bit & 7) & 1:
                            continue
                        bodies[0].append(whole)
                        bodies[1].append(b"".join(map(xxh3_128_digest, lines[max(own[c - 1][0], a - MOST_LINES) if c else 0:a])))
                        bodies[2].append(b"".join(map(xxh3_128_digest, lines[b:min(own[c + 1][1], b + MOST_LINES)
                                                                             if c + 1 < len(own) else b])))
                    rows.append(r)
                    k1.append(sign(digest >> 64))
                    k2.append(sign(digest & _MASK))
                    at.append(c)
                    first.append(a)
                    n.append(b - a)
            pick = pa.array(rows, pa.int64())
            cols = [part.column("doc_id").take(pick), part.column("row_hash").take(pick), pa.array(at, pa.int32()),
                    pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())]
            names = ["doc_id", "row_hash", "chunk", "first_line", "n_lines", *KEY]
            if content:
                cols, names = cols + [pa.array(x, pa.binary()) for x in bodies], names + ["content", "before", "after"]
            yield pa.RecordBatch.from_arrays(cols, names=names)


def _occurrences(docs: DataFrame, wanted=None, bits: int = 0) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, row_hash long, chunk int, first_line int, n_lines int, k1 long, k2 long"
              + (", content binary, before binary, after binary" if wanted is not None else ""))
    return docs.mapInArrow(partial(_chunk_rows, wanted=wanted, bits=bits), schema)


def _bitmap(keys: DataFrame):
    """Broadcast bitmap with a bit for every key of ``keys``, about ``BITS_PER_KEY`` bits a key and at most
    2^MAX_BITS (32 MB): it only spares the shuffle of chunks that cannot be repeated, the join after it decides."""
    n = int(np.clip(np.ceil(np.log2(BITS_PER_KEY * keys.count() + 1)), MIN_BITS, MAX_BITS))
    bit = F.col("k1").bitwiseAND(F.lit((1 << n) - 1))
    words = keys.groupBy(F.shiftright(bit, 5).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(31)).cast("int"))).alias("bits"))
    made = np.zeros(1 << n - 5, "<u4")
    for part in words.toArrow().to_batches():  # at most 2^(MAX_BITS - 5) rows, whatever the number of keys
        made[part["word"].to_numpy()] = part["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(made.tobytes()), n


def _extended(batches):
    """Lay every copy against its first copy: the lines around that agree belong to the span."""
    same = lambda x, y: next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    lines = lambda hashes: [hashes[k:k + 16] for k in range(0, len(hashes), 16)]
    for batch in batches:
        spans = []
        for i in range(0, batch.num_rows, 4096):
            part = batch.slice(i, 4096)
            for a, n, b0, b1, a0, a1 in zip(*(part.column(c).to_pylist() for c in (
                    "first_line", "n_lines", "before", "first_before", "after", "first_after"))):
                left = same(lines(b0)[::-1], lines(b1)[::-1])
                spans.append((a - left, n + left + same(lines(a0), lines(a1))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_hash"), pa.array([a for a, _ in spans], pa.int32()),
             pa.array([n for _, n in spans], pa.int32()), batch.column("align"), batch.column("kept_in")],
            names=["doc_id", "row_hash", "first_line", "n_lines", "align", "kept_in"])


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Every copy but the first of a repeated chunk, extended along its first copy: doc_id, row_hash, first_line,
    n_lines, ``align`` (the first text and the distance to it) and ``kept_in`` (its id)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", "text", row_key(["text"]).alias("row_hash"))
    found = stage(_occurrences(src), "chunks")
    twice = stage(found.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*KEY), "repeated")
    salt = F.pmod(F.xxhash64("doc_id", "row_hash", "chunk"), F.lit(SALTS)).alias("salt")
    salted = twice.select(*KEY, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    copies = stage(_occurrences(src, *_bitmap(twice)).withColumn("no_id", F.col("doc_id").isNull()).select("*", salt).join(
        salted.hint("merge"), [*KEY, "salt"], "left_semi"), "copies")
    least = F.min(F.struct(*PLACE, "first_line", "before", "after")).alias("first")
    compared = stage(copies.groupBy(*KEY, "salt").agg(F.min("content").alias("lo"), F.max("content").alias("hi"), least)
                     .groupBy(*KEY).agg((F.min("lo") == F.max("hi")).alias("equal"), F.min("first").alias("first")), "compared")
    equal = copies.join(compared.where("equal").select(*KEY, "first").hint("merge"), KEY)
    # hash clashes: a table of its own, whose size the planner knows (as a rule it is empty)
    clashes = stage(compared.where(~F.col("equal")).select(*KEY), "clashes")
    mixed = copies.join(clashes, KEY, "left_semi")
    firsts = mixed.groupBy(*KEY, "content").agg(least)
    members = equal.unionByName(mixed.join(firsts, [*KEY, "content"]))
    # <=> on the place: ids may be null inside it
    later = members.where(~F.struct(*PLACE).eqNullSafe(F.struct(*[F.col(f"first.{c}") for c in PLACE])))
    align = F.xxhash64("first.doc_id", "first.row_hash", F.col("first.first_line") - F.col("first_line"))
    laid = later.select("doc_id", "row_hash", "first_line", "n_lines", "before", "after", F.col("first.before").alias("first_before"),
                        F.col("first.after").alias("first_after"), align.alias("align"), F.col("first.doc_id").alias("kept_in"))
    return laid.mapInArrow(_extended, f"doc_id {kind}, row_hash long, first_line int, n_lines int, align long, kept_in {kind}")


def runs(lines: list[str], spans: list[dict]) -> tuple[list[tuple[int, int]], set]:
    """(line spans to remove, ids of the first copies) from the spans of one text."""
    gone, kept_in = set(), set()
    by = {}
    for s in spans:
        by.setdefault(s["align"], []).append((s["first_line"], s["first_line"] + s["n_lines"], s["kept_in"]))
    size = {}
    for own in by.values():
        own.sort(key=lambda x: x[:2])
        joined = []
        for a, b, _ in own:
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        for a, b in joined:
            for k in range(a, b):
                if k not in size:
                    size[k] = len(lines[k].encode().split())
            words = [size[k] for k in range(a, b) if size[k]]
            if sum(words) >= LONG_WORDS or (len(words) > 1 and sum(words) >= MIN_WORDS):
                while a < b and not size[a]:
                    a += 1
                while a < b and not size[b - 1]:
                    b -= 1
                gone.update(range(a, b))
                kept_in.add(own[0][2])
    ends = [k + 1 for k in sorted(gone) if k + 1 not in gone]
    starts = [k for k in sorted(gone) if k - 1 not in gone]
    return list(zip(starts, ends)), kept_in


def _rebuild(batches, id_type):
    kind = pa.list_(pa.struct([("first_line", pa.int32()), ("n_lines", pa.int32())]))
    for batch in batches:
        n, removed, sources, kept = [], [], [], []
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                lines = (text or "").split("\n")
                found, first = runs(lines, spans) if spans else ([], set())
                gone = {k for a, b in found for k in range(a, b)}
                n.append(len(lines))
                removed.append([{"first_line": a, "n_lines": b - a} for a, b in found])
                sources.append(sorted((x for x in first if x is not None)) + [None] * (None in first))
                kept.append(text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(removed, kind), pa.array(sources, pa.list_(id_type)),
             pa.array(kept, pa.string())], names=["doc_id", "n_lines", "runs", "kept_in", "text"])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, n_lines, the removed ``runs`` of lines, ``kept_in`` (ids of the first copies) and the text left."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    spans = stage(repeated_chunks(docs).distinct().groupBy("doc_id", "row_hash").agg(
        F.collect_list(F.struct("first_line", "n_lines", "align", "kept_in")).alias("spans")), "spans")
    src = docs.select("doc_id", "text", row_key(["text"]).alias("row_hash")).alias("d")
    cond = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.row_hash") == F.col("g.row_hash"))
    # one plan at every size: the removals grow with the corpus
    both = src.join(spans.hint("merge").alias("g"), cond, "left").select("d.doc_id", "d.text", "g.spans")
    span = "array<struct<first_line:int,n_lines:int>>"
    return both.mapInArrow(partial(_rebuild, id_type=id_type),
                           f"doc_id {kind}, n_lines int, runs {span}, kept_in array<{kind}>, text string")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    made = dedup_lines(documents(spark, sf_dir))
    lines = F.aggregate("runs", F.lit(0), lambda n, s: n + s["n_lines"])
    spans = F.transform("runs", lambda s: F.concat_ws("-", s["first_line"].cast("string"),
                                                         (s["first_line"] + s["n_lines"]).cast("string")))
    return made.select("doc_id", "n_lines", lines.alias("n_removed"), F.array_join(spans, ",").alias("removed"),
                       "kept_in", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))
