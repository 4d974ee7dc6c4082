"""Token-id files by plane shuffling: blocks of ids, transposed, compressed, indexed.

Layout.  Documents are range-partitioned and sorted by id; each write task is
one *shard* and emits *segments* of whole documents (about ``segment_ids``
ids, more only for a longer document).  A segment cuts its ids into blocks of
``block_ids``; a block is transposed into byte planes (or bit planes) as wide
as its largest id needs, and every plane is compressed with zstandard on its
own.  The chunk index of a segment holds, per block, its offset in ``data``
and its planes' sizes, and per document its id and length, so a range of ids
is read by decompressing only the blocks it touches.

The table is written by Spark's commit protocol (a lost executor's attempt
leaves nothing behind) and works on any store Spark can write.

Edge cases: a null text is an empty one (only the end id is stored); null ids
come first; rows with equal ids are ordered by a hash of their text; an empty
table gives an empty file and result; other columns are not read.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_slices
from .tokens import encoder, public_path

BLOCK_IDS, SEGMENT_IDS, END_ID = 65_536, 1 << 20, 0
SLICE_BYTES = 4 << 20  # text that is encoded at a time; words and ids in flight take some 10 times that


def pack_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The planes of one block, lowest first; bit planes are padded to whole bytes."""
    width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(len(ids), 4)
    if not bits:
        return [raw[:, k].tobytes() for k in range((width + 7) // 8)]
    rows = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(rows[:, k]).tobytes() for k in range(width)]


def unpack_planes(planes: list[bytes], n: int, bits: bool = False) -> np.ndarray:
    if not bits:
        raw = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            raw[:, k] = np.frombuffer(plane, np.uint8)
        return raw.reshape(-1).view("<u4")
    out = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        out |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n).astype(np.uint32) << np.uint32(k)
    return out


def _segment_schema(kind: str) -> str:
    return (f"shard int, seq int, first long, n_ids long, bits boolean, block_ids int, doc_ids array<{kind}>, "
            "doc_lens array<long>, block_at array<long>, plane_sizes array<array<int>>, data binary")


def _encode(batches, name, bits, block_ids, segment_ids, arrow_kind):
    import zstandard
    enc, pack = encoder(public_path(name)), zstandard.ZstdCompressor(level=3)
    shard, seq, first = TaskContext.get().partitionId(), 0, 0
    docs, parts, held = [], [], 0
    end = np.uint32(END_ID)

    def segment():
        nonlocal seq, first, docs, parts, held
        ids = np.concatenate(parts)
        at, sizes, data = [], [], []
        for i in range(0, len(ids), block_ids):
            planes = [pack.compress(p) for p in pack_planes(ids[i:i + block_ids], bits)]
            at.append(sum(map(len, data)) if not at else at[-1] + sum(sizes[-1]))
            sizes.append([len(p) for p in planes])
            data += planes
        cols = [[shard], [seq], [first], [len(ids)], [bits], [block_ids], [docs], [[len(p) for p in parts]],
                [at], [sizes], [b"".join(data)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.list_(arrow_kind),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32())), pa.binary()]
        seq, first = seq + 1, first + len(ids)
        docs, parts, held = [], [], 0
        names = ["shard", "seq", "first", "n_ids", "bits", "block_ids", "doc_ids", "doc_lens", "block_at",
                 "plane_sizes", "data"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    for batch in batches:
        for some in text_slices(batch, limit=SLICE_BYTES):
            made = enc.batch([t or "" for t in some.column("text").to_pylist()])
            for doc, ids in zip(some.column("doc_id").to_pylist(), made):
                docs.append(doc)
                parts.append(np.append(ids, end))
                held += len(parts[-1])
                if held >= segment_ids:
                    yield segment()
    if docs:
        yield segment()


def write_token_file(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", bits: bool = False,
                     block_ids: int = BLOCK_IDS, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text), write the segments in ascending id order, return the written table."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema["doc_id"].dataType
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    encode = partial(_encode, name=tokenizer, bits=bits, block_ids=block_ids, segment_ids=segment_ids,
                     arrow_kind=to_arrow_type(kind))
    return stage(ordered.mapInArrow(encode, _segment_schema(kind.simpleString())), "token-file")


def decode_range(seg: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start:stop`` of one segment, decompressing only the blocks touched."""
    import zstandard
    unpack, size, out = zstandard.ZstdDecompressor(), seg["block_ids"], []
    for b in range(start // size, (max(start, stop - 1)) // size + 1 if stop > start else start // size):
        at, planes = seg["block_at"][b], []
        for n in seg["plane_sizes"][b]:
            planes.append(unpack.decompress(seg["data"][at:at + n]))
            at += n
        ids = unpack_planes(planes, min(size, seg["n_ids"] - b * size), seg["bits"])
        out.append(ids[max(0, start - b * size):stop - b * size])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _decode(batches, names):
    for batch in batches:
        for i in range(batch.num_rows):
            seg = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n not in ("doc_ids", "doc_lens")}
            lens = np.array(batch.column("doc_lens")[i].as_py(), np.int64)
            ids = decode_range(seg, 0, seg["n_ids"]).astype("<u4", copy=False)
            ends = np.cumsum(lens)
            crc = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends.tolist(), lens.tolist())]
            doc_ids = batch.column("doc_ids")[i].values
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array([seg["shard"]] * len(lens), pa.int32()),
                 pa.array(ends - lens + seg["first"], pa.int64()), pa.array(lens, pa.int64()),
                 pa.array(crc, pa.int64())], names=names)


def read_documents(segments: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the file.

    The shard offsets table has one row per write task, which bounds its broadcast."""
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    offsets = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    names = ["doc_id", "shard", "at", "n_tokens", "ids_crc32"]
    rows = segments.mapInArrow(partial(_decode, names=names),
                               f"doc_id {kind}, shard int, at long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    return read_documents(write_token_file(documents(spark, sf_dir)))
