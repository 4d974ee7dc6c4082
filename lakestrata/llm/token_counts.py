"""Token counts with overlap resynchronisation.

Texts above ``chunk`` characters are encoded in overlapping chunks with
offsets and spliced at proven boundaries (``tokens.Encoder.resync``); shorter
ones are cut at the same hard boundaries and counted part by part.  Either way
the count is the library's count of the whole text, and a worker holds one
chunk's encoding at a time, whatever the text length.

Edge cases: null text counts as empty (0 bytes, 0 tokens); null ids and
repeated rows are kept row by row; an empty table gives an empty result; only
``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices
from .tokens import encoder, public_path

CHUNK, OVERLAP = 65_536, 1_024


def _count(batches, name, chunk, overlap):
    enc = encoder(public_path(name))
    for batch in batches:
        n = []
        for part in text_slices(batch):
            some = [t or "" for t in part.column("text").to_pylist()]
            short = iter(enc.batch([t for t in some if len(t) <= chunk]))
            n += [len(next(short)) if len(t) <= chunk else len(enc.resync(t, chunk, overlap)) for t in some]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                                         names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = src.mapInArrow(partial(_count, name=tokenizer, chunk=chunk, overlap=overlap),
                             f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    return token_counts(documents(spark, sf_dir))
