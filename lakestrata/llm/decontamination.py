"""Benchmark decontamination with a distributed positional inverted index.

Index.  Every row of the corpus is indexed.  A scan task turns its documents
into *segments* of about ``segment_bytes`` of text, each an inverted index of
whole documents: the sorted terms, and per term the list of its positions in
the segment's word stream (one unused position lies between two documents, so
no run of positions crosses them).  Segments never need each other, so the
build and every search are one pass without a shuffle of postings.

Search.  The queries (distinct windows of the benchmark items) are a table like any other;
nothing of it passes the driver.  Counts of their terms over all segments name the rarest term of each
query, and a join by that term names the segments where it can occur; queries with a term
that occurs nowhere are gone by then.  Each segment is then read once more with the
queries named for it (in parts of about ``QUERIES_A_PART``): from the segment's rarest term, its positions, moved
to the window's start, are intersected with the moved lists of the next rarer terms until none or
only exact matches are left.  ``proximity_matches`` finds places where all terms of a query occur
within ``slop`` words, from the same lists.  Who owns a window is joined at the end.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.

Edge cases: a null text has no words; an item without words has no window; an
item with a null id marks hits but is not counted or named; repeated items
count once, repeated rows are decided row by row; empty tables give no hits;
only doc_id/text and item_id/text are read; a very long text is one segment of its own.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_by_rows, row_key, stage

WINDOW = 10
SEGMENT_BYTES, QUERIES_A_PART = 8 << 20, 20_000
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))
_SEGMENT = pa.schema([("segment", pa.string()), ("row_hash", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())),
                      ("terms", pa.binary()), ("term_counts", pa.binary()), ("postings", pa.binary())])


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEPT).split()


def _segment(name: str, doc_ids: list, hashes: list, lens: list, stream: list[bytes], kind) -> pa.RecordBatch:
    """Invert the words of whole documents."""
    vocab: dict[bytes, int] = {}
    ids = np.fromiter((vocab.setdefault(w, len(vocab)) for w in stream), np.int64, len(stream))
    gaps = np.repeat(np.arange(len(lens), dtype=np.int64), lens)  # one free position after each document
    order = np.argsort(ids, kind="stable")
    postings = (np.arange(len(ids), dtype=np.int64) + gaps)[order]
    arrays = [pa.array([name]), pa.array([doc_ids], pa.list_(kind)), pa.array([hashes], pa.list_(pa.int64())),
              pa.array([lens], pa.list_(pa.int64())), pa.array([b" ".join(vocab)], pa.binary()),
              pa.array([np.bincount(ids, minlength=len(vocab)).astype("<i4").tobytes()], pa.binary()),
              pa.array([np.diff(postings, prepend=0).astype("<i4").tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["segment", "doc_ids", *_SEGMENT.names[1:]])


def _build(batches, limit, kind):
    part, seq = TaskContext.get().partitionId(), 0
    ids, hashes, lens, stream, held = [], [], [], [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            for doc, text, h in zip(*(batch.column(c).slice(i, 256).to_pylist() for c in range(3))):
                w = words(text)
                ids.append(doc)
                hashes.append(h)
                lens.append(len(w))
                stream += w
                held += len(text or "") + 32
                if held >= limit:
                    yield _segment(f"{part}-{seq}", ids, hashes, lens, stream, kind)
                    seq, ids, hashes, lens, stream, held = seq + 1, [], [], [], [], 0
    if ids:
        yield _segment(f"{part}-{seq}", ids, hashes, lens, stream, kind)


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Index every row of ``docs`` (doc_id, text); returns the written segments."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema["doc_id"].dataType
    schema = (f"segment string, doc_ids array<{kind.simpleString()}>, row_hash array<long>, n_words array<long>, "
              "terms binary, term_counts binary, postings binary")
    src = docs.select("doc_id", "text", row_key(["text"]).alias("h"))
    return stage(src.mapInArrow(partial(_build, limit=segment_bytes, kind=to_arrow_type(kind)), schema), "index")


class Segment:
    """One segment opened for lookups."""

    def __init__(self, row: dict):
        counts = np.frombuffer(row["term_counts"], "<i4").astype(np.int64)
        self.term = {t: k for k, t in enumerate(row["terms"].split(b" "))} if len(counts) else {}
        self.end = np.cumsum(counts)
        self.count = counts
        self.postings = np.cumsum(np.frombuffer(row["postings"], "<i4").astype(np.int64))
        lens = np.array(row["n_words"], np.int64)
        self.start = np.cumsum(lens + 1) - lens - 1

    def positions(self, k: int) -> np.ndarray:
        return self.postings[self.end[k] - self.count[k]:self.end[k]]

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, pos, side="right") - 1

    def phrase(self, terms: list[int]) -> np.ndarray:
        """Start positions of the phrase: offset-adjusted lists intersected from the rarest term."""
        order = sorted(range(len(terms)), key=lambda j: self.count[terms[j]])
        found = self.positions(terms[order[0]]) - order[0]
        for j in order[1:]:
            if not len(found):
                break
            other = self.positions(terms[j])
            at = np.searchsorted(other, found + j)
            at[at == len(other)] = 0
            found = found[other[at] == found + j]
        return found

    def near(self, terms: list[int], slop: int) -> np.ndarray:
        """Start positions of the smallest spans, at most ``slop`` words wide, that hold all terms."""
        rare = self.positions(min(terms, key=lambda k: self.count[k]))
        events = []
        for k in set(terms):
            p = self.positions(k)
            lo = np.searchsorted(rare, p - slop)
            p = p[(lo < len(rare)) & (rare[np.minimum(lo, len(rare) - 1)] <= p + slop)]
            events += [(int(x), k) for x in p]
        events.sort()
        need, have, left, out = len(set(terms)), {}, 0, []
        for pos, k in events:
            have[k] = have.get(k, 0) + 1
            while len(have) == need:
                first, k0 = events[left]
                have[k0] -= 1
                if have[k0]:
                    left += 1
                    continue
                if pos - first < slop and self.doc_of(np.array([first]))[0] == self.doc_of(np.array([pos]))[0]:
                    out.append(first)
                del have[k0]
                left += 1
        return np.array(out, np.int64)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def _windows(batches, window):
    """Queries of each item: its windows, or (``window`` None) one query of its distinct words."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part, terms, owner = batch.slice(i, 256), [], []
            for item, text in zip(part.column("item").to_pylist(), part.column("text").to_pylist()):
                w = words(text)
                spans = ([sorted(set(w))] if window is None else
                         [w[k:k + window] for k in range(max(1, len(w) - window + 1))]) if w else []
                terms += spans
                owner += [item] * len(spans)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.binary())), pa.array(owner, pa.string())],
                                             names=["terms", "item"])


def build_queries(items: DataFrame, window: int | None = WINDOW) -> DataFrame:
    """Distinct queries of ``items`` (item_id, text): ``query`` (a number), ``terms`` and the ``owners`` as strings."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    each = rows.mapInArrow(partial(_windows, window=window), "terms array<binary>, item string").distinct()
    made = each.groupBy("terms").agg(F.array_sort(F.collect_set("item")).alias("owners"))
    return stage(made.select(F.monotonically_increasing_id().alias("query"), "terms", "owners"), "queries")


def _terms(batches):
    """One row for each term of a segment, with its count."""
    for batch in batches:
        for name, terms, counts in zip(*(batch.column(c).to_pylist() for c in ("segment", "terms", "term_counts"))):
            n = np.frombuffer(counts, "<i4")
            if len(n):
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(n)), pa.array(terms.split(b" "), pa.binary()), pa.array(n)],
                                                 names=["segment", "term", "n"])


def _wanted(index: DataFrame, queries: DataFrame) -> DataFrame:
    """Queries named for each segment, in parts: segment, part, queries (number, terms)."""
    term = queries.select("query", F.explode(F.array_distinct("terms")).alias("term"))
    occurs = stage(index.select("segment", "terms", "term_counts").mapInArrow(_terms, "segment string, term binary, n int")
                   .join(term.select("term").distinct(), "term", "left_semi"), "occurs")
    totals = stage(occurs.groupBy("term").agg(F.sum("n").alias("total")), "totals")
    rarest = term.join(totals, "term", "left").groupBy("query").agg(
        F.min_by("term", F.struct("total", "term")).alias("term"), F.count("total").alias("found"), F.count(F.lit(1)).alias("terms"))
    named = rarest.where("found = terms").select("query", "term").join(occurs.select("term", "segment"), "term")
    parts = max(1, -(-queries.count() // QUERIES_A_PART))
    return (named.join(queries.select("query", "terms"), "query")
            .groupBy("segment", F.pmod(F.xxhash64("query"), F.lit(parts)).alias("part"))
            .agg(F.collect_list(F.struct("query", "terms")).alias("queries")))


def _search(batches, mode, slop):
    for one in _rows(batches):
        row = {n: one.column(n)[0].as_py() for n in ("n_words", "terms", "term_counts", "postings", "queries")}
        seg, hits, found_in = Segment(row), [], {}
        for q in row["queries"]:
            terms = [seg.term.get(t, -1) for t in q["terms"]]
            if min(terms) < 0:
                continue
            found = seg.phrase(terms) if mode == "phrase" else seg.near(terms, slop)
            if len(found):
                span = np.arange(len(terms)) if mode == "phrase" else np.zeros(1, np.int64)
                hits.append((found[:, None] + span).ravel())
                for d in np.unique(seg.doc_of(found)).tolist():
                    found_in.setdefault(d, []).append(q["query"])
        if not hits:
            continue
        pos = np.unique(np.concatenate(hits))
        doc = seg.doc_of(pos)
        slots = np.unique(doc)
        cut = np.searchsorted(doc, slots[1:])
        name = one.column("segment")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(slots)), pa.array(slots, pa.int32()),
             pa.array([p - seg.start[d] for d, p in zip(slots, np.split(pos, cut))], pa.list_(pa.int64())),
             pa.array([found_in[d] for d in slots.tolist()], pa.list_(pa.int64()))],
            names=["segment", "slot", "at", "queries"])


def _matches(index: DataFrame, items: DataFrame, window, mode: str, slop: int) -> DataFrame:
    """segment, slot, at (word positions), items of every document with matches."""
    queries = build_queries(items, window)
    wanted = stage(_wanted(index, queries), "wanted")
    payload = index.select("segment", "n_words", "terms", "term_counts", "postings")
    hits = stage(payload.join(wanted, "segment").drop("part").mapInArrow(
        partial(_search, mode=mode, slop=slop), "segment string, slot int, at array<long>, queries array<long>"), "hits")
    owners = hits.select("segment", "slot", F.explode("queries").alias("query")).join(
        queries.select("query", F.explode("owners").alias("item")), "query")
    named = owners.groupBy("segment", "slot").agg(F.array_sort(F.collect_set("item")).alias("items"))
    places = hits.groupBy("segment", "slot").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"))
    return places.join(named, ["segment", "slot"], "left")


def _indexed_documents(index: DataFrame) -> DataFrame:
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "row_hash", "n_words")).alias("slot", "d"))
    return rows.select("segment", "slot", F.col("d.doc_ids").alias("doc_id"), "d.row_hash", "d.n_words")


def _report(index: DataFrame, matches: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    return (_indexed_documents(index).join(matches, ["segment", "slot"], "left")
            .select("doc_id", "row_hash", "n_words", F.coalesce(F.col("at"), F.array().cast("array<long>")).alias("at"),
                    F.coalesce(F.col("items"), none).alias("items")))


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per indexed document: n_words, ``at`` (hit word positions) and ``items`` with occurring windows."""
    return _report(index, _matches(index, items, window, "phrase", 0))


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = 20) -> DataFrame:
    """As ``phrase_matches``, for items whose distinct words all occur within ``slop`` words;
    ``at`` holds the first position of each smallest span."""
    return _report(index, _matches(index, items, None, "near", slop))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` without any item window, with their columns."""
    hit = phrase_matches(build_index(docs), items, window).where(F.size("at") > 0)
    return filter_by_rows(docs, stage(hit.select("doc_id", "row_hash"), "hits"), ["text"], keep=False)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    found = phrase_matches(build_index(documents(spark, sf_dir)), documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", F.size("at").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("at") > 0).alias("contaminated"))


ORACLE = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
ig AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM (SELECT item_id, w, least(10, len(w)) AS n FROM iw WHERE len(w) > 0))),
dg AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw CROSS JOIN (SELECT DISTINCT n FROM ig) WHERE len(w) >= n)),
m AS (SELECT dg.r, dg.n, dg.s, ig.item_id FROM dg JOIN ig ON dg.n = ig.n AND dg.g = ig.g),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM m) GROUP BY r),
i AS (SELECT r, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM m GROUP BY r)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h ON dw.r = h.r LEFT JOIN i ON dw.r = i.r
"""
