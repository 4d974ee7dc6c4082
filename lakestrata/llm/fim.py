"""Fill-in-middle transformation with a learned rank index over token boundaries.

A text is cut into units (white space with the word after it; white space at
the end is one unit).  Where unit ``k`` ends is looked up by rank in an index of
all boundaries: ``fit`` covers them with linear pieces whose prediction is off
by at most ``ERROR`` bytes, and stores what is left over as one signed byte a
boundary.  A lookup predicts on the piece of its rank and adds the stored
residual, so it is exact whatever the rounding; the index takes one byte a
boundary instead of an eight-byte offset.  The boundaries of all texts of a slice
share one index (they only grow), and all cuts of the slice are looked up at once.

Forms (seeded by SHA-256 of ``seed:doc_id``): ``psm`` puts the suffix between prefix
and middle, ``spm`` the suffix first, ``plain`` leaves the text.  A text that
holds one of the sentinels stays plain, so ``restore`` needs nothing but the
output and its form.

Edge cases: a null or empty text has no unit and stays plain (output empty); a
text of white space is one unit; a null id hashes as the empty text; repeated
rows get equal results; an empty table gives an empty result; only doc_id and
text are read.  A very long text is one slice: 1 byte a boundary is kept, and
about eight times its size is held for a moment while the boundaries are found.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

SEED, ERROR = 42, 120                      # residuals fit a signed byte
PLAIN_FROM, SPM_BELOW = 50, 80
P, S, M = "<P>", "<S>", "<M>"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class RankIndex:
    """Exact offsets by rank: linear pieces within ``ERROR`` of every offset, and one residual byte a rank."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        self.first, self.base, self.slope = fit(offsets, error)
        self.residual = (offsets - self.predict(np.arange(len(offsets)))).astype(np.int8)

    def predict(self, rank: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.first, rank, side="right") - 1
        return self.base[piece] + np.rint(self.slope[piece] * (rank - self.first[piece])).astype(np.int64)

    def __getitem__(self, rank: np.ndarray) -> np.ndarray:
        return self.predict(rank) + self.residual[rank]


def fit(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first rank, offset there, slope) of linear pieces, greedily as long as one slope stays within ``error``.

    From the first point of a piece, every further one allows slopes between two bounds; the piece ends
    before the point that leaves no slope.  Points are tried in runs that double while they all fit.
    """
    first, base, slope, at, n = [], [], [], 0, len(offsets)
    while at < n:
        low, high, end, step = -np.inf, np.inf, at + 1, 64
        while end < n:
            run = np.arange(end, min(end + step, n))
            rise, width = offsets[run] - offsets[at], run - at
            lows = np.maximum(np.maximum.accumulate((rise - error) / width), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / width), high)
            bad = lows > highs
            stop = int(bad.argmax()) if bad.any() else len(run)
            if stop:
                low, high, end = lows[stop - 1], highs[stop - 1], end + stop
            if stop < len(run):
                break
            step *= 2
        first.append(at)
        base.append(int(offsets[at]))
        slope.append(0.0 if end == at + 1 else (low + high) / 2)
        at = end
    return np.array(first, np.int64), np.array(base, np.int64), np.array(slope)


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boundary offsets (ends of units, and the start of each text) of adjacent texts, and each text's first rank.

    ``data`` are the UTF-8 bytes, text ``i`` is ``offsets[i]:offsets[i + 1]``.
    """
    size = int(offsets[-1])
    ends = np.zeros(size + 1, bool)                     # ends[p]: a unit ends before byte p
    if size:
        space = _SPACE[data]
        ends[1:size] = ~space[:-1] & space[1:]
        filled = offsets[1:][offsets[1:] > offsets[:-1]]
        ends[filled] = True                             # the last unit of a text, white space or not
    at = np.flatnonzero(ends)
    # the start of a text is a boundary of its own, also where it is the end of the text before
    before = np.searchsorted(at, offsets[:-1], side="right")
    return np.insert(at, before, offsets[:-1]), before + np.arange(len(before))


def draw(doc_id, n: int, seed: int = SEED) -> tuple[int, int, str]:
    """(first cut, second cut, form before the checks of the text) for ``n`` units."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return a, b, "plain" if h3 % 100 >= PLAIN_FROM else "spm" if h4 % 100 < SPM_BELOW else "psm"


def arrange(prefix: str, middle: str, suffix: str, form: str) -> str:
    return f"{P}{prefix}{S}{suffix}{M}{middle}" if form == "psm" else f"{S}{suffix}{P}{prefix}{M}{middle}"


def restore(output: str, form: str) -> str:
    """The text that ``output`` was made of."""
    if form == "plain":
        return output
    one, two = (P, S) if form == "psm" else (S, P)
    left, rest = output[len(one):].split(two, 1)
    right, middle = rest.split(M, 1)
    return left + middle + right if form == "psm" else right + middle + left


def _transform(batches, seed):
    for batch in batches:
        for part in text_slices(batch, limit=4 << 20):
            ids = part.column("doc_id").to_pylist()
            texts = pa.array(part.column("text").fill_null("").cast(pa.large_binary()))
            _, offs, data = texts.buffers()
            offsets = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + len(texts) + 1]
            lo, hi = int(offsets[0]), int(offsets[-1])
            raw = np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
            offsets = offsets - lo
            at, first = boundaries(raw, offsets)
            index, n = RankIndex(at), np.diff(np.append(first, len(at))) - 1
            del at
            drawn = [draw(i, int(k), seed) for i, k in zip(ids, n)]
            cut = index[np.array([(r + a, r + b) for r, (a, b, _) in zip(first.tolist(), drawn)], np.int64).reshape(-1, 2)]
            forms, p_chars, m_chars, out = [], [], [], []
            for i, (x, y) in enumerate(cut.tolist()):
                text, form = bytes(raw[offsets[i]:offsets[i + 1]]), drawn[i][2]
                if form == "plain" or not text or any(s.encode() in text for s in (P, S, M)):
                    p, m, made, form = None, None, text.decode(), "plain"
                else:
                    x, y = x - int(offsets[i]), y - int(offsets[i])
                    p, m = text[:x].decode(), text[x:y].decode()
                    made = arrange(p, m, text[y:].decode(), form)
                forms.append(form)
                p_chars.append(None if p is None else len(p))
                m_chars.append(None if m is None else len(m))
                out.append(made)
            cols = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms), pa.array(p_chars, pa.int64()),
                    pa.array(m_chars, pa.int64()), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and the output text of every row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_transform, seed=seed),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def _restored(batches):
    for batch in batches:
        back = []
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            back += [hashlib.sha256(restore(o, f).encode()).hexdigest()
                     for o, f in zip(part.column("output").to_pylist(), part.column("form").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(back, pa.string())],
                                         names=[*batch.schema.names[:-1], "restored_sha256"])


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    made = fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), "output")
    kind = made.schema["doc_id"].dataType.simpleString()
    return made.mapInArrow(_restored, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, "
                                      "output_sha256 string, restored_sha256 string")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
d AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t),
c AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:least(x, y)], '') AS p,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:n], '') AS s
  FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""
