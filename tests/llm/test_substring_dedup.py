import hashlib
import random

import duckdb
import numpy as np
import pytest

from lakestrata.llm import substring_dedup as sd

from . import helpers as H


def brute(rows):
    words = [(i, H.WORD.findall(t or "")) for i, t in rows]
    first = {}
    key = lambda i: (i is None, 0 if i is None else i)
    for i, w in words:
        for k in range(len(w) - 49):
            seq = tuple(w[k:k + 50])
            first[seq] = min(first.get(seq, key(i)), key(i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] < key(i):
                gone.update(range(k, k + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def got(df):
    from pyspark.sql import functions as F
    return sd.dedup_substrings(df).select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()


def corpus(seed):
    """Passages of 40 to 400 words planted at shifted places, near copies, periodic texts, exact copies."""
    r = random.Random(seed)
    fresh = lambda n: [f"{r.choice('abcdefg')}{r.randrange(4000)}" for _ in range(n)]
    passages = [fresh(r.choice((40, 49, 50, 51, 60, 75, 76, 120, 400))) for _ in range(12)]
    rows = []
    for i in range(150):
        w = fresh(r.randrange(120))
        for _ in range(r.randrange(3)):
            p = list(r.choice(passages))
            a, b = sorted((r.randrange(len(p)), r.randrange(len(p))))
            p = p if r.random() < 0.5 else p[a:b]
            if r.random() < 0.3 and p:
                p[r.randrange(len(p))] = "changed"
            w += p + fresh(r.randrange(30))
        rows.append((r.randrange(120), r.choice((" ", "\n", " \t ")).join(w)))
    rows += [(500 + i, "same word " * n) for i, n in enumerate((20, 25, 26, 40, 100, 3000))]
    rows += [(600 + i, "x " * n) for i, n in enumerate((49, 50, 51, 75, 76, 200, 2000))]
    rows += [(None, rows[0][1]), (None, "x " * 60), (None, " ".join(passages[0])), (900, None), (901, ""), (902, " \n ")]
    rows += [rows[3]] * 3 + [(i, " ".join(passages[8] + passages[9])) for i in range(1000, 1030)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force_over_all_windows(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert H.same_rows(got(df), brute(rows))


def test_pieces_and_a_full_sketch_change_nothing(spark, monkeypatch):
    rows = corpus(4)
    data = np.frombuffer("".join(t or "" for _, t in rows).encode(), np.uint8)
    offsets = np.cumsum([0] + [len((t or "").encode()) for _, t in rows])
    whole, n = sd.word_hashes(data, offsets)
    monkeypatch.setattr(sd, "PIECE_BYTES", 97)
    cut, m = sd.word_hashes(data, offsets)
    assert (whole == cut).all() and (n == m).all()
    words = {}
    for h, w in zip(whole.tolist(), [w for _, t in rows for w in H.WORD.findall(t or "")]):
        assert words.setdefault(w, h) == h
    assert len(set(words.values())) == len(words)
    # workers import the module anew, so run the passes here
    import pyarrow as pa
    monkeypatch.setattr(sd, "PIECE_WORDS", 64)

    class Bits:
        value = b"\xff" * (2 << 15)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows]),
                                        pa.array(range(len(rows)), pa.int64())], names=["doc_id", "text", "row_hash"])
    some = pa.Table.from_batches(sd._bundles([batch], Bits, 18)).to_pylist()
    windows = {(r["row_hash"], r["lo"] + k) for r in some for k in range(r["n"])}
    assert windows == {(j, k) for j, (_, t) in enumerate(rows) for k in range(len(H.WORD.findall(t or "")) - 49)}
    spans = {}
    for r in some:
        w = H.WORD.findall(rows[r["row_hash"]][1])[r["lo"]:r["lo"] + r["n"] + 49]
        assert spans.setdefault((r["r1"], r["r2"], r["n"]), w) == w


def test_sketch_only_overestimates():
    import pyarrow as pa
    rows = corpus(5)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows]),
                                        pa.array(range(len(rows)), pa.int64())], names=["doc_id", "text", "row_hash"])
    halves = [list(sd._sketch([batch.slice(a, n)], 18)) for a, n in ((0, 100), (100, len(rows)))]
    slices = pa.Table.from_batches(halves[0] + halves[1]).sort_by([("row", "ascending"), ("slice", "ascending")])
    bits = np.zeros((2, 1 << 15), np.uint8)
    for b in sd._merge(slices.to_batches()):
        for row, at, x in zip(*(c.to_pylist() for c in b.columns)):
            assert at == 0
            bits[row] = np.frombuffer(x, np.uint8)

    class Bits:
        value = bits.tobytes()
    kept = {(r["row_hash"], r["lo"] + k) for b in sd._bundles([batch], Bits, 18) for r in b.to_pylist() for k in range(r["n"])}
    count = {}
    for j, (_, t) in enumerate(rows):
        w = H.WORD.findall(t or "")
        for k in range(len(w) - 49):
            count.setdefault(tuple(w[k:k + 50]), set()).add((j, k))
    for places in count.values():
        if len(places) > 1:
            assert places <= kept
    single = [p for places in count.values() if len(places) == 1 for p in places]
    assert sum(p in kept for p in single) < 0.5 * len(single)


def test_odd_rows_empty_table_and_sql(spark, tmp_dir):
    got_rows = sd.dedup_substrings(H.odd_documents(spark))
    assert got_rows.columns == ["doc_id", "n_words", "n_removed", "runs", "text"]
    plain = [(i, t) for i, t, *_ in H.odd_rows()]
    assert H.same_rows(got(H.odd_documents(spark)), brute(plain))
    assert sd.dedup_substrings(H.no_documents(spark)).collect() == []
    rows = corpus(6)
    H.write(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents.parquet/*.parquet'")
    assert H.same_rows(con.sql(sd.ORACLE).fetchall(), brute(rows))
    assert H.same_rows(sd.query(spark, tmp_dir).collect(), brute(rows))
