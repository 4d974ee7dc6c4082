import hashlib
import random
import re

import numpy as np
import pytest

from lakestrata.llm import fim

from . import helpers as H

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(u), "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 80:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("error", [0, 1, 5, 120])
def test_index_is_exact_and_its_pieces_keep_the_bound(error):
    r = np.random.default_rng(error)
    cases = [np.zeros(0, np.int64), np.zeros(1, np.int64), np.arange(500) * 7, np.cumsum(r.integers(0, 12, 5000)),
             np.cumsum(np.where(r.random(3000) < 0.01, 100_000, r.integers(1, 9, 3000)))]
    for offsets in cases:
        index = fim.RankIndex(offsets, error)
        ranks = r.integers(0, max(1, len(offsets)), 400) if len(offsets) else np.zeros(0, np.int64)
        assert (index[ranks] == offsets[ranks]).all()
        assert (np.abs(offsets - index.predict(np.arange(len(offsets)))) <= error + 1).all()
    assert len(fim.RankIndex(np.arange(10_000) * 7, error).first) == 1


def test_texts_equal_brute_force(spark):
    r = random.Random(3)
    parts = ["a", "bc", "é漢", " ", "\n\n", "\t ", "\x85", "<P", "S>", "<M>", "<", "long" * 50, " "]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randrange(60)))) for i in range(400)]
    rows += [(400 + i, "w " * r.randrange(3000) + r.choice(["", " ", "end"])) for i in range(60)]
    rows += [(None, "null id " * 5), (7, None), (7, ""), (7, " \n "), (9, "x" * 300_000 + " " + "y z " * 50_000)]
    got = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(i, *brute(i, t)) for i, t in rows]
    assert H.same_rows(got, want)
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    for (i, text) in rows:
        _, form, _, _, out = brute(i, text)
        assert fim.restore(out, form) == (text or "")


def test_odd_rows_empty_table_and_query(spark, tmp_dir):
    cols = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = fim.fill_in_middle(H.odd_documents(spark))
    assert got.columns == cols
    assert H.same_rows(got.collect(), [(i, *brute(i, t)) for i, t, *_ in H.odd_rows()])
    assert fim.fill_in_middle(H.no_documents(spark)).collect() == []
    H.write(H.odd_documents(spark), f"{tmp_dir}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t, *_ in H.odd_rows():
        n, form, p, m, out = brute(i, t)
        want.append((i, n, form, p, m, sha(out), sha(t or "")))
    assert H.same_rows(fim.query(spark, tmp_dir).collect(), want)
