import random

import numpy as np
import xxhash

from lakestrata.llm import simhash

from . import helpers as H


def brute(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = H.WORD.findall(text)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(prints):
    a = np.array(prints, np.uint64)
    return H.components(prints, lambda i: (i + 1 + np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 2)).tolist())


def test_golay_table_is_the_perfect_code():
    _, errors = simhash._golay()
    sizes = np.bincount((errors != 0).sum(axis=1), minlength=7)
    assert sizes.tolist() == [1, 23 + 253, 0, 0, 0, 0, 1771]  # own codeword within 2, or six within 4


def test_words_one_bit_apart_share_a_codeword():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 1 << 22, 4000)
    index, use = simhash.codeword_indices(v)
    near, near_use = simhash.codeword_indices(v ^ (1 << rng.integers(0, 22, 4000)))
    for i in range(len(v)):
        assert set(index[i][use[i]]) & set(near[i][near_use[i]])


def test_links_connect_exactly_what_brute_force_connects(spark):
    rng, r = np.random.default_rng(1), random.Random(2)
    prints = {int(x) for x in rng.integers(0, 2**64 - 1, 150, dtype=np.uint64)} | {0, 2**63, 2**63 + 1}
    base = sorted(prints)
    for x in base[:60]:
        for _ in range(4):
            x ^= 1 << r.randrange(64)
            prints.add(x)
    for _ in range(300):   # one full key: equal first segments, scattered rest
        prints.add(base[0] & ((1 << 43) - 1) | r.getrandbits(9) << 50)
    for _ in range(300):   # a ball around one fingerprint
        x = base[1]
        for _ in range(r.choice((1, 2, 3, 4))):
            x ^= 1 << r.randrange(64)
        prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    got = {}
    for row in simhash.components(simhash.links(df)).collect():
        got.setdefault(row.root, set()).add(row.node % 2**64)
    want = {}
    for p, root in zip(prints, brute_roots(prints)):
        want.setdefault(root, set()).add(p)
    assert {frozenset(s) for s in got.values()} == {frozenset(s) for s in want.values() if len(s) > 1}


def test_components_of_a_chain_a_star_and_no_edges(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)]
    random.Random(0).shuffle(edges)
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[200 + i] for i in range(50)} == {100}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    rows = H.odd_rows()
    prints = [brute(t) for _, t, *_ in rows]
    roots = brute_roots(prints)
    ids = {}
    for (i, *_), root in zip(rows, roots):
        if i is not None:
            ids[root] = min(i, ids.get(root, i))
    want = [(i, f"{p:016x}", ids.get(root)) for (i, *_), p, root in zip(rows, prints, roots)]
    docs = H.odd_documents(spark)
    assert H.same_rows(simhash.near_duplicates(docs).collect(), want)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == len(set(roots))
    by_group = {roots[k]: None for k in range(len(rows))}
    for r in got:
        k = next(k for k, row in enumerate(rows) if (row[0], row[1]) == (r.doc_id, r.text))
        assert by_group.pop(roots[k], 1) is None and r.doc_id == ids.get(roots[k]) and r.copies == "extra copies"
    assert simhash.near_duplicates(H.no_documents(spark)).count() == 0
    assert simhash.one_per_group(H.no_documents(spark)).count() == 0


def test_pieces_change_no_fingerprint(monkeypatch):
    r = random.Random(4)
    texts = [" ".join(r.choice("ab cd E\x85 é漢 word\n\n x\t".split(" ")) for _ in range(r.randrange(300))) for _ in range(60)]
    whole = [simhash.fingerprint(t) for t in texts]
    assert whole == [brute(t) for t in texts]
    for size in (1, 3, 50):
        assert [simhash.fingerprint(t) for t in texts] == whole
        assert all([w for p in simhash.word_pieces(t.encode(), size) for w in p] == t.encode().split() for t in texts)
        monkeypatch.setattr(simhash, "word_pieces", lambda raw, n=size, f=simhash.word_pieces: f(raw, n))


def test_one_per_group_with_a_map_column(spark):
    df = spark.createDataFrame([(1, "a b c d", {"x": 1}), (1, "a b c d", None), (2, "a b c d", {"x": 2}), (3, "other words here now", {})],
                               "doc_id long, text string, extra map<string,int>")
    got = simhash.one_per_group(df)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]
