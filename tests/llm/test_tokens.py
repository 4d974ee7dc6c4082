import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import token_counts, token_planes, tokens

from . import helpers as H

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ALPHABET = list("aé ßΣσ\n\t \x1c\x85'!<|>09́​漢字AZ.,_") + ["<|endoftext|>", "'s", "the", "  ", "\xa0 ", " "]


def enc(name):
    return tokens.encoder(tokens.public_path(name))


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=60).map("".join))
def test_parts_and_chunks_equal_whole_text(name, text):
    e = enc(name)
    want = e.whole(text)
    assert e.piece_ids(text) == want
    assert e.resync(text, 12, 3) == want


@pytest.mark.parametrize("name", NAMES)
def test_long_texts_and_full_memo(name, monkeypatch):
    e = tokens.Encoder(tokens.public_path(name))
    monkeypatch.setattr(tokens, "MEMO_PARTS", 50)
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abcdeé.,") for _ in range(rng.randint(1, 80))) for _ in range(60))
             for _ in range(20)] + ["", "x" * 5000 + " " + "word " * 3000 + "é" * 4000]
    monkeypatch.setattr(tokens, "MEMO_BYTES", 30_000)
    for _ in range(3):
        assert [b.tolist() for b in e.batch(texts)] == [e.whole(t) for t in texts]
    assert e.resync(texts[-1], 1000, 10) == e.whole(texts[-1])


@pytest.mark.parametrize("name", NAMES)
def test_full_memo_keeps_what_is_asked_for_again(name, monkeypatch):
    e = tokens.Encoder(tokens.public_path(name))
    monkeypatch.setattr(tokens, "MEMO_PARTS", 100)
    rng, largest = random.Random(2), 0
    for _ in range(20):
        texts = ["often met " + " ".join("".join(rng.choice("abcde") for _ in range(9)) for _ in range(30))]
        assert [b.tolist() for b in e.batch(texts)] == [e.whole(t) for t in texts]
        largest = max(largest, len(e.number))
    assert largest <= 100 + 40
    e.trim()
    assert " met" in e.number and len(e.number) <= 50
    assert e.piece_ids("often met seldom met") == e.whole("often met seldom met")


def test_token_counts_of_odd_rows(spark):
    docs, e = H.odd_documents(spark), enc(NAMES[1])
    got = token_counts.token_counts(docs, chunk=1000, overlap=50).collect()
    want = [(i, len((t or "").encode()), n, n > 2048) for i, t, *_ in H.odd_rows() for n in [len(e.whole(t or ""))]]
    assert H.same_rows(got, want)
    assert token_counts.token_counts(H.no_documents(spark)).count() == 0


@pytest.mark.parametrize("bits", [False, True])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_planes_round_trip(bits, ids):
    a = np.array(ids, np.uint32)
    if len(a):
        assert (token_planes.unpack_planes(token_planes.pack_planes(a, bits), len(a), bits) == a).all()


@pytest.mark.parametrize("bits", [False, True])
def test_token_file_round_trip_and_random_access(spark, bits):
    docs, e = H.odd_documents(spark), enc(NAMES[0])
    segs = token_planes.write_token_file(docs, bits=bits, block_ids=64, segment_ids=500)
    rows = [r.asDict() for r in segs.orderBy("shard", "seq").collect()]
    stream = np.concatenate([token_planes.decode_range(r, 0, r["n_ids"]) for r in rows])
    for r in rows:
        for a, b in ((0, 1), (63, 65), (10, r["n_ids"]), (5, 5)):
            b = min(b, r["n_ids"])
            assert (token_planes.decode_range(r, a, b) == token_planes.decode_range(r, 0, r["n_ids"])[a:b]).all()
    got = sorted(token_planes.read_documents(segs).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(i for i, *_ in H.odd_rows() if i is not None)
    at = 0
    for r in got:
        assert r.start == at
        part = stream[at:at + r.n_tokens]
        assert part[-1] == 0 and r.ids_crc32 == zlib.crc32(part.astype("<u4").tobytes())
        at += r.n_tokens
    want = [(i, len(x), zlib.crc32(x.tobytes())) for i, t, *_ in H.odd_rows()
            for x in [np.array(e.whole(t or "") + [0], "<u4")]]
    assert H.same_rows([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], want)
    assert token_planes.read_documents(token_planes.write_token_file(H.no_documents(spark))).count() == 0


def test_glued_spaces_are_found_in_one_pass():
    """Every white-space character before a plain space is found, and nothing else is."""
    import re

    import pyarrow as pa
    import pyarrow.compute as pc

    from lakestrata.llm.tokens import GLUED, SPACE
    texts = [f"a{chr(c)} b" for c in range(0x3002) if not 0xD800 <= c < 0xE000] + ["a b", "", " ", "  ", "a \nb"]
    found = pc.match_substring_regex(pa.array(texts, pa.large_string()), GLUED).to_pylist()
    assert found == [bool(re.search(f"[{SPACE}] ", t)) for t in texts] and sum(found) > 20


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_the_memo_is_asked_once_a_part(name):
    """One look-up in the memo for a known part, and the ids of the whole texts, known parts or not."""
    from lakestrata.llm.tokens import Encoder, public_path

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

        def __contains__(self, k):
            Counted.asked += 1
            return super().__contains__(k)

        def __getitem__(self, k):
            Counted.asked += 1
            return super().__getitem__(k)
    enc = Encoder(public_path(name))
    texts = ["Plain words, caf\xe9s \xff and caf\xe9s! a-b", "x  y\t z", "", "words words \xa0 日本"]
    for _ in range(2):
        assert [x.tolist() for x in enc.batch(texts)] == [enc.whole(t) for t in texts]
    enc.number, parts = Counted(enc.number), list(enc.number)
    assert enc.numbers(parts).tolist() == list(range(len(parts)))
    assert Counted.asked == len(parts)
