"""Quality rules, decontamination, personal data and line dedup against brute force."""

import hashlib
import os
import random
import re
import tempfile
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from lakestrata.llm import decontamination, line_dedup, pii, quality_rules

from . import helpers as H

SF = "/root/testdata/sf0.001"


def base_statistics(text):
    text = text or ""
    words, seen, dup = H.WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if H.WORD.search(line):
            dup += line in seen
            seen.add(line)
    count, hit = Counter(zip(words, words[1:], words[2:])), set()
    for i in range(len(words) - 2):
        if count[tuple(words[i:i + 3])] > 1:
            hit.update((i, i + 1, i + 2))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_quality_statistics_and_hard_rules(spark):
    docs = H.odd_documents(spark).unionByName(spark.read.parquet(f"{SF}/documents.parquet"), allowMissingColumns=True)
    rows = docs.select("doc_id", "text").collect()
    got = quality_rules.judge(docs).select("doc_id", *quality_rules.BASE, "base_failed").collect()
    want = [(r.doc_id, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]) for r in rows for b in [base_statistics(r.text)]]
    assert H.same_rows(got, want)


def test_outliers_are_rejected_and_ordinary_rows_kept(spark):
    rng = np.random.default_rng(0)
    vocab = ["word%d" % k for k in range(400)]
    text = lambda n: " ".join(rng.choice(vocab, n))
    rows = [(i, text(int(rng.integers(80, 300))), "en", "a" if i % 3 else None) for i in range(600)]
    odd = [(1000 + i, " ".join(w + "&&&" for w in text(100).split()), "en", "a") for i in range(30)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.accepted_documents(docs).collect()}
    assert kept == {i for i, *_ in rows}


def test_length_alone_rejects_no_document(spark):
    rng = np.random.default_rng(2)
    vocab = ["word%d" % k for k in range(400)]
    text = lambda n: " ".join(rng.choice(vocab, n))
    rows = [(i, text(int(rng.integers(80, 300))), "en", "a") for i in range(300)] + [(300, text(500_000), "en", "a")]
    odd = [(1000, " ".join(w + "&&&" for w in text(50_000).split()), "en", "a")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert {i for i, r in got.items() if r.kept} == {i for i, *_ in rows}
    # against the distance of the other statistics alone
    stats = quality_rules.stage(quality_rules.measure(docs), "statistics")
    model = quality_rules.robust_model(stats).first()
    cov = np.linalg.inv(np.array(model["prec"]).reshape(6, 6))[:5, :5]
    off = np.array([got[300][d] for d in quality_rules.DIMS[:5]]) / quality_rules.SCALE - model["mean"][:5]
    assert np.isclose(got[300].d2, off @ np.linalg.inv(cov) @ off, rtol=1e-6)


def test_a_source_of_two_fifths_junk_is_cleaned(spark):
    rng = np.random.default_rng(1)
    vocab = ["word%d" % k for k in range(400)]
    text = lambda n: " ".join(rng.choice(vocab, n))
    rows = [(i, text(int(rng.integers(80, 300))), "en", "b" if i < 300 else "a") for i in range(600)]
    odd = [(1000 + i, " ".join(w + "&&&" if rng.random() < 0.9 else w for w in text(100).split()), "en", "b") for i in range(200)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.accepted_documents(docs).collect()}
    assert kept == {i for i, *_ in rows}


def test_concentration_matches_numpy_on_one_group(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 1, (400, 6)) @ np.diag([300, 900, 900, 900, 500, 900])).astype(int)
    x[:40] += 9000
    rows = [("len", "sa", False, *map(int, r)) for r in x]
    schema = "lkey string, skey string, base_failed boolean, " + ", ".join(f"{d} long" for d in quality_rules.DIMS)
    model = quality_rules.robust_model(spark.createDataFrame(rows, schema)).first()
    inner = x[40:] / quality_rules.SCALE
    assert np.allclose(model["mean"], inner.mean(axis=0), atol=0.15)
    ridge = np.diag(quality_rules.RIDGE)
    assert np.allclose(np.diag(np.linalg.inv(np.array(model["prec"]).reshape(6, 6)) - ridge), inner.var(axis=0), rtol=0.35)


def test_quality_rules_without_rows(spark):
    assert quality_rules.judge(H.no_documents(spark)).count() == 0
    docs = H.odd_documents(spark)
    assert quality_rules.accepted_documents(docs).columns == docs.columns


LUHN = lambda s: sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, s[::-1]))) % 10 == 0
BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s, d: 14 <= len(d) <= 19 and LUHN(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 10 <= len(d) <= 15))


def base_spans(text):
    found = []
    for rank, (kind, pattern, valid) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            if valid(m.group(), re.sub("[^0-9]", "", m.group())):
                found.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def pii_texts():
    import random
    r = random.Random(5)
    parts = ["a", "b.c", "@", ".", "1", "22", "255", "256", "4111 1111 1111 1111", "4111-1111-1111-1111", " ", "  ", "-",
             "+", "+1", "(", ")", "é", "漢", "\n", "x@y.z", "_", "%", "1.2.3.4", "01.002.3.4", "999", "5500005555555559"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(1500)]
    long = ["1 " * 20_000, "5" * 60_000, "a" * 60_000 + "@", "+1" + " " * 60_000, "a@b" + ".c" * 20_000, "1." * 30_000,
            "x@y.z " * 1_000]
    return texts + long + [None, ""]


def test_base_spans_equal_the_plain_patterns(spark, tmp_dir):
    rows = list(enumerate(pii_texts())) + [(None, "q@w.e")]
    H.write(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: r for r in pii.query(spark, tmp_dir).collect()}
    for i, t in rows:
        want = base_spans(t)
        n = Counter(s.split(":")[0] for s in want.split(",") if s)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t, want, r.spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k, *_ in BASE)
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


@pytest.mark.parametrize("text, kind, found", [
    ("pay to DE89 3704 0044 0532 0130 00 today", "iban", True), ("GB82WEST12345698765432", "iban", True),
    ("GB82WEST12345698765433", "iban", False), ("ssn: 123-45-6789", "national_id", True),
    ("part 123-45-6789", "national_id", False), ("ssn 000-45-6789", "national_id", False),
    ("call 212 555 1234", "phone_local", True), ("serial 212 555 1234", "phone_local", False)])
def test_added_kinds(spark, text, kind, found):
    row = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (kind in [s.kind for s in row.added]) == found
    assert all(text[s.start:s.end] == s.text for s in row.added)


def mod97(s):
    s = s.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


ADDED_VALID = {"iban": lambda s: mod97(s) == 1, "phone_local": lambda s: True,
               "national_id": lambda s: not re.search("^(?:000|666|9)|-00-|-0000$", s)}


def added_spans(text):
    out = []
    for rank, k in enumerate(pii.ADDED_KINDS, len(pii.BASE_KINDS)):
        pattern = re.compile(k.pattern)
        for m in pattern.finditer(text or ""):
            after = pattern.search(text, m.end())
            before = max((x.end() for x in pattern.finditer(text) if x.end() <= m.start()), default=0)
            near = (text[max(before, m.start() - pii.BEFORE):m.start()] + " "
                    + text[m.end():min(m.end() + pii.AFTER, after.start() if after else len(text))]).lower()
            score = min(1.0, k.base + k.checksum + 0.3 * bool(re.search(rf"(?<![a-z])(?:{'|'.join(k.context)})", near)))
            if ADDED_VALID[k.name](m.group()) and score >= pii.THRESHOLD:
                out.append((m.start(), rank, k.name, m.end(), m.group(), round(score, 6)))
    return sorted(out)


def test_added_spans_and_scores_equal_plain_python(spark):
    r = random.Random(11)
    parts = ["ES91 2100 0418 4502 0005 1332", "es9121000418450200051332", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432",
             "NO93 8601 1117 947", "123-45-6789", "000-12-3456", "212 555 1234", "(212) 555-1234", "BANK", "OK", "please", "ssn", "call",
             "iban", "konto", " ", " ", ", ", "\n", "x", "9", "é漢"]
    texts = [" ".join(r.choice(parts) for _ in range(r.randint(0, 12))) if k % 2 else
             "".join(r.choice(parts) for _ in range(r.randint(0, 12))) for k in range(1200)]
    texts += ["ES91 2100 0418 4502 0005 1332 please", "ES91 2100 0418 4502 0005 1332 BANK", "ES91 2100 0418 4502 0005 1332 OK",
              "es91 2100 0418 4502 0005 1332"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: [(s.start, s.rank, s.kind, s.end, s.text, round(s.score, 6)) for s in x.added]
           for x in pii.personal_data(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == added_spans(t), t
    assert all([s[2] for s in got[i]] == ["iban"] for i in range(1200, 1204))


def test_work_grows_with_the_text_not_with_its_square(spark):
    """One text with 200,000 addresses, some of them over a chunk's edge."""
    import time
    n = 200_000
    text = "".join(f"u{k % 7}@ex.co " for k in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    row = pii.personal_data(df).selectExpr("size(base) n", "base[0] a", f"base[{n - 1}] z", f"base[{pii.CHUNK}] m").first()
    assert time.time() - began < 40
    assert row.n == n and (row.a.start, row.a.end, row.z.end) == (0, 8, len(text) - 1)
    assert (row.m.start, row.m.text) == (9 * pii.CHUNK, f"u{pii.CHUNK % 7}@ex.co")


def test_personal_data_runs_without_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = pii.personal_data(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.personal_data(H.no_documents(spark)).count() == 0


def brute_windows(docs, items, n=10):
    w = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+",
                             "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = defaultdict(set)
    for item, t in items:
        x = w(t)
        for i in range(max(1, len(x) - n + 1) if x else 0):
            windows[tuple(x[i:i + n])].add(item)
    out = []
    for doc, t in docs:
        x, hit, names = w(t), set(), set()
        for g, who in windows.items():
            for i in range(len(x) - len(g) + 1):
                if tuple(x[i:i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    names.update(str(k) for k in who if k is not None)
        out.append((doc, len(x), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def test_decontamination_of_odd_rows_in_small_segments_and_parts(spark, tmp_dir, monkeypatch):
    passage = "the dog while it rained all day long in the old town"
    items = [(1, "x " + passage), (10, "Two WORDS"), (2, "two words"), (3, None), (4, ""), (None, "one"), (5, passage),
             (5, passage), (6, "lorem ipsum dolor " * 5), (7, "never seen words at all")]
    docs = [(i, t) for i, t, *_ in H.odd_rows()] + [(20, "says: THE dog, while it rained all day long in the old town!")]
    df = H.odd_documents(spark).select("doc_id", "text").union(spark.createDataFrame(docs[-1:], "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_windows(docs, items)
    for part in (1 << 20, 3):
        monkeypatch.setattr(decontamination, "QUERIES_A_PART", part)
        index = decontamination.build_index(df, 300)
        got = [(r.doc_id, r.n_words, len(r["at"]), len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
                bool(r["at"])) for r in decontamination.phrase_matches(index, bench, 10).collect()]
        assert H.same_rows(got, want)
    docs2 = H.odd_documents(spark)
    clean = decontamination.decontaminate(docs2, bench)
    assert clean.columns == docs2.columns
    hit = [r[0] for r in want if r[5]]
    assert clean.count() == len(H.odd_rows()) - sum(1 for r in brute_windows([(i, t) for i, t, *_ in H.odd_rows()], items) if r[5])
    assert hit
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(docs2, none).count() == len(H.odd_rows())
    assert decontamination.decontaminate(H.no_documents(spark), bench).count() == 0


def test_proximity_matches_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(["a x b y c", "c b a", "a b", "a . . a x x c b", "b q q q q q q a c", "c a a a b"])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    query = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for slop in (3, 5, 8):
        got = {r.doc_id for r in decontamination.proximity_matches(
            decontamination.build_index(df, 40), query, slop).where("size(at) > 0").collect()}
        want = {i for i, t in docs for w in [decontamination.words(t)]
                if any({b"a", b"b", b"c"} <= set(w[k:k + slop]) for k in range(len(w)))}
        assert got == want


def test_line_dedup_removes_repeated_chunks_only(spark):
    lines = [f"line number {k} of the shared part" for k in range(12)]
    shared, long = "\n".join(lines), " ".join(f"w{k}" for k in range(60))
    code = ["int f(int a) {\n  for (;;) {\n    a += %d * b%d;\n    c%d(a);\n  }\n}" % (k, k, k) for k in range(4)]
    docs = [(1, f"start one\n{shared}\nend one"), (2, f"start\ntwo here\n{shared}\nend two"), (3, shared), (4, "only\nmine\nhere"),
            (5, f"a\n{long}\nb"), (6, f"c d\n{long}\ne f"), (7, "short line"), (8, "short line"), (9, None), (9, None), (10, ""),
            (3, shared), (11, "z\n" * 500), (12, "\n\n".join(code)), (13, f"x\n\n{shared}\n\n\ny")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = line_dedup.dedup_lines(df).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) and not by[1].runs and by[1].text == docs[0][1]
    assert by[2].text == "start\ntwo here\nend two" and by[3].text == "" and by[3].kept_in == [1]
    assert by[6].text == "c d\ne f" and by[5].text == docs[4][1] and by[9].text is None and by[10].text == ""
    assert by[8].text == "short line" and by[12].text == docs[13][1]          # short repeats and code stay
    assert by[13].text == "x\n\n\n\ny" and by[11].text.count("z") <= line_dedup.MOST_LINES + 1
    odd = line_dedup.dedup_lines(H.odd_documents(spark))
    assert odd.columns == ["doc_id", "n_lines", "runs", "kept_in", "text"] and odd.count() == len(H.odd_rows())
    assert line_dedup.dedup_lines(H.no_documents(spark)).count() == 0


def test_boundaries_resist_shifts():
    """Whatever precedes a passage, its chunks are the same from the first whole one on."""
    r = random.Random(8)
    passage = [f"{r.random()} some words {k}".encode() for k in range(40)]
    want = None
    for shift in range(12):
        before = [f"{r.random()} other words here".encode() for _ in range(shift)]
        inner = {(a - shift, b - shift) for a, b in line_dedup.chunks(before + passage) if a > shift}
        want = inner if want is None else want
        assert len(inner ^ want) <= 2 and len(inner) > 20
    for width in (1, 2, 5):
        h = [r.getrandbits(64) for _ in range(30)]
        rolled = line_dedup.rolling(h, width)
        for i in range(width - 1, 30):
            direct = 0
            for x in h[i - width + 1:i + 1]:
                direct = (direct * line_dedup._BASE + x) & (1 << 64) - 1
            assert rolled[i] == direct


def repeated_runs(docs):
    """Lines to remove by trying every run of lines of every text."""
    blank = lambda line: not H.WORD.search(line)
    places = defaultdict(set)
    for i, t in docs:
        lines = t.split("\n")
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = lines[a:b]
                worded = sum(not blank(x) for x in run)
                if not blank(run[0]) and not blank(run[-1]) and (worded > 1 or len(" ".join(run).split()) >= 50):
                    places[tuple(run)].add((i, a, b))
    gone = defaultdict(set)
    for found in places.values():
        for i, a, b in sorted(found)[1:]:
            gone[i].update(range(a, b))
    return gone


def test_line_dedup_removes_planted_passages_and_repeated_runs_only(spark):
    rng = np.random.default_rng(5)
    r = random.Random(6)
    vocab = [f"line {k} of the common kind" for k in range(40)] + [" ".join(f"long{k}x{j}" for j in range(50 + k)) for k in range(5)] + ["", " \t"] * 4
    docs = [(k, "\n".join(rng.choice(vocab, int(rng.integers(1, 12))))) for k in range(60)]
    planted = {}
    for p in range(60):
        n = r.choice((2, 2, 3, 3, 4, 6, 9, 15))
        lines = [" ".join(f"p{p}k{k}w{j}" for j in range(-(-60 // n))) for k in range(n)]
        for copy in range(3):
            k = 60 + 3 * p + copy
            before = [f"own words of {k} before {x}" for x in range(r.randrange(4))]
            body = "\n\n".join(lines) if p % 3 == 0 else "\n".join(lines)
            after = [f"own words of {k} after {x}" for x in range(r.randrange(4))]
            docs.append((k, "\n".join([*before, body, *after])))
            if copy:
                planted[k] = (len(before), len(before) + len(body.split("\n")))
    rows = {x.doc_id: x for x in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    allowed, text = repeated_runs(docs), dict(docs)
    hit = whole = 0
    for i, x in rows.items():
        gone = {k for s in x.runs for k in range(s.first_line, s.first_line + s.n_lines)}
        assert gone <= allowed[i]                       # only lines of repeated runs, never of a first copy alone
        assert x.text == "\n".join(y for k, y in enumerate(text[i].split("\n")) if k not in gone)
        assert all(s.first_line + s.n_lines < t.first_line for s, t in zip(x.runs, x.runs[1:]))
        if i in planted:
            whole += planted[i][1] - planted[i][0]
            hit += len(gone & set(range(*planted[i])))
            assert not gone or gone == set(range(*planted[i]))
    assert hit >= 0.95 * whole
    kept = {y for x in rows.values() for y in (x.text or "").split("\n")}
    assert all(y in kept for _, t in docs for y in t.split("\n"))     # a copy of every line stays


def test_line_dedup_compares_bytes_when_hashes_clash(spark, monkeypatch):
    real = line_dedup._chunk_rows

    def clash(batches, wanted, bits):
        import pyarrow as pa
        if wanted is not None:
            wanted = type("All", (), {"value": b"\xff" * (1 << bits - 3)})
        for b in real(batches, wanted, bits):
            k = b.schema.names
            cols = [pa.array([7] * b.num_rows, pa.int64()) if n in ("k1", "k2") else b.column(n) for n in k]
            yield pa.RecordBatch.from_arrays(cols, names=k)
    monkeypatch.setattr(line_dedup, "_chunk_rows", clash)
    docs = [(1, "a b c\nc d e"), (2, "a b c\nc d e"), (3, "e f g\ng h i"), (4, "i j k\nk l m"), (5, "e f g\ng h i")]
    found = line_dedup.repeated_chunks(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_line, r.n_lines, r.kept_in) for r in found} == {(2, 0, 2, 1), (5, 0, 2, 3)}


@pytest.mark.parametrize("module", [decontamination])
def test_oracle_on_odd_rows(spark, module):
    folder = tempfile.mkdtemp(prefix="ls-test-")
    con = duckdb.connect()
    H.write(H.odd_documents(spark).select("doc_id", "text", "lang", "source").coalesce(1), f"{folder}/documents.parquet")
    H.write(spark.createDataFrame([(1, "two words"), (2, "the old town")], "item_id long, text string").coalesce(1),
            f"{folder}/benchmark.parquet")
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(folder, t)}.parquet/*.parquet')")
    got = module.query(spark, folder)
    want = con.sql(module.ORACLE)
    assert got.columns == want.columns and H.same_rows(got.collect(), want.fetchall())
