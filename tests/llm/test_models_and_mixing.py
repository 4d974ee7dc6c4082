"""Mixing, the two classifiers, the pipeline and the registration guard."""

import os
import shutil
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import common, mixing, quality_classifier, toxicity
from lakestrata.llm.training import labelled_sample

from . import helpers as H

SF = "/root/testdata/sf0.01"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def fill(sizes, weights, epochs=3.0):
    """Water-filling by repeated clamping."""
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(epochs * sizes[i] for i in capped)
        share = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        over = {i for i in range(len(sizes)) if i not in capped and weights[i] * rest / share >= epochs * sizes[i]}
        if not over:
            return [epochs * s if i in capped else weights[i] * rest / share for i, s in enumerate(sizes)]
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 1], [5, 0, 7, 1000, 3, 2, 50], [0, 0], [1] * 20 + [500]])
def test_water_fill(spark, sizes):
    rows = [(i, s, float((5, 2, 1)[i % 3])) for i, s in enumerate(sizes)]
    got = mixing.water_fill(spark.createDataFrame(rows, "i long, size long, weight double")).orderBy("i").collect()
    assert np.allclose([r.target for r in got], fill(sizes, [w for *_, w in rows]))
    assert sum(r.target for r in got) == pytest.approx(sum(sizes))


def test_mix_of_odd_rows(spark):
    docs = H.odd_documents(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(H.odd_rows())
    words = {(i, s): 0 for i, t, _, s, _ in H.odd_rows()}
    for r in rows:
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size
        words[(r.doc_id, r.source)] = r.size
    by = {}
    for r in rows:
        t = by.setdefault(r.source, [0, r.target, 0])
        t[0] += r.taken
        t[2] = max(t[2], r.size)
    assert all(abs(t[0] - t[1]) <= t[2] for t in by.values())
    assert H.same_rows(rows, mixing.mix(docs).collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(H.no_documents(spark)).count() == 0 and mixing.mixed_documents(H.no_documents(spark)).count() == 0


def test_mix_runs_without_python_and_equals_its_sql(spark):
    out = mixing.query(spark, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(mixing.ORACLE)
    assert out.columns == want.columns and H.same_rows(out.collect(), want.fetchall())


def auc(score, label):
    order = np.argsort(np.argsort(score))
    pos = label == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def labelled(spark, name):
    return {r.doc_id: r[name] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}


@pytest.mark.parametrize("module, label, fold, least", [
    (quality_classifier, "quality", lambda c: c % 5 == 0, 0.98), (toxicity, "toxic", lambda c: c % 3 == 1, 0.93)])
def test_held_out_accuracy(spark, module, label, fold, least):
    rows = module.query(spark, "/root/testdata/sf0.1").collect()
    want = labelled(spark, label)
    assert all(r.held_out == fold(zlib.crc32(str(r.doc_id).encode())) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= module.THRESHOLD) for r in rows)
    test = [(r.score, want[r.doc_id]) for r in rows if r.held_out and want.get(r.doc_id) is not None]
    score, y = map(np.array, zip(*test))
    assert auc(score, y) >= least


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_classifiers_on_odd_rows(spark, module):
    docs = H.odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 0, 0), (None, 1, 1), (6, None, None), (7, 5, 5), (8, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        model = module.fit(docs, lab, F.lit(True))
        rows = module.score(docs, model, F.lit(False)).collect()
        assert len(rows) == len(H.odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows} == {0.5}
    assert module.score(H.no_documents(spark), model, F.lit(False)).count() == 0


def test_unseen_misspellings_share_subwords(spark):
    rng = np.random.default_rng(0)
    plain = ["the", "house", "river", "green", "walks", "under", "stone", "cloud", "often", "quiet"]
    rows = [(i, " ".join(rng.choice(plain, 30).tolist() + (["stupidity", "stupidly"] if i % 2 else [])), i % 2)
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs, F.lit(True))
    score = toxicity.Scorer(model).score
    assert score("the quiet house stuupid stupidd") > score("the quiet house marvel garden") + 0.1


def test_sample_is_bounded(spark):
    docs = spark.range(100).select((F.col("id") % 10).alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.range(10).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    got = labelled_sample(docs, labels, "quality", F.lit(True), rows=7)
    assert got.count() == 7
    assert labelled_sample(docs, labels, "quality", F.col("doc_id") > 5, rows=1000).count() == 40


def test_pipeline_stages_on_odd_rows_and_no_rows(spark, tmp_dir):
    import corpus_pipeline
    H.write(spark.createDataFrame([(1, "two words")], "item_id long, text string"), f"{tmp_dir}/benchmark.parquet")
    for make in (H.odd_documents, H.no_documents):
        H.write(make(spark), f"{tmp_dir}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
        for name, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, docs, tmp_dir)
            assert out.columns == docs.columns, name
            out.count()
        assert corpus_pipeline.run(spark, tmp_dir).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    docs, n = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES[:3]:
        docs = common.stage(step(spark, docs, SF), "test-stage")
        n.append(docs.count())
    assert 1000 > n[0] > n[1] > n[2] > 600
    assert corpus_pipeline.run(spark, SF).count() > 500


def test_the_rest_works_without_the_subpackage(tmp_dir):
    """A copy of the repository without llm/ and corpus_pipeline.py still imports and lists the other queries."""
    copy = f"{tmp_dir}/copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') for k in q), 'pipeline' in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[1:] == ["False", "False"], out.stderr


def test_release_removes_staged_tables(spark):
    df = common.stage(spark.range(3), "gone")
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    common.release(spark)
    assert not os.path.exists(path)


def plain_quality_features(text):
    """Hashed word and shape 1- and 2-grams, one at a time."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shape = [bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in w)
             for w in (text or "").encode().split()]
    w, s, m = [zlib.crc32(x) for x in low], [zlib.crc32(x) * 0x85EBCA6B % 2**32 for x in shape], 2**32
    grams = w + s
    for k, x in enumerate((w, s), 1):
        grams += [(a * 0x9E3779B1 % m) ^ (b + k) % m for a, b in zip(x, x[1:])]
    ids = [(h ^ h >> 15) & (1 << quality_classifier.BITS) - 1 for h in grams]
    ids += [0] * sum(a == b for a, b in zip(w, w[1:]))
    count = {i: ids.count(i) for i in set(ids)}
    size = sum(n * n for n in count.values()) ** 0.5
    return {i: n / size for i, n in count.items()}


def test_scores_equal_a_plain_sum_over_the_fitted_model(spark):
    rng = np.random.default_rng(2)
    texts = [t for _, t, *_ in H.odd_rows() if len(t or "") < 5000] + ["A a A b B1 b! é漢 é漢", "stupid Stupid\nstupid"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for module in (quality_classifier, toxicity):
        model = (rng.normal(0, 1, 1 << module.BITS).astype(np.float32), 0.25)
        got = {r.doc_id: r.score for r in module.score(df, model, F.lit(False)).collect()}
        for i, t in enumerate(texts):
            if module is toxicity:
                ids, share = toxicity.bag(t)
                total = float((model[0][ids].astype(float) * share).sum())
            else:
                total = sum(float(model[0][k]) * v for k, v in plain_quality_features(t).items())
            assert abs(got[i] - 1 / (1 + np.exp(-(total + 0.25)))) < 1e-5, (module.__name__, t)
