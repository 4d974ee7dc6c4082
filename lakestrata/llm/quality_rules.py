"""Quality rules: hard rules, then robust multivariate outliers per language and source.

Every document gets a vector of transformed text statistics.  Per
(lang, source) group a minimum-covariance-determinant (MCD) estimate is found
by concentration steps: start from the group's medians and MADs, keep the
half-set (share ``COVERAGE``) with the smallest Mahalanobis distances,
recompute mean and covariance from it, repeat; then one reweighted step over
all rows inside the ``REWEIGHT`` quantile.  Rows beyond the ``CUT`` quantile
are rejected.  A document is never rejected for being long: the share of its
distance that more words than the other statistics let expect account for does
not count (``excess_length``).

One concentration step is one pass over the compact statistics table: the
moments are summed per group and distance bin, and the half-set is the prefix
of bins that reaches the coverage.  Statistics are integers (thousandths), so
the sums do not depend on the order of rows.  The model is a table with one
row per group; it is never collected, and a group holding a third of all rows
is summed in every task first.

Small groups lean on their language: moments are blended with ``PRIOR`` rows
of the language's pooled half-sets, and a floor (``RIDGE``) on the variances
keeps statistics that are constant in a group (often zero) from rejecting
every other value.

Edge cases: a null text has no words; null lang or source form groups of their
own; equal rows get equal decisions; rows of one id with different texts are
decided each; an empty table gives an empty result; other columns are not
read, and ``accepted_documents`` returns the columns of its input.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, filter_by_rows, row_key, stage

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
COVERAGE, STEPS, PRIOR = 0.5, 3, 40     # half of a group: any larger share breaks down at fewer outliers
REWEIGHT_Z, CUT_Z = 1.96, 4.75       # normal quantiles of 0.975 and 1 - 1e-6
DIMS = ("x_word_length", "x_symbols", "x_dup_lines", "x_repeats", "x_upper", "x_length")
RIDGE = (0.02, 0.30, 1.50, 0.50, 0.10, 0.50)  # variance floor of each transformed statistic
SYMBOLS = b"#*$%&|<>"
SCALE = 1000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    count = Counter(windows)
    if len(count) == len(windows):
        return 0
    n, reach = 0, 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            n += i + 3 - max(i, reach)
            reach = i + 3
    return n


def statistics(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, upper-case letters in words."""
    raw = (text or "").encode()
    words = raw.split()
    packed = b"".join(words)
    chars = len(packed.translate(None, bytes(range(0x80, 0xC0))))  # without UTF-8 continuation bytes
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            dup += line in seen
            seen.add(line)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    upper = len(packed) - len(packed.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return len(words), chars, symbols, dup, repeat_words(words), lines, upper


def _measure(batches):
    for batch in batches:
        rows = []
        texts = batch.column("text")
        for i in range(0, len(texts), 256):
            rows += [statistics(t) for t in texts.slice(i, 256).to_pylist()]
        made = np.array(rows, np.int64).reshape(len(rows), 7)
        keep = [batch.column(n) for n in ("doc_id", "lang", "source", "row_hash")]
        yield pa.RecordBatch.from_arrays(keep + [pa.array(made[:, k]) for k in range(7)],
                                         names=["doc_id", "lang", "source", "row_hash", *BASE, "n_lines", "n_upper"])


def measure(docs: DataFrame) -> DataFrame:
    """Compact statistics table of ``docs`` (doc_id, text, lang, source), one row per row."""
    src = docs.select("doc_id", "text", col("lang").cast("string").alias("lang"),
                      col("source").cast("string").alias("source"), row_key(["text", "lang", "source"]).alias("row_hash"))
    kind = src.schema["doc_id"].dataType.simpleString()
    made = src.mapInArrow(_measure, f"doc_id {kind}, lang string, source string, row_hash long, "
                          + ", ".join(f"{c} long" for c in (*BASE, "n_lines", "n_upper")))
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    share = lambda a, b: F.log1p(100.0 * F.col(a) / b)
    x = (F.log(chars / words), share("n_symbols", words), share("n_dup_lines", F.greatest("n_lines", F.lit(1))),
         share("n_repeat_words", words), share("n_upper", words), F.log(words.cast("double")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # groups get keys that are never null, so that they join and sum like any other
    key = lambda c: F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(c)))
    return made.select("*", *[F.round(v * SCALE).cast("long").alias(d) for v, d in zip(x, DIMS)],
                       failed.alias("base_failed"), key("lang").alias("lkey"), key("source").alias("skey"))


def chi2_quantile(z: float, d: int = len(DIMS)) -> float:
    """Wilson-Hilferty chi-square quantile at the normal quantile ``z``."""
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


GROUP = ["lkey", "skey"]
PAIRS = [(i, j) for i in range(len(DIMS)) for j in range(i, len(DIMS))]


def _moments() -> list[Column]:
    out = [F.count(F.lit(1)).alias("n")]
    out += [F.sum(d).alias(f"s{i}") for i, d in enumerate(DIMS)]
    return out + [F.sum(F.col(DIMS[i]) * F.col(DIMS[j])).alias(f"q{i}_{j}") for i, j in PAIRS]


SUMS = ["n"] + [f"s{i}" for i in range(len(DIMS))] + [f"q{i}_{j}" for i, j in PAIRS]


def _solve(batches, cover_z):
    """Blend each group's moments with its language's, then mean and precision (scaled by the coverage)."""
    d = len(DIMS)
    for batch in batches:
        t = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in SUMS + ["l_" + s for s in SUMS]}
        mean, prec = [], []
        for r in range(batch.num_rows):
            def both(pre):
                n = float(t[pre + "n"][r])
                m = np.array([t[f"{pre}s{i}"][r] for i in range(d)], float) / n / SCALE
                q = np.zeros((d, d))
                for i, j in PAIRS:
                    q[i, j] = q[j, i] = float(t[f"{pre}q{i}_{j}"][r]) / n / SCALE / SCALE
                return n, m, q - np.outer(m, m)
            n, m, c = both("")
            _, lm, lc = both("l_")
            w = n / (n + PRIOR)
            centre = w * m + (1 - w) * lm
            cov = (w * c + (1 - w) * lc) * cover_z + np.diag(RIDGE)
            mean.append(centre.tolist())
            prec.append(np.linalg.inv(cov).reshape(-1).tolist())
        kind = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column("lkey"), batch.column("skey"), pa.array(mean, kind),
                                          pa.array(prec, kind)], names=[*GROUP, "mean", "prec"])


def _model(moments: DataFrame, inflate: float) -> DataFrame:
    """Group moments -> (lkey, skey, mean, prec), one row per group; written, so that lineage stays short."""
    own = stage(moments, "moments")
    lang = own.groupBy("lkey").agg(*[F.sum(s).alias("l_" + s) for s in SUMS])
    solved = own.join(lang, "lkey").mapInArrow(
        partial(_solve, cover_z=inflate), "lkey string, skey string, mean array<double>, prec array<double>")
    return stage(solved, "model")


def excess_length(off: list[Column], prec: Column) -> Column:
    """What a length above its expectation from the other statistics adds to the squared distance.

    The distance is that of the other statistics alone plus (P off)^2 / P at the length, P being the precision.
    """
    k, d = DIMS.index("x_length"), len(DIMS)
    above = F.greatest(sum((off[j] * prec[k * d + j] for j in range(d)), F.lit(0.0)), F.lit(0.0))
    return above * above / prec[k * d + k]


def distance(stats: DataFrame, model: DataFrame, long_counts: bool = True) -> DataFrame:
    """Add ``d2``, the squared Mahalanobis distance to the row's group; without ``long_counts`` only the lower side
    of the length is in it."""
    off = [F.col(d) / SCALE - F.col("mean")[i] for i, d in enumerate(DIMS)]
    d2 = sum((off[i] * off[j] * F.col("prec")[i * len(DIMS) + j] * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))
    d2 = d2 if long_counts else d2 - excess_length(off, F.col("prec"))
    return stats.join(model, GROUP, "left").withColumn("d2", d2).drop("mean", "prec")


def _start(good: DataFrame) -> DataFrame:
    """Medians and squared MADs as a diagonal model."""
    med = stage(good.groupBy(*GROUP).agg(F.array(*[F.percentile_approx(d, 0.5).cast("double") for d in DIMS])
                                         .alias("med")), "medians")
    off = good.join(med, GROUP)
    mad = off.groupBy(*GROUP, "med").agg(*[
        F.percentile_approx(F.abs(F.col(d) - F.col("med")[i]), 0.5).alias(f"a{i}") for i, d in enumerate(DIMS)])
    var = [F.pow(F.col(f"a{i}") * 1.4826 / SCALE, 2) + RIDGE[i] for i in range(len(DIMS))]
    prec = [1 / var[i] if i == j else F.lit(0.0) for i in range(len(DIMS)) for j in range(len(DIMS))]
    return stage(mad.select(*GROUP, F.transform("med", lambda m: m / SCALE).alias("mean"),
                            F.array(*prec).alias("prec")), "start")


def robust_model(stats: DataFrame) -> DataFrame:
    """MCD location and precision per (lang, source), from every row that passes the hard rules."""
    good = stats.where(~F.col("base_failed")).select(*GROUP, *DIMS)
    model = _start(good)
    d = len(DIMS)
    # covariance of the inner share of a normal sample, back to the whole sample's
    inflate = COVERAGE / _chi2_cdf(chi2_quantile(_normal_z(COVERAGE)), d + 2)
    for _ in range(STEPS):
        bins = F.floor(F.log(F.col("d2") + 1e-3) * 50).cast("int")
        sums = distance(good, model).groupBy(*GROUP, bins.alias("bin")).agg(*_moments())
        order = Window.partitionBy(*GROUP).orderBy("bin")
        before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        total = F.sum("n").over(Window.partitionBy(*GROUP))
        half = sums.select("*", before.alias("before"), total.alias("total")).where(
            F.col("before") < COVERAGE * F.col("total"))
        model = _model(half.groupBy(*GROUP).agg(*[F.sum(s).alias(s) for s in SUMS]), inflate)
    inside = distance(good, model).where(F.col("d2") <= chi2_quantile(REWEIGHT_Z))
    return _model(inside.groupBy(*GROUP).agg(*_moments()), 1.0)


def _normal_z(p: float) -> float:
    from statistics import NormalDist
    return NormalDist().inv_cdf(p)


def _chi2_cdf(x: float, d: int) -> float:
    from statistics import NormalDist
    return NormalDist().cdf(((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)))


def judge(docs: DataFrame) -> DataFrame:
    """The statistics of every row with base_failed, distance ``d2`` and ``kept``."""
    stats = stage(measure(docs), "statistics")
    scored = distance(stats, robust_model(stats), long_counts=False)
    inside = F.coalesce(F.col("d2") <= chi2_quantile(CUT_Z), F.lit(True))
    return scored.withColumn("kept", ~F.col("base_failed") & inside)


def accepted_documents(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are kept, with their columns."""
    kept = judge(docs).where("kept").select("doc_id", "row_hash")
    return filter_by_rows(docs, stage(kept, "kept"), ["text", "lang", "source"], keep=True)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents
    return judge(documents(spark, sf_dir)).select("doc_id", *BASE, "base_failed", "kept", "d2")
