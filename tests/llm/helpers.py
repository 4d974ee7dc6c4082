"""Small corpora and brute-force twins for the operator tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor " * 4000

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    a = "the cat sat on the mat and looked at the dog while it rained all day long in the old town"
    return [
        (1, a, "en", "s1", 1), (2, a, "en", "s1", 1), (2, a, "en", "s1", 1), (None, a, "en", None, None),
        (None, None, None, None, None), (3, None, "de", "s2", 0), (4, "", "de", "s2", 0), (5, " \n\t ", None, "s2", 3),
        (6, LONG, "en", "s1", len(LONG)), (7, "x" * 50_000, "en", "s3", 50_000), (7, "another text", "en", "s3", 12),
        (8, "one", "fr", "s3", 3), (9, "two words", "fr", "s3", 9), (10, "é漢字\x85  b\nb\nb", "zz", "s4", 9),
        (11, "mail a@b.co or +1 (212) 555-1234, card 4111 1111 1111 1111 at 10.0.0.1", "en", "s4", 70),
    ]


def odd_documents(spark):
    """The rows above with extra columns whose names clash with operator columns."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    clashing = ("fp", "row_hash", "size", "skey", "piece", "h", "copies", "score", "label", "kept", "d2", "segment",
                "key", "n", "removed", "group_key", "rows_doc", "rows_hash", "mean", "prec", "target", "row")
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in clashing])


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def write(df, path):
    df.write.mode("overwrite").parquet(path)
    return path


def same_rows(got, want):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def components(values, near):
    """Union-find over a list, ``near(i)`` the later indices linked to i; returns the smallest index reachable."""
    up = list(range(len(values)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for i in range(len(values)):
        for j in near(i):
            r, s = find(i), find(j)
            up[max(r, s)] = min(r, s)
    return [find(i) for i in range(len(values))]
