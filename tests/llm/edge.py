"""Small tables with the cases that every corpus operator must take: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 97}" for i in range(30_000))
TEXTS = [None, "", " \t\n", "a", "A b\x0bC", "a bC", "The quick brown fox jumps over the lazy dog", "the quick  brown fox jumps over the lazy dog",
         LONG, LONG, "Released under the MIT license.", "éß é", "x\x00y \U0001f600", "12 34 ..."]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def rows():
    out = [(i, t, "en" if i % 3 else None, [None, "b", "a"][i % 3], None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    return out + [out[5], out[5], (None, "a", None, None, 1), (None, None, None, None, None)]


def stored(spark, path, data=None, clash=True, schema=SCHEMA):
    """The rows as a stored table; ``clash`` adds columns named like helper columns of the operators."""
    df = spark.createDataFrame(rows() if data is None else data, schema)
    if clash:
        for c in ("_uid", "_row", "id", "h", "key", "size", "n", "text_crc32", "cell", "bucket", "t", "w", "fp", "words", "place", "kept", "root"):
            df = df.withColumn(c, F.lit("mine"))
    df.write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def components(n, links):
    """Smallest member of each of n nodes' component, by plain union-find."""
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
