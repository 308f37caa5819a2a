"""Rows with the awkward cases that every operator must take: nulls, empty and long texts, ties, repeats, clashing column names."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def documents(spark, rows):
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    long = " ".join(f"word{i % 977}x" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one two three"), (4, "one two three"), (5, long), (None, "null id text here with seven words"), (6, "x" * 100_000), (7, "a\u00a0b \u0085 c\x1cd\nÉé ñ"), (8, "tie", None), (9, "tie", ""), (10, None, None)]
    return documents(spark, rows)


#: Names that operators might use for columns of their own.
CLASHING = ("_id", "_set", "_class", "_kept", "_size", "_print", "_nth", "_copy", "_row", "_gone", "_best", "_page", "_of", "toxicity", "n_lines", "n_dropped", "position", "copies", "key")


def with_clashes(df):
    """df with columns of those names, whose values name their column."""
    return df.withColumns({n: F.lit(n) for n in CLASHING})


def same_clashes(df):
    return all(r[n] == n for r in df.select(*CLASHING).distinct().collect() for n in CLASHING)


def labels(spark, rows):
    """rows: (doc_id, quality, toxic)."""
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
