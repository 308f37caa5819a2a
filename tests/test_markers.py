"""One pass for many markers gives what a pass for each gives."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillwork.functions import markers, text
from quillwork.operators import reshape

WORDS = ["Caso:", "Tipo:", "so:", "aab", "ba", "ñandú"]
TEXTS = st.lists(st.sampled_from(["Ca", "so", ":", "Ti", "po", "Caso:", "a", "b", " ", "  ", "\n", "\t", "ñan", "dú", "\xa0", "x", "Tipo:"]), max_size=14).map("".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=40))
def test_repair_is_that_of_a_pass_a_word(spark, texts):
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    for r in df.select("t", text.repair(F.col("t"), WORDS).alias("a"), markers.repair(F.col("t"), WORDS).alias("b")).collect():
        assert r["a"] == r["b"], r["t"]


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=40))
def test_sections_are_those_of_a_pass_a_marker(spark, texts):
    df = spark.createDataFrame(list(enumerate([*texts, None, "😀 Caso: é Tipo: x"])), "k int, t string")
    names = [*WORDS, "none"]
    a, b = (sorted(map(tuple, f(df, "k", "t", names).collect())) for f in (reshape.sections, markers.sections))
    assert a == b


def test_no_markers(spark):
    df = spark.createDataFrame([(1, "text")], "k int, t string")
    assert markers.sections(df, "k", "t", []).count() == 0 and df.select(markers.repair(F.col("t"), []).alias("t")).first()["t"] == "text"
