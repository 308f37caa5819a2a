"""Neighbours over partition edges and first rows of keys, against windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillwork.operators import relational, scans, spells


def events(spark, n, hot=True, seed=1):
    r = random.Random(seed)
    keys = [None, "a", "b", *(["hot"] * 6 if hot else []), *[f"k{i}" for i in range(20)]]
    rows = [(r.choice(keys), dt.date(2020, 1, 1) + dt.timedelta(days=r.randrange(40)) if r.random() < 0.95 else None, i, r.choice(["x", "y", None])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, d date, i int, v string").repartition(5)


def bag(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("parts", ["1", "9"])
@pytest.mark.parametrize("n", [0, 1, 2, 700])
def test_neighbours_are_those_of_a_window(spark, n, parts):
    df = events(spark, n)
    w = Window.partitionBy("k").orderBy("d", "i")
    expected = df.withColumns({"was": F.lag("v").over(w), "then": F.lag("d").over(w), "next": F.lead("v").over(w)})
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = scans.neighbours(df, ["k"], ["d", "i"], {"was": "v", "then": "d"}, {"next": "v"})
        assert bag(got.select(*expected.columns)) == bag(expected)
        amounts = df.withColumn("one", F.when(F.col("v") == "x", F.col("i")))
        sums = amounts.withColumn("s", F.sum(F.coalesce("one", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        assert bag(scans.running_sum(amounts, ["k"], ["d", "i"], "one", "s")) == bag(sums)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_hot_key_fills_several_tasks(spark):
    df = events(spark, 900).withColumn("k", F.lit("one"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = df.repartitionByRange("k", "d", "i").withColumn("p", F.spark_partition_id())
        assert ranged.select("p").distinct().count() > 2
        got = scans.neighbours(df, ["k"], ["d", "i"], {"was": "i"})
        assert got.where("was is null").count() == 1 and got.select("was").distinct().count() == 900
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_window_in_the_plans(spark):
    df = events(spark, 50)
    for made in (spells.spells(df, "k", "d", "v", "i", ("x",)), relational.keep_first(df, ["k"], F.col("d"), F.col("i")), relational.sample_per_label(df, "k", "i", 3)):
        assert "Window" not in made._jdf.queryExecution().toString()


def test_spells_of_a_hot_key(spark):
    df = events(spark, 600)
    w = Window.partitionBy("k").orderBy("d", "i")
    rows = df.where("k is not null and d is not null").withColumn("on", F.coalesce(F.col("v") == "x", F.lit(False)))
    starts = rows.where(~F.lit(False)).withColumn("was", F.lag("on").over(w)).where("was is null or was <> on")
    expected = starts.select("k", F.when(F.col("on"), "active").otherwise("non_active").alias("status"), F.col("d").alias("start_date"), F.coalesce(F.lead("d").over(w), F.lit("2022-07-01").cast("date")).alias("end_date"))
    assert bag(spells.spells(df, "k", "d", "v", "i", ("x",))) == bag(expected)


@pytest.mark.parametrize("n", [1, 4, 1000])
def test_first_rows_are_those_of_a_window(spark, n):
    df = events(spark, 500, seed=2)
    w = Window.partitionBy("k").orderBy("d", "i")
    expected = df.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).drop("r")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        assert bag(scans.first_n(df, ["k"], ["d", "i"], n, salts=3)) == bag(expected)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    if n == 1:
        assert bag(relational.keep_first(df, ["k"], F.col("d"), F.col("i"))) == bag(expected)
    assert scans.first_n(df.where("false"), ["k"], ["d", "i"], n).count() == 0


def test_maps_and_odd_names_pass(spark):
    df = events(spark, 60).select("k", "i", F.create_map(F.lit("a"), F.col("v")).alias("m"), F.col("d").alias("a.b"))
    assert relational.keep_first(df, ["k"], F.col("i")).columns == df.columns
    df = df.drop("a.b")  # which Spark's own mapInArrow doesn't take
    assert scans.first_n(df, ["k"], ["i"], 2).count() <= 2 * df.select("k").distinct().count()
