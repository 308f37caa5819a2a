"""An extension (the operators above are batch): filtered counts over event time, with late data dropped behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, types: list[str], width: str = "1 day", late: str = "2 days") -> DataFrame:
    """FLT1 and AGG1 over a stream: rows and value by window and type."""
    kept = events.where(F.col("event_type").isin(*types)).withWatermark("ts", late)
    return kept.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")
