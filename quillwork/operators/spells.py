"""Active and inactive spells of dated status rows (WIN2-WIN7, AGG3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import is_active
from .scans import neighbours

OPEN_END = "2022-07-01"


def spells(df: DataFrame, key: str, date: str, status: str, order: str, active: tuple[str, ...] = ("nuevo", "reactivado"), open_end: str = OPEN_END) -> DataFrame:
    """key, status (active or non_active), start_date, end_date. order breaks ties of date. Null keys and dates take no part. Rows are sorted by range of
    key and date, so a key may fill many tasks; what goes on from one to the next is carried over their edges."""
    rows = df.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(key, F.col(date).alias("_date"), F.col(order).alias("_order"), is_active(F.col(status), active).alias("_on"))
    changed = neighbours(rows, [key], ["_date", "_order"], before={"_was": "_on"}).where(~F.col("_was").eqNullSafe(F.col("_on"))).drop("_was")
    ended = neighbours(changed, [key], ["_date", "_order"], after={"_end": "_date"})
    last = F.lit(open_end).cast("timestamp_ntz").cast(rows.schema["_date"].dataType)
    return ended.select(key, F.when(F.col("_on"), "active").otherwise("non_active").alias("status"), F.col("_date").alias("start_date"), F.coalesce("_end", last).alias("end_date"))
