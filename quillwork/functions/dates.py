"""Spanish month texts (DAT1-DAT4) and report numbers (JON7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import strip

#: Month names and numbers (fixed values).
MONTHS = {"enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12}
NAMES = "|".join(MONTHS)


def month_number(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    return table[F.lower(name)]


def first_of_month(c: Column) -> Column:
    """DAT1: month at the start and the first four digits anywhere; null if either is missing."""
    text = strip(c)
    name = F.nullif(F.regexp_extract(text, rf"(?iu)^({NAMES})", 1), F.lit(""))
    year = F.nullif(F.regexp_extract(text, r"(\d{4})", 1), F.lit(""))
    return F.try_to_date(F.concat(year, F.lit("-"), F.lpad(month_number(name).cast("string"), 2, "0"), F.lit("-01")), "yyyy-MM-dd")


def rest_text(c: Column) -> Column:
    """DAT2: the text behind `month [de][,] year[.][,]` up to the end; null if there is none or it goes over a line break."""
    return F.nullif(F.regexp_extract(strip(c), rf"(?iuU)^(?:{NAMES})(?:\s+de)?[,\s]+(?:\d{{4}})\.?,?\s*([^\n]*)\z", 1), F.lit(""))


def month_text(d: Column) -> Column:
    """`Mes YYYY` with the capitalised Spanish name (setiembre is not used)."""
    names = [m for m in MONTHS if m != "setiembre"]
    return F.concat(F.initcap(F.element_at(F.array(*map(F.lit, names)), F.month(d))), F.lit(" "), F.year(d).cast("string"))


def month_series(spark: SparkSession, start: str = "2007-01-01", end: str = "2023-12-01") -> DataFrame:
    """DAT4: n and the text of each month."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month"))
    return spark.range(1).select(F.posexplode(days).alias("n", "day")).select("n", month_text(F.col("day")).alias("month_text"))


def report_month(number: Column) -> Column:
    """JON7: report 35 is January 2007."""
    return F.add_months(F.lit("2007-01-01").cast("date"), number - 35)
