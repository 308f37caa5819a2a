"""Wide to long and lists to rows (RSH1-RSH8, SRT3)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: list[str], values: list[str], names: tuple[str, str] = ("status", "date")) -> DataFrame:
    """RSH1 with FLT6: one row per id and non-null value."""
    return df.unpivot(ids, values, *names).where(F.col(names[1]).isNotNull())


def paired_melt(df: DataFrame, ids: list[str], first: list[str], second: list[str], names: tuple[str, str] = ("date", "exp_details")) -> DataFrame:
    """RSH2, JON1, FLT5: the k-th of one family with the k-th of the other, where both are there; no join."""
    rows = F.arrays_zip(F.array(*map(F.col, first)).alias(names[0]), F.array(*map(F.col, second)).alias(names[1]))
    return df.select(*ids, F.inline(rows)).dropna(subset=list(names))


def status_name(c: Column) -> Column:
    """RSH3: numbered column names to status names; Nuevo and Resuelto take no number, so one that follows stays."""
    for pattern, name in (("d_TCNuevo", "nuevo"), (r"d_TCLatente\d*", "latente"), (r"d_TCReactivado\d*", "reactivado"), ("d_TCResuelto", "resuelto"), (r"d_TCRetirado\d*", "retirado")):
        c = F.regexp_replace(c, pattern, name)
    return c


def triples(items: Column) -> Column:
    """RSH4: array of (a, b, c) from a flat list; a list that leaves two over raises, as its last triple is not whole."""
    n = F.size(items)
    starts = F.when(n >= 3, F.sequence(F.lit(1), n - 1, F.lit(3))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.element_at(items, i).alias("a"), F.element_at(items, i + 1).alias("b"), F.element_at(items, i + 2).alias("c")))


def fields(record: Column, labels: list[str]) -> Column:
    """RSH7, RSH5, SRT3: map from label to text of a record `label: text label: text ...`; order does not matter."""
    choice = "|".join(map(re.escape, labels))
    parts = F.filter(F.split(record, rf"(?=(?:{choice}):)"), lambda p: p.rlike(rf"^(?:{choice}):"))
    entry = lambda p: F.struct(F.regexp_extract(p, rf"^({choice}):", 1).alias("key"), F.trim(F.regexp_extract(p, rf"(?s)^(?:{choice}):(.*)\z", 1)).alias("value"))
    pairs = F.transform(parts, entry)
    return F.map_from_entries(F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda q: q["key"] == p["key"])))


def records(text: Column, head: str = "Tipo:") -> Column:
    """RSH7: the records of a text, each from one head to the next; what stands before the first is dropped."""
    return F.filter(F.split(text, rf"(?={re.escape(head)})"), lambda p: p.startswith(head))


def repaired(found: Column, defaults: dict[str, str]) -> Column:
    """RSH8, FLT16: missing fields take their defaults."""
    table = F.create_map(*[F.lit(x) for pair in defaults.items() for x in pair])
    return F.map_concat(F.map_filter(table, lambda k, v: ~F.map_contains_key(found, k)), found)


def sections(df: DataFrame, key: str, text: str, markers: list[str]) -> DataFrame:
    """RSH6: key, marker, section: text from each marker that occurs to the next one of the list that occurs, the last to the end."""
    at = F.filter(F.transform(F.array(*map(F.lit, markers)), lambda m: F.struct(F.position(m, F.col(text)).alias("at"), m.alias("marker"))), lambda m: m["at"] > 0)
    d = df.select(key, text, at.alias("_at")).select(key, text, F.col("_at"), F.posexplode("_at").alias("_i", "_m"))
    end = F.coalesce(F.try_element_at("_at", F.col("_i") + 2)["at"], F.length(text) + 1)
    return d.select(key, F.col("_m.marker").alias("marker"), F.substring(F.col(text), F.col("_m.at"), F.greatest(end - F.col("_m.at"), F.lit(0))).alias("section"))
