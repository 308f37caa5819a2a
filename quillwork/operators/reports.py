"""The compositions: occurrences to modelling tables, workbooks to long tables, report texts to records, summary tables to counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, markers, text
from ..schemas import RECORD
from . import relational, reshape, spells

#: Fields of a record in their order in the reports (fixed values).
RECORD_FIELDS = ["Tipo", "Ingreso como caso nuevo", "Caso", "Ubicación", "Actores primarios", "Actores secundarios", "Actores terciarios", "Diálogo", "Detalle del mes"]


#: Raw dialogue values with their dummies, events that say nothing, and the columns that go on to modelling (fixed values).
DIALOGUE = {"HAY DIÁLOGO": 1, "NO HAY DIÁLOGO": 0}
EMPTY_EVENTS = ("se registraron nuevos hechos durante el mes.", "se registraron nuevos hechos durante el mes..")
MODEL_COLUMNS = ["dialogo", "conflict_type", "conflict_uid", "report_number", "clean_date", "clean_conflict_text", "clean_event_text", "date_init", "location", "actors_1", "actors_2", "actors_3"]


def clean_occurrences(df: DataFrame, history: int = 5, stop: list[str] | None = None) -> DataFrame:
    """From parsed occurrences to MODEL_COLUMNS. Rows without one of the two dialogue values go before a conflict's history is counted; event texts
    are filled from what follows the date; rows without an event go, texts may be null; of rows that agree in conflict, report and event the
    first stays, in the order of their date, conflict text, type and raw date."""
    d = df.where(F.col("dialogo").isin(*DIALOGUE))
    d = relational.min_history(d, "conflict_uid", history).drop("n_key")
    raw = text.strip(F.col("date_init"))
    d = d.withColumns({"conflict_type": text.conflict_type(F.col("conflict_type")), "date_init": raw, "clean_date": dates.first_of_month(raw), "event_text": F.coalesce("event_text", dates.rest_text(raw))})
    for said in EMPTY_EVENTS:
        d = d.where(F.col("event_text") != said)
    d = d.withColumn("dialogo", relational.lookup(F.col("dialogo"), {k: str(v) for k, v in DIALOGUE.items()}).cast("byte"))
    d = relational.keep_first(d, ["conflict_uid", "report_number", "event_text"], *map(F.col, ("clean_date", "conflict_text", "conflict_type", "date_init")))
    return d.withColumns({"clean_conflict_text": text.clean_text(F.col("conflict_text"), stop or []), "clean_event_text": text.clean_text(F.col("event_text"), stop or [])}).select(*MODEL_COLUMNS)


def workbook_description(df: DataFrame) -> DataFrame:
    return relational.rename_all(relational.first_columns(df, 2), ["id", "initial_description"])


def workbook_expressions(df: DataFrame) -> DataFrame:
    when, what = ([c for c in df.columns if c.startswith(p)] for p in ("d_Expresión", "InfoExpresión"))
    return reshape.paired_melt(df, ["id"], when, what)


def workbook_spells(df: DataFrame) -> DataFrame:
    columns = [c for c in df.columns if c.startswith("d_TC")]
    at = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("_name"), F.col(c).cast("timestamp_ntz").alias("date")) for i, c in enumerate(columns)])
    long = df.select("id", F.inline(at)).where("date is not null").select("id", "ord", reshape.status_name(F.col("_name")).alias("status"), "date")
    return spells.spells(long, "id", "date", "status", "ord")


def _mended(body: Column) -> Column:
    """Labels made whole: those without white space in one pass, the others one by one."""
    labels = [f"{x}:" for x in RECORD_FIELDS]
    return text.repair(markers.repair(body, [x for x in labels if " " not in x]), [x for x in labels if " " in x])


def report_records(df: DataFrame, key: str, body: str, number: Column, departments: list[str]) -> DataFrame:
    """The records of report texts: by department, then record, then field; labels broken by white space are repaired, missing fields take defaults."""
    whole = df.select(key, number.alias("_n"), _mended(F.col(body)).alias("_t"))
    by_place = markers.sections(whole.withColumn("_k", F.struct(key, "_n")), "_k", "_t", departments)
    rows = by_place.select("_k.*", F.col("marker").alias("Dpto"), F.explode(reshape.records(F.col("section"))).alias("_r"))
    found = rows.withColumn("_f", reshape.repaired(reshape.fields(F.col("_r"), RECORD_FIELDS), {"Ingreso como caso nuevo": "", "Actores secundarios": "", "Actores terciarios": ""}))
    names = [n for n in RECORD if n not in ("Dpto", "Mes", "NInforme")]
    cols = [F.try_element_at("_f", F.lit(f)).alias(n) for f, n in zip(RECORD_FIELDS, names, strict=True)]
    out = found.select(key, "Dpto", *cols, dates.month_text(dates.report_month(F.col("_n"))).alias("Mes"), F.col("_n").cast("int").alias("NInforme"))
    return out.withColumn("Tipo", text.record_type(F.col("Tipo")))


def activity_counts(df: DataFrame, key: str, body: str, start: str) -> DataFrame:
    """Rows `name count percent` behind a marker, as triples."""
    tail = text.strip(text.after(F.col(body), start))
    parts = F.flatten(F.transform(F.split(tail, "\n"), lambda line: text.rsplit(line, 2)))
    return df.select(key, F.inline(reshape.triples(parts))).toDF(key, "Actividad", "Conteo", "%")
