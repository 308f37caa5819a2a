"""Parsing of model answers (STR17, STR18, JSN1)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LABELS

HAY, NO = LABELS


def normalize_label(c: Column) -> Column:
    """STR17: upper case, single spaces, no accents, underscores; NO forms first (whole), then HAY anywhere, else null."""
    t = F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+\z", ""))
    t = F.translate(F.regexp_replace(t, r"(?U)\s+", " "), "ÁÉÍÓÚ ", "AEIOU_")
    return F.when(t.isin("NO_DIALOGO", "NO_HAY_DIALOGO") | t.contains("NO_HAY_DIALOGO"), NO).when(t.contains("HAY_DIALOGO"), HAY)


def parse_plain(c: Column) -> Column:
    """STR18: struct(label, is_invalid, error)."""
    label = normalize_label(c)
    return F.struct(label.alias("label"), label.isNull().alias("is_invalid"), F.when(label.isNull(), "invalid_plain_label").alias("error"))


@F.pandas_udf(T.StructType([T.StructField("raw", T.StringType()), T.StructField("error", T.StringType())]))
def _decode(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        start, end = (text.find("{"), text.rfind("}")) if text is not None else (-1, -1)
        if start < 0 or end <= start:
            rows.append((None, "no_json_object"))
            continue
        try:
            rows.append((str(json.loads(text[start : end + 1]).get("label")), None))
        except json.JSONDecodeError as e:
            rows.append((None, f"json_decode_error:{e.msg}"))
    return pd.DataFrame(rows, columns=["raw", "error"])


def parse_json(c: Column) -> Column:
    """JSN1: struct(label, is_invalid, error). Strict JSON needs Python; the label is normalised natively."""
    got = _decode(c)
    label = normalize_label(got["raw"])
    error = F.coalesce(got["error"], F.when(label.isNull(), "invalid_json_label"))
    return F.struct(label.alias("label"), label.isNull().alias("is_invalid"), error.alias("error"))
