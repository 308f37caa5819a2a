"""The document of columns is what a data frame of pandas makes."""

import datetime as dt
import json

import pandas as pd

from quillwork.sources import readers


def test_document_of_columns(spark, tmp_path):
    rows = [(i, f'n"{i}\n/é', None if i % 3 else i / 2, dt.date(2020, 1, 1) + dt.timedelta(days=i), dt.datetime(2021, 5, 6, 7, 8, i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, name string, x double, day date, at timestamp").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    readers.write_json_columns(df, str(tmp_path / "out"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) > 1
    pdf = pd.DataFrame(rows, columns=df.columns).astype({"day": "datetime64[ns]", "at": "datetime64[ns]"})
    assert json.loads("".join(p.read_text() for p in parts)) == json.loads(pdf.to_json(date_unit="ms", date_format="epoch"))
    readers.write_json_columns(df.where("false"), str(tmp_path / "none"), "id")
    assert json.loads("".join(p.read_text() for p in (tmp_path / "none").glob("part-*"))) == {c: {} for c in df.columns}
