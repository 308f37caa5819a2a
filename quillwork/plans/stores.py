"""Sources and sinks: tables of the driver written in a format to the shared folder and read back by the reader in question."""

from __future__ import annotations

import datetime as dt
import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import relational
from ..sources import readers, workbooks
from ..storage import scratch
from .base import Registry, table

R = Registry()


@R.query("src1_workbooks", "SELECT CAST(s_suppkey AS INT) AS id, s_name AS name, strftime(DATE '2020-01-01' + CAST(s_nationkey AS INT), '%Y-%m-%d') AS day, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'a<b & c' END AS note FROM supplier")
def src1_workbooks(spark, d):
    """One workbook for each nation's suppliers; dates are numbers, as workbooks have them."""

    def book(rows: pd.DataFrame) -> pd.DataFrame:
        cells = [[str(k), n, str(43831 + at), None if k % 3 == 0 else "a<b & c"] for k, n, at in zip(rows["s_suppkey"], rows["s_name"], rows["s_nationkey"], strict=True)]
        return pd.DataFrame({"content": [readers.workbook([["id", "name", "day", "note"], *cells])]})

    books = table(spark, d, "supplier").groupBy("s_nationkey").applyInPandas(book, "content binary")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType()), T.StructField("note", T.StringType())])
    return readers.parse_workbooks(books, schema).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@R.query("src1_workbook_sheets", """
SELECT 'n' || s_nationkey || '.xlsx' AS book, 'suppliers' AS sheet, s_suppkey AS id, s_name AS name, CAST(s_acctbal AS DOUBLE) AS balance, strftime(DATE '2020-02-28' + CAST(s_suppkey % 700 AS INT), '%Y-%m-%d') AS day FROM supplier
UNION ALL SELECT 'n' || n_nationkey || '.xlsx', 'nation', n_nationkey, n_name, NULL, NULL FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)""")
def src1_workbook_sheets(spark, d):
    """A workbook of two sheets for each nation that has suppliers, written to the shared folder by tasks and read by the data source."""
    folder = scratch(spark, "books")

    def book(rows: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        of, nation = int(rows["n_nationkey"].iloc[0]), rows["n_name"].iloc[0]
        suppliers = [[k, n, b, dt.date(2020, 2, 28) + dt.timedelta(days=k % 700)] for k, n, b in zip(rows["s_suppkey"].tolist(), rows["s_name"], rows["s_acctbal"].tolist(), strict=True)]
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        own = f"{base}/.{of}-{uuid.uuid4().hex}"
        with files.open_output_stream(own) as f:
            f.write(workbooks.write_book({"suppliers": [["id", "name", "balance", "day"], *suppliers], "nation": [["name", "id"], [nation, of]]}))
        files.move(own, f"{base}/n{of}.xlsx")
        return pd.DataFrame({"n": [1]})

    joined = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    joined.groupBy("n_nationkey").applyInPandas(book, "n int").count()
    found = readers.read_workbooks(spark, folder, T.StructType.fromDDL("id long, name string, balance double, day date, _file string, _sheet string"), "*", source=True)
    return found.select(F.element_at(F.split("_file", "/"), -1).alias("book"), F.col("_sheet").alias("sheet"), "id", "name", "balance", F.date_format("day", "yyyy-MM-dd").alias("day"))


@R.query("src2_json_splits", "SELECT doc_id, text, lang, source, length(text) AS n FROM documents")
def src2_json_splits(spark, d):
    """Documents as files of one array each, whose blocks are read by tasks of their own; texts and a nested record hold any marks."""
    given = table(spark, d, "documents").select("doc_id", "text", F.struct("lang", F.array("source").alias("sources")).alias("meta"))
    path = scratch(spark, "arrays")
    readers.write_json_arrays(given, path)
    got = readers.read_json_array(spark, path, given.schema)
    return got.select("doc_id", "text", "meta.lang", F.col("meta.sources")[0].alias("source"), F.length("text").cast("long").alias("n"))


@R.query("src2_json_array", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src2_json_array(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    path = scratch(spark, "array")
    # one array for each region, a file each
    arrays = nation.groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct(*nation.columns))).alias("value"))
    arrays.select("value", F.col("n_regionkey").alias("of")).write.partitionBy("of").text(path)
    return readers.read_json_array(spark, f"{path}/*", nation.schema)


@R.query("src3_csv_lines", "SELECT item_id, text FROM benchmark")
def src3_snk2_csv(spark, d):
    given = table(spark, d, "benchmark").select("item_id", F.concat(F.lit('"q", '), "text", F.lit("\n'x'\n")).alias("text"))
    path = scratch(spark, "csv")
    readers.write_csv(given, path)
    return readers.read_csv(spark, path, given.schema).withColumn("text", F.expr("substring(text, 6, length(text) - 10)"))


@R.query("src3_csv_splits", "SELECT doc_id, 'say \"' || text || '\",' AS text, lang FROM documents")
def src3_csv_splits(spark, d):
    """Documents as CSV, whose values hold line breaks, quotes and commas; blocks of a file are read by tasks of their own."""
    given = table(spark, d, "documents").select("doc_id", F.concat(F.lit('say "'), "text", F.lit('",')).alias("text"), "lang")
    path = scratch(spark, "csv")
    readers.write_csv(given, path)
    return readers.read_csv(spark, path, given.schema)


@R.query("snk3_csv_separator", "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal FROM supplier")
def snk3_csv(spark, d):
    given = table(spark, d, "supplier").select("s_suppkey", "s_name", F.expr("CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END").alias("s_acctbal"))
    path = scratch(spark, "csv")
    readers.write_csv(given, path)
    return readers.read_csv(spark, path, given.schema)


@R.query("src4_media_list", "SELECT s_name AS name, 'http://m/' || s_suppkey AS url FROM supplier")
def src4_media_list(spark, d):
    line = F.concat(F.when(F.col("s_suppkey") == 1, "\ufeff").otherwise(""), "s_name", F.lit(";http://m/"), F.col("s_suppkey").cast("string"), F.lit(";"))
    lines = table(spark, d, "supplier").select(F.explode(F.array(line, F.lit(";;"), F.lit(""))).alias("value"))
    path = scratch(spark, "media")
    lines.write.text(path)
    return readers.read_media_list(spark, path)


@R.query("src5_word_list", "SELECT p_name AS word FROM part")
def src5_word_list(spark, d):
    lines = table(spark, d, "part").select(F.explode(F.array(F.lit("; a note"), F.concat(F.lit("  "), "p_name", F.lit("\t")), F.lit(""), F.lit(";"))).alias("value"))
    path = scratch(spark, "words")
    lines.write.text(path)
    return readers.read_word_list(spark, path)


@R.query("src8_list_files", "SELECT n_regionkey AS region, n AS n_nations, row_number() OVER (ORDER BY n_regionkey DESC) - 1 AS place FROM (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1)")
def src8_list_files(spark, d):
    """The files of a folder by time, with their places in that order; each bears its region's number in its path, and a line for each nation. They are
    written so that the order of time is not that of path."""
    path = scratch(spark, "files")
    names = table(spark, d, "nation").select(F.lpad(F.lit("x"), 9, "x").alias("value"), F.col("n_regionkey").alias("of"))

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        of = int(rows["of"].iloc[0])
        files, base = fs.FileSystem.from_uri(f"{path}/of={of}")
        files.create_dir(base, recursive=True)
        with files.open_output_stream(f"{base}/part-0.txt") as f:
            f.write(("\n".join(rows["value"]) + "\n").encode())
        return pd.DataFrame({"n": [1]})

    for row in names.select("of").distinct().orderBy(F.desc("of")).limit(100).collect():  # a folder a region
        names.where(F.col("of") == row["of"]).groupBy("of").applyInPandas(write, "n int").count()
    found = readers.list_files(spark, f"{path}/*", "part-*")
    placed = relational.row_number0(found, "place", F.col("modificationTime"), F.col("path"))
    return placed.select(F.regexp_extract("path", r"of=(\d+)", 1).cast("int").alias("region"), (F.col("length") / 10).cast("long").alias("n_nations"), "place")


@R.query("snk1_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def snk1_json(spark, d):
    given = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch(spark, "json")
    readers.write_json(given, path)
    return spark.read.schema(given.schema).json(path)


@R.query("snk1_json_columns", """
WITH r AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS p, count(*) OVER () AS n, c_custkey, c_name, CASE WHEN c_custkey % 4 > 0 THEN c_nationkey END AS c_nationkey FROM customer),
c AS (SELECT p, n, 0 AS c, '{"c_custkey":{' AS head, CAST(c_custkey AS VARCHAR) AS v FROM r UNION ALL SELECT p, n, 1, '"c_name":{', CAST(to_json(c_name || ' "q"') AS VARCHAR) FROM r
      UNION ALL SELECT p, n, 2, '"c_nationkey":{', coalesce(CAST(c_nationkey AS VARCHAR), 'null') FROM r)
SELECT CASE WHEN p = 0 THEN head ELSE '' END || '"' || p || '":' || v || CASE WHEN p < n - 1 THEN ',' WHEN c < 2 THEN '},' ELSE '}}' END AS line FROM c""")
def snk1_json_columns(spark, d):
    """The lines of the document."""
    given = table(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(' "q"')).alias("c_name"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_nationkey")).alias("c_nationkey"))
    path = scratch(spark, "columns")
    readers.write_json_columns(given, path, "c_custkey")
    return spark.read.text(path).withColumnRenamed("value", "line")


@R.query("snk6_nested_folder", "SELECT r_regionkey, r_name FROM region")
def snk6_nested(spark, d):
    given = table(spark, d, "region").select("r_regionkey", "r_name")
    path = f"{scratch(spark, 'made')}/not/there/yet"
    readers.write_csv(given, path)
    return readers.read_csv(spark, path, given.schema)


@R.query("src11_page_grid", "SELECT term, CAST(page AS INT) AS page FROM (SELECT DISTINCT event_type AS term FROM events) CROSS JOIN range(1, 4) r(page)")
def src11_pages(spark, d):
    terms = table(spark, d, "events").select(F.col("event_type").alias("term")).distinct()
    return readers.grid(terms, 4, inclusive=False)


QUERIES, ORACLES = R.queries, R.oracles
