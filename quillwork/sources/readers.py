"""Sources (SRC1-SRC13) and sinks (SNK1-SNK3, SNK6). Schemas are declared; nothing is inferred."""

from __future__ import annotations

import json
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import after, loose, section, spaced_number, strip
from ..schemas import MEDIA
from ..storage import ordered_positions
from .markup import elements
from .splits import csv_records, json_records
from .workbooks import register


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC2: files that each hold one array of records; a large one is read by many tasks."""
    return json_records(spark, path, schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """SRC3: with a header; quoted fields may hold line breaks and doubled quotes; a large file is read by many tasks."""
    return csv_records(spark, path, schema, sep)


def read_media_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: `;`-separated, no header, with a byte order mark and blank rows."""
    df = spark.read.schema(MEDIA).option("sep", ";").csv(path).withColumn("name", F.replace("name", F.lit("﻿"), F.lit("")))
    return df.where(F.coalesce(F.trim("name"), F.lit("")) != "").select("name", "url")


def read_word_list(spark: SparkSession, path: str, comment: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """SRC5: one word a line; comment and empty lines are dropped."""
    lines = spark.read.option("encoding", encoding).option("sep", "\u0001").option("comment", comment).schema("word string").csv(path)
    return lines.select(strip(F.col("word")).alias("word")).where("word <> ''")


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """SRC8: path, modification time and length; order by time, then path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "modificationTime", "length").orderBy("modificationTime", "path")


# --- workbooks (SRC1): the first sheet of an .xlsx file, by the standard library
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _column(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def sheet_rows(data: bytes) -> list[list[str | None]]:
    """Cells of the first sheet as text."""
    with zipfile.ZipFile(BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        sheet = min(n for n in names if n.startswith("xl/worksheets/sheet"))
        rows = []
        for row in ElementTree.fromstring(z.read(sheet)).iter(f"{{{_NS['m']}}}row"):
            cells: dict[int, str | None] = {}
            for c in row.findall("m:c", _NS):
                value = c.find("m:v", _NS)
                text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else (value.text if value is not None else None)
                cells[_column(c.get("r", "A"))] = shared[int(text)] if c.get("t") == "s" and text is not None else text
            rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
        return rows


def workbook(rows: list[list[str | None]]) -> bytes:
    """An .xlsx file of one sheet of text cells."""
    from xml.sax.saxutils import escape

    cells = "".join("<row>" + "".join(f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{escape(v)}</t></is></c>' for j, v in enumerate(row) if v is not None) + "</row>" for i, row in enumerate(rows, 1))
    out = BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_NS["m"]}"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType | None = None, sheet: str = "1", source: bool = False) -> DataFrame:
    """SRC1: a sheet (or all: *) of each workbook at path, a task a workbook and sheet; see `workbooks` for schemas and options."""
    register(spark)
    reader = spark.read.format("workbook").option("sheet", sheet).option("source", str(source).lower())
    return (reader.schema(schema) if schema else reader).load(path)


def parse_workbooks(files: DataFrame, schema: T.StructType) -> DataFrame:
    """SRC1 on workbooks that are there as a column `content`."""
    names = [f.name for f in schema.fields]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r + [None] * len(names))[: len(names)] for data in pdf["content"] for r in sheet_rows(data)[1:]]
            yield pd.DataFrame(rows, columns=names, dtype=object)

    text = files.select("content").mapInPandas(parse, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    # dates are stored as days since 1899-12-30
    as_date = lambda n: F.date_add(F.lit("1899-12-30").cast("date"), F.col(n).try_cast("double").cast("int"))
    return text.select(*[(F.when(F.col(f.name).rlike(r"^\d+(\.\d+)?$"), as_date(f.name)).otherwise(F.col(f.name).try_cast("date")) if isinstance(f.dataType, T.DateType) else F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in schema.fields])


# --- page texts (SRC6, SRC7): any extractor gives array<string>; everything after that is native
def page_texts(files: DataFrame, extract: Column) -> DataFrame:
    """path, page (from 1), text. extract: a Column of array<string>, such as a pandas UDF over `content`."""
    return files.select("path", F.posexplode(extract).alias("page", "text")).withColumn("page", F.col("page") + 1)


def text_after(pages: DataFrame, target: str) -> DataFrame:
    """SRC6: path and the stripped text behind target on the first page that holds it; null without one."""
    hit = F.contains("text", F.lit(target))
    first = pages.groupBy("path").agg(F.min_by("text", F.when(hit, F.col("page")), ).alias("_t"), F.bool_or(hit).alias("_any"))
    return first.select("path", F.when(F.col("_any"), strip(after(F.col("_t"), target))).alias("text"))


def whole_text(pages: DataFrame) -> DataFrame:
    """SRC7: the pages of each file in order, joined."""
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("path").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text"))


def section_span(pages: DataFrame, start: str, end: str) -> DataFrame:
    """SRC7, STR24: path and the shortest text between two markers, which white space may break, looked for on the pages from the first that holds
    the one to the first that holds the other; null where a marker is missing or the second page comes first."""
    first = lambda marker: F.min(F.when(F.col("text").rlike(loose(marker)), F.col("page")))
    range_ = pages.groupBy("path").agg(first(start).alias("_from"), first(end).alias("_to"))
    inside = pages.join(range_, "path").where(F.col("page").between(F.col("_from"), F.col("_to")))
    joined = inside.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda p: p["text"]), "").alias("_t"))
    return range_.select("path").join(joined, "path", "left").select("path", section(F.col("_t"), start, end).alias("text"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def pdf_pages(content: pd.Series) -> pd.Series:
    """SRC6, SRC7: the page texts of PDF files by pypdf, where it is installed; any other extractor of that type does as well."""
    from pypdf import PdfReader

    return content.map(lambda data: [page.extract_text() for page in PdfReader(BytesIO(data)).pages])


# --- HTML (SRC9-SRC13): pages are a column; fetching is outside the engine
class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.href: str | None = None
        self.text: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self._close()
            self.href = dict(attrs).get("href")
            self.text = []

    def handle_data(self, data):
        if self.href is not None:
            self.text.append(data)

    def handle_endtag(self, tag):
        if tag == "a":
            self._close()

    def _close(self):
        if self.href is not None:
            self.found.append((" ".join("".join(self.text).split()), self.href))
        self.href = None


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("title", T.StringType()), T.StructField("href", T.StringType())])))
def links(html: pd.Series) -> pd.Series:
    """SRC10, SRC12: titles and targets of the links of a page, in order."""

    def one(text: str | None) -> list[dict]:
        parser = _Links()
        parser.feed(text or "")
        parser._close()
        return [{"title": t, "href": h} for t, h in parser.found]

    return html.map(one, na_action=None)


class _Fields(HTMLParser):
    """Text of the first element for each wanted (tag, attribute, value)."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    #: An ampersand that begins no reference closed by a semicolon; it stands for itself.
    BARE = re.compile(r"&(?!(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);)")

    def __init__(self, wanted: dict[str, tuple[str, str | None, str | None]]) -> None:
        super().__init__(convert_charrefs=True)
        self.wanted, self.out, self.open, self.mark = wanted, {}, [], ""

    def read(self, text: str) -> None:
        """Feeds a whole page, with a character that it doesn't hold in place of bare ampersands."""
        self.mark = next(c for c in map(chr, range(0xE000, 0x10FFFE)) if c not in text)
        self.feed(self.BARE.sub(self.mark, text))

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        given = {a: v and v.replace(self.mark, "&") for a, v in attrs}
        hit = next((n for n, (t, a, v) in self.wanted.items() if n not in self.out and t == tag and (a is None or given.get(a) == v)), None)
        if hit:
            self.out[hit] = ""
        self.open.append((tag, hit))

    def handle_endtag(self, tag):
        while self.open:
            if self.open.pop()[0] == tag:
                break

    def handle_data(self, data):
        for _, name in self.open:
            if name:
                self.out[name] += data.replace(self.mark, "&")


def article_fields(pages: DataFrame, html: str, keep: list[str], wanted: dict[str, tuple[str, str | None, str | None]], drop: bool = True) -> DataFrame:
    """SRC13: keep and one column per wanted field, with runs of white space (blanks, tabs, line breaks, form feeds) as one blank; rows that miss a field
    are dropped, or hold null there. References are read where a semicolon closes them."""
    struct = ", ".join(f"{n}: string" for n in wanted)

    @F.pandas_udf(f"struct<{struct}>")
    def read(col: pd.Series) -> pd.DataFrame:
        rows = []
        for text in col:
            parser = _Fields(wanted)
            parser.read(text or "")
            rows.append([re.sub(r"[ \t\n\f\r]+", " ", parser.out[n]).strip(" ") if n in parser.out else None for n in wanted])
        return pd.DataFrame(rows, columns=list(wanted))

    found = pages.withColumn("_f", read(html)).select(*keep, "_f.*")
    return found.dropna(how="any", subset=list(wanted)) if drop else found


def report_links(pages: DataFrame, key: str, html: str, word: str = "conflictos", card: str = "[class=card-body]") -> DataFrame:
    """SRC10: key, report number, title and href of the report cards of a listing page: in each card, the href of the first child, and as title the
    text that leads its first child; cards whose title holds the word, by the number in it that has white space on both sides. Links outside cards
    don't count."""
    fields = {"title": (":nth-child(1) > :nth-child(1)", "lead"), "href": ("> :nth-child(1)", "@href")}
    found = pages.select(key, F.inline(elements(F.col(html), card, {n: ("> " + p.removeprefix("> "), w) for n, (p, w) in fields.items()})))
    number = spaced_number(F.concat(F.lit(" "), "title", F.lit(" ")))
    return found.where(F.contains("title", F.lit(word))).select(key, number.alias("report_id"), "title", "href")


def section_links(pages: DataFrame, key: str, html: str, section: str = "section#search-page") -> DataFrame:
    """SRC12: key, place (from 0), title and href of the links inside the first section of that path."""
    inside = elements(F.col(html), section + " a[href]", {"title": ("", "text"), "href": ("", "@href")})
    return pages.select(key, F.posexplode(inside).alias("place", "_l")).select(key, "place", "_l.title", "_l.href")


def crawl_grid(spark: SparkSession, terms: list[str], pages: int, inclusive: bool = True) -> DataFrame:
    """SRC11, SRC12: (term, page) to fetch."""
    return grid(spark.createDataFrame([(t,) for t in terms], "term string"), pages, inclusive)


def grid(terms: DataFrame, pages: int, inclusive: bool = True) -> DataFrame:
    """SRC11, SRC12 on a table of terms."""
    last = pages if inclusive else pages - 1
    return terms.select("term", F.explode(F.sequence(F.lit(1), F.lit(last))).alias("page"))


def write_json(df: DataFrame, path: str) -> None:
    """SNK1: JSON lines."""
    df.write.mode("overwrite").json(path)


def write_json_columns(df: DataFrame, path: str, *order: str) -> None:
    """SNK1, column by column: one document {"column": {"0": value, "1": value, ...}, ...}, rows numbered in ascending order of some columns; dates and
    times are milliseconds, nulls stay. The files under path, one after another in order of name, are the document; cells are sorted by range, so none
    of them holds a whole column of a large table."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    placed = ordered_positions(df, *order, position="_place")
    n = placed.count()

    def text(name: str) -> Column:
        c = F.col(f"`{name}`")
        if isinstance(kinds[name], T.DateType):
            c = F.unix_date(c).cast("long") * 86_400_000
        elif isinstance(kinds[name], (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_millis(c.cast("timestamp"))
        return F.regexp_replace(F.to_json(F.array(c)), r"(?s)\A\[|\]\z", "")

    names = df.columns
    quoted = [json.dumps(x, ensure_ascii=False) for x in names]
    if not n:
        whole = "{" + ",".join(q + ":{}" for q in quoted) + "}"
        df.sparkSession.createDataFrame([(whole,)], "value string").write.mode("overwrite").text(path)
        return
    head = F.element_at(F.array(*[F.lit(("{" if i == 0 else "") + q + ":{") for i, q in enumerate(quoted)]), F.col("c") + 1)
    end = F.when(F.col("p") < n - 1, ",").when(F.col("c") < len(names) - 1, "},").otherwise("}}")
    cells = placed.select(F.col("_place").alias("p"), F.posexplode(F.array(*map(text, names))).alias("c", "v"))
    line = F.concat(F.when(F.col("p") == 0, head).otherwise(""), F.lit('"'), F.col("p").cast("string"), F.lit('":'), "v", end)
    cells.repartitionByRange("c", "p").sortWithinPartitions("c", "p").select(line.alias("value")).write.mode("overwrite").text(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """SNK1: each file one array of records, as SRC2 reads them; as many files as partitions, written in a stream."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            if batch.num_rows:
                rows = batch.column("value").to_pylist()
                yield pa.RecordBatch.from_pydict({"value": [before + rows[0], *("," + r for r in rows[1:])]}, schema=schema)
                before = ","
        yield pa.RecordBatch.from_pydict({"value": ["]" if before == "," else "[]"]}, schema=schema)

    schema = pa.schema([("value", pa.string())])
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """SNK2, SNK3: with a header; as many files as partitions; white space around values stays."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
