"""Workbooks (.xlsx) as a Spark data source (SRC1), by the standard library: a partition for each workbook and sheet, rows streamed from the sheet's XML.

    register(spark)
    spark.read.format("workbook").option("sheet", "*").load("folder/*.xlsx")

Options: sheet (a name, a number from 1, or * for all; default 1), header (default true), source (true adds _file and _sheet), inferRows (rows of each
sheet of the first workbook that types are taken from, default 1000), mode (PERMISSIVE: what doesn't fit its column's type is null; FAILFAST: raises).
With a declared schema, columns go by the header's names, or by place where the header has none of them. Blank rows are left out, as are rows behind the
last that has a cell."""

from __future__ import annotations

import datetime as dt
import fnmatch
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from io import BytesIO
from typing import Any
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REF = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Built-in number formats that show dates or times (fixed values).
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def column_of(ref: str) -> int:
    """A cell's column from its reference, such as AB12, from 0."""
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def reference(row: int, column: int) -> str:
    name = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        name = chr(65 + rest) + name
    return f"{name}{row}"


class Book:
    """An open workbook: names of its sheets, and streams of their rows."""

    def __init__(self, file: Any):
        self.zip = zipfile.ZipFile(file)
        names = set(self.zip.namelist())
        self.sheets: dict[str, str] = {}
        self.epoch = dt.datetime(1899, 12, 30)
        if "xl/workbook.xml" in names:
            root = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
            links = {}
            if "xl/_rels/workbook.xml.rels" in names:
                links = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
            for sheet in root.iter(f"{_MAIN}sheet"):
                target = links.get(sheet.get(_REF), "").lstrip("/")
                target = target if target.startswith("xl/") else f"xl/{target}"
                if target in names:
                    self.sheets[sheet.get("name", target)] = target
            if any(p.get("date1904") in ("1", "true") for p in root.iter(f"{_MAIN}workbookPr")):
                self.epoch = dt.datetime(1904, 1, 1)
        if not self.sheets:
            found = sorted((n for n in names if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)), key=lambda n: (len(n), n))
            self.sheets = {n.rsplit("/", 1)[1][:-4]: n for n in found}
        self.names = names
        self._shared: list[str] | None = None
        self._dates: set[int] | None = None

    def shared(self) -> list[str]:
        """Texts that cells refer to by number."""
        if self._shared is None:
            self._shared = []
            if "xl/sharedStrings.xml" in self.names:
                with self.zip.open("xl/sharedStrings.xml") as f:
                    for _, e in ElementTree.iterparse(f):
                        if e.tag == f"{_MAIN}si":
                            self._shared.append(_plain(e))
                            e.clear()
        return self._shared

    def date_styles(self) -> set[int]:
        """Numbers of the styles that show a number as a date or time."""
        if self._dates is None:
            self._dates = set()
            if "xl/styles.xml" in self.names:
                root = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
                own = {int(f.get("numFmtId", 0)): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")) for f in root.iter(f"{_MAIN}numFmt")}
                dates = _DATE_FORMATS | {i for i, code in own.items() if re.search("[ymdhs]", code.lower())}
                for formats in root.iter(f"{_MAIN}cellXfs"):
                    self._dates = {i for i, x in enumerate(formats.findall(f"{_MAIN}xf")) if int(x.get("numFmtId", 0)) in dates}
        return self._dates

    def rows(self, sheet: str) -> Iterator[list]:
        """Values of each row that has any: texts, whole and other numbers, truth values, dates; None for empty cells."""
        with self.zip.open(self.sheets[sheet]) as f:
            for _, e in ElementTree.iterparse(f):
                if e.tag != f"{_MAIN}row":
                    continue
                cells = {}
                for k, c in enumerate(e.findall(f"{_MAIN}c")):
                    value = self._value(c)
                    if value is not None:
                        cells[column_of(c.get("r")) if c.get("r") else k] = value
                e.clear()
                if cells:
                    yield [cells.get(i) for i in range(max(cells) + 1)]

    def _value(self, c: ElementTree.Element) -> Any:
        kind = c.get("t", "n")
        if kind == "inlineStr":
            return _plain(c.find(f"{_MAIN}is"))
        v = c.find(f"{_MAIN}v")
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.shared()[int(v.text)]
        if kind == "b":
            return v.text.strip() == "1"
        if kind == "n":
            number = float(v.text)
            if int(c.get("s", 0)) in self.date_styles():
                return self.epoch + dt.timedelta(milliseconds=round(number * 86_400_000))
            return int(number) if number.is_integer() and abs(number) < 1 << 53 else number
        return None if kind == "e" else v.text


def _plain(e: ElementTree.Element | None) -> str:
    """The text of all runs; phonetic hints are left out."""
    if e is None:
        return ""
    return "".join(t.text or "" for child in e for t in ([child] if child.tag == f"{_MAIN}t" else child.findall(f"{_MAIN}t") if child.tag == f"{_MAIN}r" else []))


def write_book(sheets: dict[str, list[list]]) -> bytes:
    """An .xlsx file of sheets of rows; texts, numbers, truth values and dates keep their kinds."""
    out = BytesIO()
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rel = _MAIN[1:-1], _REF[1:-3]
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        listed = "".join(f'<sheet name={_quoted(name)} sheetId="{i}" r:id="rId{i}"/>' for i, name in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        z.writestr("xl/styles.xml", f'{head}<styleSheet xmlns="{main}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values(), 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                f.write(f'{head}<worksheet xmlns="{main}"><sheetData>'.encode())
                for r, row in enumerate(rows, 1):
                    f.write(f'<row r="{r}">{"".join(_cell(reference(r, k), v) for k, v in enumerate(row) if v is not None)}</row>'.encode())
                f.write(b"</sheetData></worksheet>")
    return out.getvalue()


def _quoted(text: str) -> str:
    return '"' + escape(text, {'"': "&quot;"}) + '"'


def _cell(ref: str, value: Any) -> str:
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, dt.date):
        moment = value if isinstance(value, dt.datetime) else dt.datetime(value.year, value.month, value.day)
        return f'<c r="{ref}" s="1"><v>{(moment - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)!r}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def files_of(path: str) -> list[str]:
    """Workbooks at a path: a file, a folder (with those below it), or a folder with a pattern; in order of name."""
    from pyarrow import fs

    folder, _, pattern = path.rpartition("/") if re.search(r"[*?\[]", path.rsplit("/", 1)[-1]) else (path, "", "*")
    system, root = _open(folder)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [path]
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    inside = [f.path for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern) and f.base_name[0] not in "._~"]
    prefix = folder[: len(folder) - len(root.rstrip("/"))] if folder.endswith(root.rstrip("/")) else ""
    return sorted(prefix + f for f in inside)


@dataclass
class SheetPartition(InputPartition):
    file: str
    sheet: str


def kind_of(values: list) -> T.DataType:
    """The type that holds all of some values of a column."""
    kinds = {type(v) for v in values if v is not None}
    if kinds == {bool}:
        return T.BooleanType()
    if kinds == {int}:
        return T.LongType()
    if kinds and kinds <= {int, float}:
        return T.DoubleType()
    if kinds == {dt.datetime}:
        return T.DateType() if all(v.time() == dt.time() for v in values if v is not None) else T.TimestampNTZType()
    return T.StringType()


def shown(value: Any) -> str:
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, dt.datetime):
        return value.date().isoformat() if value.time() == dt.time() else value.isoformat(" ")
    return str(value)


def fitted(value: Any, kind: T.DataType, epoch: dt.datetime = dt.datetime(1899, 12, 30)) -> Any:
    """value as that type; raises where it has no such form."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return shown(value)
    if isinstance(kind, T.BooleanType):
        if isinstance(value, bool) or str(value).lower() in ("true", "false", "0", "1"):
            return str(value).lower() in ("true", "1")
        raise ValueError(f"no truth value: {value!r}")
    if isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
        if isinstance(value, str) and re.fullmatch(r"\d+(\.\d+)?", value.strip()):
            value = float(value)  # days as text
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            value = epoch + dt.timedelta(milliseconds=round(value * 86_400_000))
        elif isinstance(value, str):
            value = dt.datetime.fromisoformat(value.strip())
        if not isinstance(value, dt.datetime):
            raise ValueError(f"no date: {value!r}")
        return value.date() if isinstance(kind, T.DateType) else value
    if isinstance(value, dt.datetime):
        raise ValueError(f"no number: {value!r}")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = int(value) if isinstance(value, (bool, int)) else float(value)
        if number != int(number):
            raise ValueError(f"no whole number: {value!r}")
        return int(number)
    return float(value)


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options

    def chosen(self, book: Book) -> list[str]:
        wanted, names = self.options.get("sheet", "1"), list(book.sheets)
        if wanted == "*":
            return names
        if wanted in book.sheets:
            return [wanted]
        return names[int(wanted) - 1 : int(wanted)] if wanted.isdigit() else []

    def partitions(self) -> list[SheetPartition]:
        out = []
        for file in files_of(self.options["path"]):
            system, path = _open(file)
            with system.open_input_file(path) as f:
                out += [SheetPartition(file, sheet) for sheet in self.chosen(Book(f))]
        return out

    def flag(self, name: str, default: str) -> bool:
        return self.options.get(name, default).lower() == "true"

    def read(self, partition: SheetPartition) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        given = [f for f in self.schema.fields if not (self.flag("source", "false") and f.name in ("_file", "_sheet"))]
        strict, schema = self.options.get("mode", "PERMISSIVE").upper() == "FAILFAST", to_arrow_schema(self.schema)
        system, path = _open(partition.file)
        with system.open_input_file(path) as f:
            book = Book(f)
            rows = book.rows(partition.sheet)
            places = list(range(len(given)))
            if self.flag("header", "true"):
                header = [shown(v) if v is not None else None for v in next(rows, [])]
                if any(g.name in header for g in given):
                    places = [header.index(g.name) if g.name in header else None for g in given]
            columns: list[list] = [[] for _ in given]

            def batch() -> pa.RecordBatch:
                made = {g.name: c for g, c in zip(given, columns, strict=True)}
                n = len(columns[0]) if columns else 0
                made |= {"_file": [partition.file] * n, "_sheet": [partition.sheet] * n}
                arrays = [pa.array(made[field.name], field.type) for field in schema]
                for c in columns:
                    c.clear()
                return pa.RecordBatch.from_arrays(arrays, schema=schema)

            for row in rows:
                for g, k, column in zip(given, places, columns, strict=True):
                    value = row[k] if k is not None and k < len(row) else None
                    try:
                        column.append(fitted(value, g.dataType, book.epoch))
                    except (ValueError, OverflowError):
                        if strict:
                            raise
                        column.append(None)
                if columns and len(columns[0]) >= 5000:
                    yield batch()
            yield batch()


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> T.StructType:
        """Names from the header of the first workbook's first chosen sheet, types from its first rows."""
        files = files_of(self.options["path"])
        if not files:
            raise ValueError(f"no workbook at {self.options['path']}")
        system, path = _open(files[0])
        reader = WorkbookReader(T.StructType(), self.options)
        names: list[str] = []
        values: list[list] = []
        with system.open_input_file(path) as f:
            book = Book(f)
            for sheet in reader.chosen(book):
                rows = book.rows(sheet)
                if reader.flag("header", "true"):
                    header = [shown(v) if v is not None else f"_c{i}" for i, v in enumerate(next(rows, []))]
                    names = names or header
                for _, row in zip(range(int(self.options.get("inferRows", "1000"))), rows, strict=False):
                    values += [[] for _ in range(len(row) - len(values))]
                    for column, v in zip(values, row, strict=False):
                        column.append(v)
        names += [f"_c{i}" for i in range(len(names), len(values))]
        fields = [T.StructField(n, kind_of(values[i]) if i < len(values) else T.StringType()) for i, n in enumerate(names)]
        if reader.flag("source", "false"):
            fields += [T.StructField("_file", T.StringType()), T.StructField("_sheet", T.StringType())]
        return T.StructType(fields)

    def reader(self, schema: T.StructType) -> WorkbookReader:
        return WorkbookReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)
