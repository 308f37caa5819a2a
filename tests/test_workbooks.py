"""The workbook data source: written books, sheets, kinds of cells, declared and inferred schemas."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import types as T

from quillwork.sources import workbooks
from quillwork.sources.workbooks import Book, column_of, kind_of, reference, register, write_book

DAY = dt.datetime(2021, 3, 4)
PEOPLE = [["id", "name", "born", "ok", "share"], [1, "a<b & c", DAY, True, 0.5], [2, None, None, False, 2], [None, "third\nline", DAY + dt.timedelta(days=1), None, None]]
MORE = [["id", "name"], [7, "seven"], [8, "  spaces  "]]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.xlsx").write_bytes(write_book({"people": PEOPLE, "more": MORE}))
    (tmp_path / "b.xlsx").write_bytes(write_book({"people": [PEOPLE[0], [9, "nine", DAY, True, 1.5]]}))
    return str(tmp_path)


def test_references():
    for i in (0, 25, 26, 51, 701, 702, 16383):
        assert column_of(reference(3, i)) == i
    assert [reference(1, i) for i in (0, 25, 26, 702)] == ["A1", "Z1", "AA1", "AAA1"]


def test_round_trip_of_a_book(tmp_path):
    wide = [[f"c{i}" for i in range(800)], list(range(800))]
    path = tmp_path / "x.xlsx"
    path.write_bytes(write_book({"people": PEOPLE, "more & more": MORE, "wide": wide}))
    book = Book(str(path))
    assert list(book.sheets) == ["people", "more & more", "wide"]
    strip = lambda row: row[: max(i for i, v in enumerate(row) if v is not None) + 1]
    assert list(book.rows("people")) == [strip(r) for r in PEOPLE] and list(book.rows("wide")) == wide


def test_inferred_schema_and_partitions(spark, folder):
    register(spark)
    df = spark.read.format("workbook").load(folder)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("id", "bigint"), ("name", "string"), ("born", "date"), ("ok", "boolean"), ("share", "double")]
    assert df.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [(1, "a<b & c", DAY.date(), True, 0.5), (2, None, None, False, 2.0), (None, "third\nline", dt.date(2021, 3, 5), None, None), (9, "nine", DAY.date(), True, 1.5)], key=str
    )


def test_all_sheets_with_their_names(spark, folder):
    register(spark)
    df = spark.read.format("workbook").option("sheet", "*").option("source", "true").schema("name string, id long, _sheet string, _file string").load(folder + "/*.xlsx")
    assert df.rdd.getNumPartitions() == 3
    got = {(r["name"], r["id"], r["_sheet"], r["_file"].rsplit("/", 1)[1]) for r in df.collect()}
    assert ("seven", 7, "more", "a.xlsx") in got and ("nine", 9, "people", "b.xlsx") in got and len(got) == 6
    one = spark.read.format("workbook").option("sheet", "more").load(folder + "/a.xlsx")
    assert {tuple(r) for r in one.collect()} == {(7, "seven"), (8, "  spaces  ")}


def test_what_does_not_fit(spark, folder):
    register(spark)
    read = spark.read.format("workbook").schema("name long, id string, share int")
    assert {tuple(r) for r in read.load(folder + "/a.xlsx").collect()} == {(None, "1", None), (None, "2", 2), (None, None, None)}
    with pytest.raises(Exception, match="a<b"):
        read.option("mode", "FAILFAST").load(folder + "/a.xlsx").collect()


def test_without_a_header_by_place(spark, folder):
    register(spark)
    got = spark.read.format("workbook").option("header", "false").option("sheet", "2").load(folder + "/a.xlsx")
    assert got.columns == ["_c0", "_c1"] and {r["_c0"] for r in got.collect()} == {"id", "7", "8"}
    by_place = spark.read.format("workbook").schema("x long, y string").option("sheet", "more").load(folder + "/a.xlsx")
    assert {tuple(r) for r in by_place.collect()} == {(7, "seven"), (8, "  spaces  ")}


def test_shared_texts_formats_and_epochs(tmp_path):
    """What other programs write: shared texts with runs and phonetic hints, custom date formats, the 1904 epoch, errors, formulas, cells without references."""
    main, rel = workbooks._MAIN[1:-1], workbooks._REF[1:-3]
    with zipfile.ZipFile(tmp_path / "x.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><workbookPr date1904="1"/><sheets><sheet name="S" sheetId="1" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="a" Target="/xl/worksheets/one.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>plain</t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh sb="0" eb="1"><t>hint</t></rPh></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/one.xml", f'<worksheet xmlns="{main}"><sheetData><row r="1"><c t="s"><v>0</v></c><c t="s"><v>1</v></c></row><row r="2"/><row r="3"><c r="B3" s="1"><v>1.5</v></c><c r="C3" s="2"><v>2</v></c><c r="D3" t="e"><v>#N/A</v></c><c r="E3" t="str"><f>A1</f><v>made</v></c></row></sheetData></worksheet>')
    assert list(Book(str(tmp_path / "x.xlsx")).rows("S")) == [["plain", "two runs"], [None, dt.datetime(1904, 1, 2, 12), 2, None, "made"]]


def test_kinds():
    assert kind_of([1, None, 2.5]) == T.DoubleType() and kind_of([1, "x"]) == T.StringType() and kind_of([]) == T.StringType()
    assert kind_of([DAY + dt.timedelta(hours=1)]) == T.TimestampNTZType() and kind_of([True, 1]) == T.StringType()
