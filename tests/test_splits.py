"""Large single files read by many tasks, against Spark's own multi-line readers."""

import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import types as T

from quillwork.sources import splits

CSV = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.DoubleType())])
JSON = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("in", T.StructType([T.StructField("a", T.LongType()), T.StructField("more", T.ArrayType(T.StructType([T.StructField("b", T.StringType())])))])),
])


@contextmanager
def blocks_of(spark, size):
    """Files are cut every `size` bytes, each block a task."""
    given = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": str(size), "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def bag(df):
    return sorted(map(repr, df.collect()))


def csv_text(rows, eol="\n"):
    quoted = lambda x: '"' + x.replace('"', '""') + '"'
    return eol.join(["id,text,n", *[f"{i},{quoted(t) if q else t},{n}" for i, t, q, n in rows]]) + eol


def awkward_rows(seed, n=120):
    r = random.Random(seed)
    parts = ["plain", 'a "quoted" word', "line\nbreak", "comma, inside", "", '""', "é漢😀", "tab\there", "\n\n", "x" * 90, '"', "  spaces  ", "}{][", "back\\slash", '\\"']
    rows = []
    for i in range(n):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 4)))
        needs = any(c in text for c in '",\n\r')
        rows.append((i, text, needs or r.random() < 0.5, r.choice(["1.5", "", "2"])))
    return rows


@pytest.mark.parametrize("size", [90, 1500])
@pytest.mark.parametrize("seed", [1, 2])
def test_one_csv_file_in_many_tasks(spark, tmp_path, size, seed):
    path = tmp_path / "one.csv"
    path.write_text(csv_text(awkward_rows(seed)), newline="")
    plain = spark.read.schema(CSV).option("header", True).option("multiLine", True).option("escape", '"').csv(str(path))
    expected = bag(plain)
    with blocks_of(spark, size):
        got = splits.csv_records(spark, str(path), CSV)
        assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() > path.stat().st_size // size // 2
        assert bag(got) == expected


def test_csv_files_of_a_folder(spark, tmp_path):
    """Headers of each, ends without a line break, carriage returns, a byte order mark, blank lines, an empty file, a value longer than several blocks."""
    texts = [csv_text(awkward_rows(3, 20)), csv_text(awkward_rows(4, 9))[:-1], csv_text([(1, "a", False, "2"), (2, "b\nc", True, "")], "\r\n"), "id,text,n\n\n1,x,\n\n\n2,y,3\n", "", "id,text,n\n", csv_text([(5, "y\n" * 400, True, "1")])]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
    plain = spark.read.schema(CSV).option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    expected = bag(plain)
    with blocks_of(spark, 50):
        assert bag(splits.csv_records(spark, str(tmp_path), CSV)) == expected
    assert bag(splits.csv_records(spark, str(tmp_path), CSV)) == expected


def json_rows(seed, n=80):
    r = random.Random(seed)
    parts = ["plain", '"', "}", "{", "]", "[", "\\", '\\"', "é漢😀", "\n", "},{", "", "x" * 70]
    text = lambda: "".join(r.choice(parts) for _ in range(r.randint(0, 4)))
    return [{"id": i, "text": text(), "tags": [text() for _ in range(r.randint(0, 3))], "in": {"a": i, "more": [{"b": text()} for _ in range(r.randint(0, 3))]} if r.random() < 0.7 else None} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [150, 2000])
def test_one_json_array_in_many_tasks(spark, tmp_path, size, indent):
    path = tmp_path / "one.json"
    path.write_text(json.dumps(json_rows(size), indent=indent, ensure_ascii=bool(indent)))
    expected = bag(spark.read.schema(JSON).option("multiLine", True).json(str(path)))
    with blocks_of(spark, size):
        assert bag(splits.json_records(spark, str(path), JSON)) == expected


def test_json_files_of_a_folder(spark, tmp_path):
    for i, rows in enumerate([json_rows(7, 5), [], json_rows(8, 1), {"id": 1, "in": {"a": 2}}]):
        (tmp_path / f"{i}.json").write_text(json.dumps(rows))
    expected = bag(spark.read.schema(JSON).option("multiLine", True).json(str(tmp_path)))
    with blocks_of(spark, 64):
        assert bag(splits.json_records(spark, str(tmp_path), JSON)) == expected


def test_only_needed_values_are_parsed(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text(awkward_rows(5)))
    got = splits.csv_records(spark, str(tmp_path), CSV).select("id")
    assert [r["id"] for r in got.orderBy("id").collect()] == list(range(120))


def test_blocks_are_scanned_in_short_stretches():
    """A batch of many long rows is cut, so that what a scan holds doesn't grow with the batch."""
    import pyarrow as pa

    rows = ["x" * 5000] * 3000 + ["y" * (2 * splits.STRETCH)] + ["z"] * 10
    batch = pa.RecordBatch.from_pydict({"value": rows, "file": ["f"] * len(rows), "at": [0] * 2000 + [7] * (len(rows) - 2000)})
    got = list(splits._blocks(iter([batch])))
    assert [r for _, _, part in got for r in part.to_pylist()] == rows and [a for _, a, part in got for _ in range(len(part))] == batch.column("at").to_pylist()
    assert all(sum(map(len, part.to_pylist()[1:])) <= splits.STRETCH for _, _, part in got)
