"""Records of large single files read by many tasks (SRC2, SRC3): a prefix scan over the blocks of a file.

Spark's text source cuts a file into blocks at a one-byte mark: the line break for CSV, the closing brace for a JSON array. Whether a mark ends a record
depends on all that stands before it: an open quote, how deep brackets are nested. So a first pass takes from each block what it does to either
possible beginning (inside a string or not), by array operations on whole batches; the blocks' few numbers are composed in order on the driver (one row
a block, a block being spark.sql.files.maxPartitionBytes long); a second pass then knows where each block begins and gives whole records. Only pieces
of records that reach over a block's edge are shuffled."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Scan:
    """For the rows of a batch and either beginning (0 outside, 1 inside a string): the state behind each row, the depth against the beginning, and
    whether its mark may end a record there."""

    state: tuple[np.ndarray, np.ndarray]
    depth: tuple[np.ndarray, np.ndarray]
    may_end: tuple[np.ndarray, np.ndarray]


class Csv:
    """Lines; a line break within quotes ends no record. Quotes inside a value are doubled, and a value that isn't quoted holds none."""

    mark, closing = "\n", ""

    def scan(self, rows: pa.Array) -> Scan:
        quotes = np.cumsum(pc.count_substring(rows, '"').to_numpy(zero_copy_only=False)) % 2
        zero = np.zeros(len(rows), np.int64)
        return Scan((quotes, 1 - quotes), (zero, zero), (quotes == 0, quotes == 1))

    def base(self, first: str) -> int:
        return 0

    def begins(self, text: str) -> bool:
        return True


class JsonArray:
    """Pieces up to a closing brace; one outside strings ends a record where the depth is that of the array's elements (0 without an array)."""

    mark, closing = "}", "}"

    def scan(self, rows: pa.Array) -> Scan:
        ends = np.cumsum(pc.binary_length(rows).to_numpy(zero_copy_only=False).astype(np.int64) + 1) - 1
        text = np.frombuffer(b"".join(x for row in rows.cast(pa.large_binary()).to_pylist() for x in (row, b"}")), np.uint8)
        place = np.arange(len(text))
        quotes = np.flatnonzero(text == ord('"'))
        # a quote behind an odd number of backslashes is part of a string
        plain = np.maximum.accumulate(np.where(text != ord("\\"), place, -1))
        before = np.maximum(quotes - 1, 0)
        escaped = (quotes > 0) & ((before - plain[before]) % 2 == 1)
        inside = np.zeros(len(text), np.int64)
        inside[quotes[~escaped]] = 1
        inside = np.cumsum(inside) % 2
        step = np.isin(text, list(b"{[")).astype(np.int64) - np.isin(text, list(b"}]"))
        depth = [np.cumsum(step * (inside == side))[ends] for side in (0, 1)]
        last = inside[ends]
        return Scan((last, 1 - last), (depth[0], depth[1]), (last == 0, last == 1))

    def base(self, first: str) -> int:
        return int(first.lstrip("﻿ \t\r\n").startswith("["))

    def begins(self, text: str) -> bool:
        return "{" in text


SUMMARY = "file string, at long, base int, state0 int, state1 int, depth0 long, depth1 long, low0 long, low1 long"
_NEVER = 1 << 60
#: Bytes of text that are scanned at once (one row at least): a scan holds some sixty times as much.
STRETCH = 1 << 20


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Stretches of rows of one block, of STRETCH bytes at most behind their first row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, at = batch.column("file"), batch.column("at").to_numpy()
        names = file.dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(names) != 0) | (np.diff(at) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rows = batch.column("value").slice(a, b - a)
            stretch = np.cumsum(pc.binary_length(rows).to_numpy(zero_copy_only=False).astype(np.int64) + 1) // STRETCH
            edges = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(rows)]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                yield file[a].as_py(), int(at[a]), rows.slice(i, j - i)


def _lines(spark: SparkSession, path: str, kind: Csv | JsonArray) -> DataFrame:
    return spark.read.option("lineSep", kind.mark).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))


def _summaries(lines: DataFrame, kind: Csv | JsonArray) -> list:
    """What each block does to either beginning: its state and depth at the end, and the least depth at which a mark may end a record."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, made = None, []
        for file, at, rows in _blocks(batches):
            if now is None or now["file"] != file or now["at"] != at:
                now = {"file": file, "at": at, "base": kind.base(rows[0].as_py()) if at == 0 else 0} | {f"{k}{s}": v for s in (0, 1) for k, v in (("state", s), ("depth", 0), ("low", _NEVER))}
                made.append(now)
            found = kind.scan(rows)
            for s in (0, 1):
                h = now[f"state{s}"]
                ends = found.depth[h][found.may_end[h]]
                if len(ends):
                    now[f"low{s}"] = min(now[f"low{s}"], now[f"depth{s}"] + int(ends.min()))
                now[f"state{s}"], now[f"depth{s}"] = int(found.state[h][-1]), now[f"depth{s}"] + int(found.depth[h][-1])
        kinds = pa.schema([("file", pa.string()), ("at", pa.int64()), ("base", pa.int32()), ("state0", pa.int32()), ("state1", pa.int32()), *[(f"{k}{s}", pa.int64()) for k in ("depth", "low") for s in (0, 1)]])
        yield pa.RecordBatch.from_pylist(made, schema=kinds)

    return lines.mapInArrow(summarise, SUMMARY).orderBy("file", "at").collect()  # one row a block


def compose(blocks: list) -> tuple[dict[tuple[str, int], tuple[int, int, int, int]], bool]:
    """Where each block begins: state, depth, depth of records, and the block in which the record begins that is open there (itself if none is); and
    whether any record reaches over an edge or the end of its file."""
    begin, file, state, depth, base, owner, over = {}, None, 0, 0, 0, 0, False
    for b in blocks:
        if b["file"] != file:
            over |= state == 1
            file, state, depth, base, owner = b["file"], 0, 0, b["base"], b["at"]
            is_open = False
        else:
            is_open = (state, depth) != (0, base)
        owner = owner if is_open else b["at"]
        over |= owner != b["at"]
        begin[file, b["at"]] = state, depth, base, owner
        if depth + b[f"low{state}"] <= base:
            owner = b["at"]
        state, depth = b[f"state{state}"], depth + b[f"depth{state}"]
    return begin, over or state == 1


def split_records(spark: SparkSession, path: str, kind: Csv | JsonArray) -> DataFrame:
    """record, is_first (of its file), for all records of the files under path; as many tasks as the files have blocks."""
    lines = _lines(spark, path, kind)
    places, over = compose(_summaries(lines, kind))
    begin = spark.sparkContext.broadcast(places)

    def cut(pieces: bool):
        """Whole records, or the pieces of those that reach over an edge."""

        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: dict[str, list] = {k: [] for k in ("file", "owner", "at", "is_first", "record")}
            held: list[str] = []
            where, count, size = None, 0, 0

            def put(owner: int, text: str, first: bool) -> None:
                for k, v in zip(out, (*where[:1], owner, where[1], first, text), strict=True):
                    out[k].append(v)

            def close() -> None:
                """What is left of a block: its last record goes on in the next one, or the file ends."""
                if not held:
                    return
                text = kind.mark.join(held)
                goes_on = not count and owner != where[1]
                if goes_on or kind.begins(text):
                    leftover.append((where[0], owner if not count else where[1], where[1], where[1] == 0 and not count, text))
                held.clear()

            leftover: list[tuple] = []
            state = depth = base = owner = 0
            for file, at, rows in _blocks(batches):
                if where != (file, at):
                    close()
                    where, count = (file, at), 0
                    state, depth, base, owner = begin.value[where]
                found, texts = kind.scan(rows), rows.to_pylist()
                ends = np.flatnonzero(found.may_end[state] & (found.depth[state] + depth == base)).tolist()
                last = 0
                for e in ends:
                    text = texts[e] if last == e and not held else kind.mark.join([*held, *texts[last : e + 1]])
                    held.clear()
                    last = e + 1
                    if not count and owner != at:
                        if pieces:
                            put(owner, text, False)
                    elif not pieces:
                        put(at, text, at == 0 and not count)
                    count += 1
                    size += len(text)
                held += texts[last:]
                state, depth = int(found.state[state][-1]), depth + int(found.depth[state][-1])
                if len(out["file"]) > 10_000 or size > 8 * STRETCH:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    out, size = {k: [] for k in out}, 0
            close()
            for row in leftover if pieces else []:
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

        schema = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("at", pa.int64()), ("is_first", pa.bool_()), ("record", pa.string())])
        return lines.mapInArrow(one, "file string, owner long, at long, is_first boolean, record string")

    closing = F.lit(kind.closing)
    whole = cut(False).select(F.concat("record", closing).alias("record"), "is_first")
    if not over:
        return whole
    joined = cut(True).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("at", "record"))).alias("p"), F.bool_or("is_first").alias("is_first"))
    return whole.unionByName(joined.select(F.concat(F.array_join(F.transform("p", lambda x: x["record"]), kind.mark), closing).alias("record"), "is_first"))


def csv_records(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """SRC3: rows of the CSV files under path, each with a header; quoted values may hold line breaks and doubled quotes. Blank lines are skipped."""
    records = split_records(spark, path, Csv()).where(~F.col("is_first"))
    text = F.regexp_replace("record", r"\r\z", "")
    return _parsed(records.where(text != ""), F.from_csv(text, _ddl(schema), {"sep": sep, "escape": '"', "maxCharsPerColumn": "-1"}), schema)


def json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC2: the records of files that each hold one array of them (or records one after another); elements that aren't records are left out."""
    records = split_records(spark, path, JsonArray())
    return _parsed(records, F.from_json(F.regexp_replace("record", r"\A[^{]*", ""), schema), schema)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _parsed(records: DataFrame, row: Column, schema: T.StructType) -> DataFrame:
    return records.select(row.alias("_r")).select(*[F.col(f"_r.`{n}`").alias(n) for n in schema.names])
