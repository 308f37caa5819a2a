"""Operator 9: token ids as flat unsigned integer files with 64-bit document offsets.

Format, in one folder: part-NNNNN.bin holds the ids of its documents one after another (uint16 where the vocabulary fits, else uint32),
part-NNNNN.idx holds n_docs + 1 little-endian uint64 offsets in ids, part-NNNNN.docs the doc_ids (Arrow IPC, since doc_id may be null), and
manifest.json each part's base, the prefix sum of the ids before it. Documents are in ascending doc_id order (null first, equal doc_ids by text).

Each task writes its own part under a name of its attempt and renames it, so lost executors and repeated attempts leave whole parts only.
Only one row per part reaches the driver.

Edge cases: null and empty texts are the end id alone; repeated rows are written as often as they come; an empty table gives an empty manifest;
other columns are ignored."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, release_memory, scratch
from .tokens import END_ID, crc_u32, default_tokenizer, encoder

PARTS = "part long, file string, docs long, tokens long, dtype string"


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_tokens(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = END_ID) -> str:
    """Writes documents' ids in the file format; returns the folder. folder: a URI that driver and executors share."""
    spark = docs.sparkSession
    folder, tokenizer = folder or scratch(spark, "tokens"), tokenizer or default_tokenizer()
    system, root = _open(folder)
    system.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, enc = context.partitionId(), encoder(tokenizer)
        files, base = _open(folder)
        name = f"{base}/part-{part:05d}"
        own = f"{base}/.{part:05d}-{context.stageId()}-{context.attemptNumber()}-{context.taskAttemptId()}"
        out, ids, ends = None, [], [np.zeros(1, "<u8")]
        total = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or files.open_output_stream(f"{own}.bin")
            sizes = []
            for data in enc.batch(as_bytes(batch.column("text")), end_id):
                out.write(data)
                sizes.append(len(data) // enc.dtype.itemsize)
            ends.append((np.cumsum(sizes) + total).astype("<u8"))
            total = int(ends[-1][-1])
            ids.append(batch.column("doc_id"))
        if out is None:
            return
        out.close()
        offsets = np.concatenate(ends)
        with files.open_output_stream(f"{own}.idx") as f:
            f.write(offsets.tobytes())
        with files.open_output_stream(f"{own}.docs") as f, pa.ipc.new_file(f, pa.schema([("doc_id", ids[0].type)])) as w:
            for column in ids:
                w.write_batch(pa.record_batch([column], names=["doc_id"]))
        for kind in ("idx", "docs", "bin"):
            files.move(f"{own}.{kind}", f"{name}.{kind}")
        del ends, ids
        release_memory()
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [f"part-{part:05d}"], "docs": [len(offsets) - 1], "tokens": [total], "dtype": [enc.dtype.str]})

    # ranges by doc_id and the first characters, so that one doc_id (or null) may have many rows; the driver samples what ranges are cut by, and
    # whole texts have no bound
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.left("text", F.lit(24))).sortWithinPartitions("doc_id", "text")
    parts = sorted(ordered.mapInArrow(write, PARTS).collect(), key=lambda r: r["part"])  # one row per part
    base, listed = 0, []
    for row in parts:
        listed.append({"file": row["file"], "base": base, "docs": row["docs"], "tokens": row["tokens"], "dtype": row["dtype"]})
        base += row["tokens"]
    with system.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps({"end_id": end_id, "tokens": base, "parts": listed}).encode())
    return folder


def _ids(files, path: str, dtype: str) -> np.ndarray:
    """Memory-mapped where the store is a local or mounted folder."""
    from pyarrow import fs

    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype, mode="r")
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    system, root = _open(folder)
    with system.open_input_file(f"{root}/manifest.json") as f:
        parts = json.loads(f.read())["parts"]
    rows = [(p["file"], p["base"], p["dtype"]) for p in parts]
    listed = spark.createDataFrame(rows, "file string, base long, dtype string").repartition(max(1, len(rows)), F.col("file"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{base}/{row['file']}"
                with files.open_input_file(f"{path}.idx") as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
                ids = _ids(files, f"{path}.bin", row["dtype"])
                at = 0
                with files.open_input_file(f"{path}.docs") as f:
                    reader = pa.ipc.open_file(f)
                    for k in range(reader.num_record_batches):
                        doc_ids = reader.get_batch(k).column(0)
                        n = len(doc_ids)
                        starts, stops = offsets[at : at + n], offsets[at + 1 : at + n + 1]
                        crcs = [crc_u32(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                        at += n
                        yield pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.array(starts + row["base"]), pa.array(stops - starts), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
