"""Scratch tables in the folder that driver and executors share, and what is built on them."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where it is unset (tests, local runs) a new one is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        found = "file://" + tempfile.mkdtemp(prefix="quillwork-")
        spark.sparkContext.setCheckpointDir(found)
        return found
    return found


#: For each scope that is open in this thread, the tables written in it; queries of other threads have scopes of their own.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def scratch(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in the shared folder; keep: it outlives the innermost scope."""
    path = f"{shared_dir(spark).rstrip('/')}/quillwork/{name}-{uuid.uuid4().hex}"
    scopes = _scopes.get()
    if len(scopes) > keep:
        scopes[-1 - keep].append(path)
    return path


def release_shuffles(spark: SparkSession) -> None:
    """Spark removes the shuffle files of a finished query only when the driver's garbage collector meets its plan, which may be long after. Where much
    has been shuffled and written since, this has it collected now. Files of plans that are still held stay."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Removes the tables written inside at the end, but for those that were written with keep. What leaves the scope must not read them."""
    mine: list[str] = []
    token = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in mine:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        release_shuffles(spark)


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Writes df to the shared folder and reads it again, which cuts its lineage; survives lost executors."""
    path = scratch(df.sparkSession, name, keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], name: str) -> str:
    """name, or name with underscores behind it, whichever no column of the table bears (Spark compares names without case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def ordered_positions(df: DataFrame, *keys: Column | str, name: str = "ordered", position: str = "position") -> DataFrame:
    """Adds `position`, from 0 in the order of keys (nulls first), without gathering the rows: a range sort is written once,
    then the counts of its partitions (one small row each) become prefix sums, which are joined back by partition. Rows with equal keys get some
    order of their own. A column of that name is replaced."""
    df = df.drop(position)
    at, part, base = (free_name([*df.columns, position], n) for n in ("_at", "_part", "_base"))
    tagged = materialise(df.orderBy(*keys).withColumn(at, F.monotonically_increasing_id()), name)
    tagged = tagged.withColumn(part, F.shiftright(at, 33).cast("int"))
    rows, total = [], 0
    for row in tagged.groupBy(part).count().orderBy(part).collect():  # one row per partition
        rows.append((row[part], total))
        total += row["count"]
    bases = df.sparkSession.createDataFrame(rows, f"`{part}` int, `{base}` long")
    inside = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition of the sort
    return tagged.join(F.broadcast(bases), part).withColumn(position, F.col(base) + inside).drop(at, part, base)
