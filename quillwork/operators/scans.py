"""Work along an order without a window: a key's rows may fill many tasks.

`neighbours` range-sorts by key and order, shifts values inside partitions by array operations, and carries them over partition edges: two rows a
partition reach the driver. `first_n` keeps the first n rows of each key while rows stream through, in as many rounds as bound what one task meets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import free_name, materialise


def quoted(name: str) -> str:
    """A column's name as a reference, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def changes(columns: list[pa.Array | pa.ChunkedArray]) -> np.ndarray:
    """Where rows differ from the row before in any of some columns (nulls are equal); true for the first row."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    if n:
        out[0] = True
        for c in columns:
            c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
            code = c.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False) if not pa.types.is_nested(c.type) else np.unique(np.array(c.to_pylist(), dtype=object).astype(str), return_inverse=True)[1]
            out[1:] |= code[1:] != code[:-1]
    return out


def neighbours(df: DataFrame, keys: list[str], order: list[str], before: dict[str, str] | None = None, after: dict[str, str] | None = None) -> DataFrame:
    """WIN2-WIN6: df with, for each name in before (after), the value that the column given for it has in the row before (after) of the same key, in
    ascending order, nulls first; null where there is none. order must make the order within a key total. A key may be null."""
    before, after = before or {}, after or {}
    part, edge = free_name(df.columns, "_part"), free_name(df.columns, "_edge")
    added = {**before, **after}
    names = df.columns
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, df.schema[c].dataType) for n, c in added.items()], T.StructField(part, T.IntegerType()), T.StructField(edge, T.IntegerType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, first = TaskContext.get().partitionId(), True
        last: pa.Table | None = None  # the row in front of `held`
        held: pa.Table | None = None  # the last row so far, whose next one is not known yet

        def out(rows: pa.Table, a: int, b: int, begins: bool, ends: bool) -> Iterator[pa.RecordBatch]:
            """Rows a to b of rows, whose neighbours are in rows too."""
            new = changes([rows.column(k) for k in keys])
            columns = {n: rows.column(n) for n in names}
            for n, c in before.items():
                at = np.where(new, -1, np.arange(len(rows)) - 1)
                columns[n] = rows.column(c).take(pc.if_else(pa.array(at >= 0), pa.array(at), pa.scalar(None, pa.int64())))
            next_new = np.append(new[1:], True)
            for n, c in after.items():
                at = np.where(next_new, -1, np.arange(len(rows)) + 1)
                columns[n] = rows.column(c).take(pc.if_else(pa.array(at >= 0), pa.array(at), pa.scalar(None, pa.int64())))
            mark = np.zeros(len(rows), np.int32)
            mark[a] += int(begins)
            mark[b - 1] += 2 * int(ends)
            columns[part], columns[edge] = pa.array(np.full(len(rows), number, np.int32)), pa.array(mark)
            yield from pa.table(columns).slice(a, b - a).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            known = [t for t in (last, held) if t is not None]
            rows = pa.concat_tables([*known, rows])
            a, n = len(known) - (held is not None), len(rows)
            if n - 1 > a:
                yield from out(rows, a, n - 1, first, False)
                first = False
            last, held = (rows.slice(n - 2, 1) if n > 1 else None), rows.slice(n - 1, 1)
        if held is not None:
            rows = held if last is None else pa.concat_tables([last, held])
            yield from out(rows, len(rows) - 1, len(rows), first, True)

    ranged = df.repartitionByRange(*map(quoted, [*keys, *order])).sortWithinPartitions(*map(quoted, [*keys, *order]))
    done = materialise(ranged.mapInArrow(scan, schema), "neighbours")
    needed = list(dict.fromkeys([*keys, *before.values(), *after.values()]))
    rows = sorted(done.where(F.col(edge) > 0).select(part, edge, *map(quoted, needed)).collect(), key=lambda r: (r[part], r[edge]))  # two rows a partition at most
    firsts, lasts = {r[part]: r for r in rows if r[edge] & 1}, {r[part]: r for r in rows if r[edge] & 2}
    order_ = sorted(firsts)
    same = lambda x, y: all(x[k] == y[k] for k in keys)
    carried = []
    for i, p in enumerate(order_):
        front = lasts[order_[i - 1]] if i and same(lasts[order_[i - 1]], firsts[p]) else None
        behind = firsts[order_[i + 1]] if i + 1 < len(order_) and same(lasts[p], firsts[order_[i + 1]]) else None
        carried.append((p, *[front[c] if front else None for c in before.values()], *[behind[c] if behind else None for c in after.values()]))
    carry = "_carry"
    fields = [T.StructField("_of", T.IntegerType()), *[T.StructField(f"_{i}", df.schema[c].dataType) for i, c in enumerate(added.values())]]
    edges = df.sparkSession.createDataFrame(carried, T.StructType(fields)).select(F.col("_of").alias(part), F.struct(*[f"_{i}" for i in range(len(added))]).alias(carry))
    joined = done.join(F.broadcast(edges), part, "left")  # one row a partition

    def filled(i: int, name: str) -> Column:
        bit = 1 if i < len(before) else 2
        return F.when(F.col(edge).bitwiseAND(F.lit(bit)) > 0, F.col(f"{carry}._{i}")).otherwise(F.col(name)).alias(name)

    return joined.select(*map(quoted, df.columns), *[filled(i, n) for i, n in enumerate(added)])


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """WIN4: df with the sum of value (whole numbers, nulls count 0) over the rows of the same key up to each row, in ascending order, nulls first. Sums
    inside partitions, and what a key brings along from the partitions before: two rows a partition reach the driver."""
    part, edge, head = (free_name([*df.columns, name], n) for n in ("_part", "_edge", "_head"))
    names = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType()), T.StructField(part, T.IntegerType()), T.StructField(edge, T.IntegerType()), T.StructField(head, T.BooleanType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, total, in_head, first = TaskContext.get().partitionId(), 0, True, True
        last: pa.Table | None = None
        waiting: pa.Table | None = None  # so that the last batch is known as such

        def marked(rows: pa.Table, begins: bool, ends: bool) -> Iterator[pa.RecordBatch]:
            mark = np.zeros(len(rows), np.int32)
            mark[0] += int(begins)
            mark[-1] += 2 * int(ends)
            yield from rows.append_column(edge, pa.array(mark)).select([*names, name, part, edge, head]).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            n = len(rows)
            key = [pa.concat_tables([last, rows]).column(k) if last is not None else rows.column(k) for k in keys]
            new = changes(key)[-n:].copy()
            new[0] &= last is not None
            amount = pc.fill_null(rows.column(value).cast(pa.int64()), 0).to_numpy()
            run = np.cumsum(amount)
            starts = np.flatnonzero(new)
            base = np.concatenate([[-total], (run - amount)[starts]])[np.cumsum(new)]
            sums = run - base
            heads = np.cumsum(new) == 0 if in_head else np.zeros(n, bool)
            total, in_head, last = int(sums[-1]), bool(heads[-1]), rows.slice(n - 1)
            if waiting is not None:
                yield from marked(waiting, first, False)
                first = False
            waiting = rows.append_column(name, pa.array(sums, pa.int64())).append_column(part, pa.array(np.full(n, number, np.int32))).append_column(head, pa.array(heads))
        if waiting is not None:
            yield from marked(waiting, first, True)

    ranged = df.repartitionByRange(*map(quoted, [*keys, *order])).sortWithinPartitions(*map(quoted, [*keys, *order]))
    done = materialise(ranged.mapInArrow(scan, schema), "running-sums")
    rows = sorted(done.where(F.col(edge) > 0).select(part, edge, head, name, *map(quoted, keys)).collect(), key=lambda r: (r[part], r[edge]))  # two rows a partition at most
    firsts, lasts = {r[part]: r for r in rows if r[edge] & 1}, {r[part]: r for r in rows if r[edge] & 2}
    brought, before = [], None
    for p in sorted(firsts):
        along = 0
        if before is not None and all(lasts[before][k] == firsts[p][k] for k in keys):
            along = lasts[before][name] + (brought[-1][1] if lasts[before][head] else 0)
        brought.append((p, along))
        before = p
    carry = df.sparkSession.createDataFrame(brought, f"`{part}` int, _along long")
    summed = F.col(name) + F.when(F.col(head), F.coalesce("_along", F.lit(0))).otherwise(F.lit(0))
    return done.join(F.broadcast(carry), part, "left").select(*map(quoted, names), summed.alias(name))  # one row a partition


def first_n(df: DataFrame, keys: list[str], order: list[str], n: int, salts: int = 64) -> DataFrame:
    """SMP1, SMP2: the first n rows of each key in ascending order, nulls first. Each task sends n rows of a key at most; these meet in `salts` groups,
    which send n rows each again, so that of a key no task meets more than n rows for every salts-th task, and the last one salts * n."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        waiting, size, limit = [], 0, 50_000

        def cut() -> pa.Table:
            rows = pa.concat_tables([*([held] if held is not None else []), pa.Table.from_batches(waiting)])
            rows = rows.take(pc.sort_indices(rows, sort_keys=[(k, "ascending") for k in [*keys, *order]], null_placement="at_start"))
            start = np.flatnonzero(changes([rows.column(k) for k in keys]))
            inside = np.arange(len(rows)) - np.repeat(start, np.diff(start, append=len(rows)))
            return rows.filter(pa.array(inside < n))

        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= limit:
                held = cut()
                waiting, size, limit = [], 0, max(50_000, len(held))
        if size:
            held = cut()
        if held is not None:
            yield from held.combine_chunks().to_batches()

    salt = free_name(df.columns, "_salt")
    few = df.mapInArrow(keep, df.schema).withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(salts)))
    fewer = few.repartition(*map(quoted, [*keys, salt])).drop(salt).mapInArrow(keep, df.schema)
    return fewer.repartition(*map(quoted, keys)).mapInArrow(keep, df.schema)
