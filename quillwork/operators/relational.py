"""Projection, filters, joins, sets, counts, dedup, samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import free_name, ordered_positions
from .scans import first_n


# --- projection (PRJ1-PRJ10)
def rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    """PRJ1."""
    return df.toDF(*names)


def first_columns(df: DataFrame, k: int) -> DataFrame:
    """PRJ3."""
    return df.select(*df.columns[:k])


def columns_by_prefix(df: DataFrame, prefix: str, keep: str = "id") -> DataFrame:
    """PRJ4."""
    return df.select(*[c for c in df.columns if c.startswith(prefix) or c == keep])


def row_number0(df: DataFrame, name: str, *keys: Column, partition: list[str] | None = None) -> DataFrame:
    """PRJ8, JON6: place from 0 in an explicit order, within the partition columns; without any, by a range sort and prefix sums of its counts."""
    if not partition:
        return ordered_positions(df, *keys, position=name)
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*partition).orderBy(*keys)) - 1).cast("long"))


# --- filters (FLT1-FLT16)
def min_history(df: DataFrame, key: str, more_than: int) -> DataFrame:
    """FLT2, FLT9, AGG4, WIN1: rows whose key has more than so many rows; the count stays as n_key. Keys are counted map-side and joined back (null is
    a key too), so a hot key's rows are never one window; its join partition is split by adaptive execution."""
    names = df.columns
    counts = df.groupBy(F.col(key).alias("_counted")).agg(F.count("*").alias("n_key")).where(F.col("n_key") > more_than)
    return df.drop("n_key").join(counts, F.col(key).eqNullSafe(F.col("_counted"))).select(*[n for n in names if n != "n_key"], "n_key")


def min_support(df: DataFrame, key: str, least: int) -> DataFrame:
    """FLT8, JON2: rows whose key has at least so many rows, by a semi join with the aggregated keys."""
    return df.join(df.groupBy(key).count().where(F.col("count") >= least), key, "left_semi")


def is_active(status: Column, active: tuple[str, ...]) -> Column:
    """FLT15: never null."""
    return F.coalesce(status.isin(*active), F.lit(False))


def without_last(df: DataFrame, n: int, key: Column) -> DataFrame:
    """FLT13: all but the last n rows of an explicit order."""
    last = df.orderBy(key.desc()).limit(n).select(F.min(key).alias("_cut"))
    return df.crossJoin(F.broadcast(last)).where(F.col("_cut").isNull() | (key < F.col("_cut"))).drop("_cut")


# --- joins (JON1-JON7)
def inner_on_index(left: DataFrame, right: DataFrame, on: tuple[str, ...] = ("index", "id")) -> DataFrame:
    """JON1 in its literal form; `reshape.paired_melt` gives the same without a join."""
    return left.join(right, list(on))


def cross_small(df: DataFrame, small: DataFrame) -> DataFrame:
    """JON4: rows by a fixed, short list (prompt styles)."""
    return df.crossJoin(F.broadcast(small))


def lookup(c: Column, table: dict[str, str], strict: bool = False) -> Column:
    """JON5: value by key; what is unknown stays as it is, or raises if strict."""
    found = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[c]
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no value for "), c)) if strict else c)


# --- sets (SET1-SET5, WIN8)
def union_diagonal(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET2: by name; columns that one side lacks are null there."""
    return a.unionByName(b, allowMissingColumns=True)


def keep_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """SET3, WIN8: the first row of each key in a total, ascending order, nulls first; rows are compared map-side, so each task sends one row a key."""
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*order))
    key = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    return df.groupBy(*key).agg(first.alias("_row")).select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns])


# --- counts (AGG1, AGG6)
def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def label_mapping(df: DataFrame, label: str) -> DataFrame:
    """AGG6: distinct sorted labels with ids from 0 (labels are a short list)."""
    return df.select(label).where(F.col(label).isNotNull()).distinct().withColumn("label_id", (F.dense_rank().over(Window.orderBy(label)) - 1).cast("long"))


# --- samples and splits (SMP1-SMP3, SPL1, SPL2, LKG1): order by md5(seed|key), the same in any engine and partitioning
def draw(seed: int, key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")).cast("binary"))


def sample_per_label(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """SMP1, SMP2: at most n rows of each label, the first by draw; each task sends n rows a label at most."""
    by = free_name(df.columns, "_draw")
    return first_n(df.withColumn(by, draw(seed, F.col(key))), [label], [by, key], n).drop(by)


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """SMP3."""
    return df.orderBy(draw(seed, F.col(key)), key)


def _cut(rank: Column, total: Column, cuts: tuple[float, float]) -> Column:
    a, b = (F.floor(total * c + 1e-9) for c in cuts)
    return F.when(rank <= a, "train").when(rank <= b, "validation").otherwise("test")


def stratified_split(df: DataFrame, label: str, key: str, seed: int = 42, cuts: tuple[float, float] = (0.70, 0.85)) -> DataFrame:
    """SPL1: each label cut at the same shares. Ranks are taken in 256 buckets of the draw, whose counts add up, so that a frequent label is no
    single window."""
    return _split(df, [label], label, key, seed, cuts)


def _split(df: DataFrame, group: list[str], label: str | None, key: str, seed: int, cuts: tuple[float, float]) -> DataFrame:
    d = df.withColumn("_draw", draw(seed, F.col(key))).withColumn("_bucket", F.substring("_draw", 1, 2))
    if label is None:
        d = d.withColumn("_all", F.lit(0))
        group = ["_all"]
    sizes = d.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(Window.partitionBy(*group)).alias("_total"))
    inside = Window.partitionBy(*group, "_bucket").orderBy("_draw", key)
    ranked = d.withColumn("_rank", F.row_number().over(inside)).join(bases, [*group, "_bucket"])
    return ranked.withColumn("split", _cut(F.col("_base") + F.col("_rank"), F.col("_total"), cuts)).select(*df.columns, "split")


def group_split(df: DataFrame, key: str, seed: int = 42, cuts: tuple[float, float] = (0.70, 0.85)) -> DataFrame:
    """SPL2: whole keys go to one split."""
    return df.join(_split(df.select(key).distinct(), [], None, key, seed, cuts), key)


def split_report(df: DataFrame, key: str, label: str) -> DataFrame:
    """LKG1, AGG5: rows, distinct keys and share of label 1 by split."""
    return df.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.avg(F.col(label).cast("double")).alias("share_pos"))


def leaked_keys(df: DataFrame, key: str) -> DataFrame:
    """LKG1: keys in more than one split."""
    return df.groupBy(key).agg(F.count_distinct("split").alias("n_splits")).where("n_splits > 1")


def first_ids(df: DataFrame, key: str, n: int = 15) -> DataFrame:
    """LIM2: rows of the n smallest keys."""
    return df.join(F.broadcast(df.select(key).distinct().orderBy(key).limit(n)), key, "left_semi")
