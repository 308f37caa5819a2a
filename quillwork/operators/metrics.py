"""Grouped classification metrics (AGG2, AGG5, AGG9-AGG18). One aggregation each, then arithmetic on its rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import INVALID, LABELS


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def mean(parts: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, parts) / len(parts)


def summarize(df: DataFrame, group_cols: list[str], label_col: str = "true_label", pred_col: str = "normalized_label", labels: tuple[str, ...] = LABELS) -> DataFrame:
    """AGG10: rows, accuracy, macro and per-label metrics of each group."""
    t, p = F.col(label_col), F.coalesce(F.col(pred_col), F.lit(INVALID))
    aggs = [F.count("*").alias("n_rows"), F.count_if(t.eqNullSafe(p)).alias("_hit")]
    for i, label in enumerate(labels):
        aggs += [F.count_if((t == label) & (p == label)).alias(f"_tp{i}"), F.count_if(p == label).alias(f"_pp{i}"), F.count_if(t == label).alias(f"_sup{i}")]
    g = df.groupBy(*group_cols).agg(*aggs)
    col = lambda name, i: F.col(f"_{name}{i}")
    each = range(len(labels))
    precision = [ratio(col("tp", i), col("pp", i)) for i in each]
    recall = [ratio(col("tp", i), col("sup", i)) for i in each]
    f1 = [ratio(2 * col("tp", i), col("pp", i) + col("sup", i)) for i in each]
    present = reduce(lambda x, y: x + y, [F.when(col("sup", i) > 0, 1).otherwise(0) for i in each])
    out = [
        F.col("n_rows"), ratio(F.col("_hit"), F.col("n_rows")).alias("accuracy"), ratio(reduce(lambda x, y: x + y, recall), present).alias("balanced_accuracy"),
        mean(precision).alias("precision_macro"), mean(recall).alias("recall_macro"), mean(f1).alias("f1_macro"),
    ]
    for i, label in enumerate(labels):
        name = label.lower()
        out += [precision[i].alias(f"precision_{name}"), recall[i].alias(f"recall_{name}"), f1[i].alias(f"f1_{name}"), col("sup", i).alias(f"support_{name}")]
    return g.select(*group_cols, *out)


def confusion(df: DataFrame, group_col: str, label_col: str = "true_label", pred_col: str = "normalized_label", labels: tuple[str, ...] = LABELS) -> DataFrame:
    """AGG11: all (true, predicted) pairs of each group, zero cells too, from one aggregation."""
    names = [*labels, INVALID]
    t, p = F.col(label_col), F.coalesce(F.col(pred_col), F.lit(INVALID))
    cells = [(a, b, f"_c{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names)]
    g = df.groupBy(group_col).agg(*[F.count_if((t == a) & (p == b)).alias(c) for a, b, c in cells])
    rows = F.array(*[F.struct(F.lit(a).alias("true_label"), F.lit(b).alias("pred_label"), F.col(c).alias("count")) for a, b, c in cells])
    return g.select(group_col, F.inline(rows))


def class_balance(df: DataFrame, col: str) -> DataFrame:
    """AGG2: totals and shares of a 0/1 column."""
    n, one, zero = F.count("*"), F.count_if(F.col(col) == 1), F.count_if(F.col(col) == 0)
    return df.agg(n.alias("n_total"), one.alias("n_pos"), zero.alias("n_neg"), F.try_divide(one, n).alias("share_pos"), F.try_divide(zero, n).alias("share_neg"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """AGG12: n / (classes * class count)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"), F.count("*").alias("_k"))
    return counts.crossJoin(F.broadcast(total)).select(label, "n", (F.col("_total") / (F.col("_k") * F.col("n"))).alias("weight"))


def multiclass(df: DataFrame, true: str, pred: str) -> DataFrame:
    """AGG13: accuracy, balanced accuracy, support-weighted precision, recall, f1, and macro f1 over the labels seen."""
    long = df.groupBy(F.col(true).alias("_t"), F.col(pred).alias("_p")).agg(F.count("*").alias("n"))
    cells = long.select(F.inline(F.array(F.struct(F.col("_t").alias("label"), F.col("n").alias("sup"), F.lit(0).cast("long").alias("pp"), F.when(F.col("_t") == F.col("_p"), F.col("n")).otherwise(0).alias("tp")), F.struct(F.col("_p").alias("label"), F.lit(0).cast("long").alias("sup"), F.col("n").alias("pp"), F.lit(0).cast("long").alias("tp")))))
    per = cells.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("sup", "pp", "tp")])
    p, r, f = ratio(F.col("tp"), F.col("pp")), ratio(F.col("tp"), F.col("sup")), ratio(2 * F.col("tp"), F.col("pp") + F.col("sup"))
    weighted = lambda x: F.sum(F.col("sup") * x) / F.sum("sup")
    return per.agg((F.sum("tp") / F.sum("sup")).alias("accuracy"), F.avg(F.when(F.col("sup") > 0, r)).alias("balanced_accuracy"), weighted(p).alias("precision_weighted"), weighted(r).alias("recall_weighted"), weighted(f).alias("f1_weighted"), F.avg(f).alias("f1_macro"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """AGG14: area under precision-recall steps; equal scores are one step. Scores are aggregated first, so the ordered pass runs over distinct ones,
    in two levels: buckets of scores carry the totals of those above them."""
    steps = df.groupBy(F.col(score).alias("_s")).agg(F.count_if(F.col(label) == 1).alias("tp"), F.count("*").alias("n"))
    steps = steps.withColumn("_b", F.floor(F.col("_s") * 1000))
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    totals = steps.groupBy("_b").agg(F.sum("tp").alias("_tp"), F.sum("n").alias("_n"))
    bases = totals.select("_b", F.coalesce(F.sum("_tp").over(above), F.lit(0)).alias("_tp0"), F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n0"))
    inside = Window.partitionBy("_b").orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, 0)
    run = steps.join(bases, "_b").select("tp", (F.col("_tp0") + F.sum("tp").over(inside)).alias("_tp"), (F.col("_n0") + F.sum("n").over(inside)).alias("_n"))
    return run.agg(F.try_divide(F.sum(F.col("tp") * F.col("_tp") / F.col("_n")), F.sum("tp")).alias("average_precision"))


def softmax(logits: Column) -> Column:
    """AGG14: exp(x - max) / sum."""
    top = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(top, lambda x: x / F.aggregate(top, F.lit(0.0), lambda a, b: a + b))


def argmax(logits: Column) -> Column:
    """AGG15: place of the first maximum, from 0."""
    return F.array_position(logits, F.array_max(logits)) - 1


def accuracy(df: DataFrame, true: str, pred: str) -> DataFrame:
    """AGG16, AGG17: rows, exact matches, their share."""
    hit = F.count_if(F.col(true).eqNullSafe(F.col(pred)))
    return df.agg(F.count("*").alias("n_rows"), hit.alias("n_correct"), F.try_divide(hit, F.count("*")).alias("accuracy"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG9: Pearson correlation of each pair (pairwise complete), one scan."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return row.select(F.inline(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}|{b}`").alias("corr")) for a, b in pairs])))


def review_size(df: DataFrame, label: str, most: int = 25, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """AGG18: the smallest of a constant and the class counts."""
    return df.agg(F.least(F.lit(most).cast("long"), *[F.count_if(F.col(label) == x) for x in labels]).alias("sample_size"))
