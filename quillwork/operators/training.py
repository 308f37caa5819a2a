"""MLT1, MLT2: a text classifier trained in epochs over a distributed table, with class-weighted loss, early stopping and choice by macro F1.

Each epoch every partition takes gradient steps from the epoch's weights over its own rows, in an order drawn for the epoch; the steps are averaged by
rows, summed coordinate by coordinate in the shuffle, so that the driver gets features x classes numbers at most. After each epoch the validation rows
are scored and macro F1 is taken from their counts; training stops when it has not risen for `patience` epochs, and the best weights stay. Rows are
hashed word counts, 1 + log of each, scaled to length one. Training and validation texts are cut and counted once, before the first epoch."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialise
from .metrics import class_weights, multiclass
from .relational import stratified_split


@dataclass(frozen=True)
class Settings:
    features: int = 1 << 14
    max_words: int | None = None  # of each text; all if None
    rate: float = 3.0
    decay: float = 0.9
    l2: float = 1e-5
    batch: int = 4
    max_epochs: int = 20
    patience: int = 2
    seed: int = 42


@dataclass
class Classifier:
    labels: list[str]
    weights: np.ndarray  # (features + 1) x labels, the last row being the bias
    settings: Settings
    history: list[dict] = field(default_factory=list)
    best_epoch: int = 0


#: White space as in `text.words`: that of ASCII, and more.
_WHITE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_MORE_WHITE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: crc32 of each byte, by which the crc32 of many words is taken at once, byte by byte.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & np.uint32(1), _CRC >> np.uint32(1) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))


def crc_words(data: bytes, longest: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """zlib.crc32 of each word, a run of anything but ASCII white space, and where it begins. Words over `longest` bytes are taken one by one."""
    b = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(~_WHITE[b], prepend=False, append=False))
    starts, size = edge[::2], np.diff(edge)[::2]
    order = np.argsort(np.minimum(size, longest).astype(np.uint8), kind="stable")[::-1]  # longest first: those that have an i-th byte come first
    at, crc = starts[order], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    having = len(starts) - np.cumsum(np.bincount(np.minimum(size, longest), minlength=longest + 1))
    for i in range(longest):
        n = int(having[i])
        if not n:
            break
        crc[:n] = _CRC[(crc[:n] ^ b[at[:n] + i]) & np.uint32(255)] ^ crc[:n] >> np.uint32(8)
    out = np.empty_like(crc)
    out[order] = ~crc
    for i in np.flatnonzero(size > longest).tolist():
        out[i] = zlib.crc32(data[starts[i] : starts[i] + size[i]])
    return out, starts


def counted(texts: list[str | None], settings: Settings, group: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct columns of the words of many texts in lower case, one text after another, how often each occurs, and where texts begin (one more at the
    end). Each text, null too, ends with the column that all have, the last one, once. Some `group` bytes are counted at a time."""
    width, parts, some, held = settings.features + 1, [], [], 0
    for i, text in enumerate(texts):
        some.append(_MORE_WHITE.sub(" ", (text or "").lower()).encode())
        held += len(some[-1])
        if held >= group or i + 1 == len(texts):
            crc, at = crc_words(b"\n".join(some))
            first = np.searchsorted(at, np.cumsum([0] + [len(t) + 1 for t in some]))
            owner = np.repeat(np.arange(len(some)), np.diff(first))
            if settings.max_words:
                kept = np.arange(len(crc)) - first[owner] < settings.max_words
                crc, owner = crc[kept], owner[kept]
            key = np.concatenate([crc % np.uint32(settings.features) + owner * width, np.arange(1, len(some) + 1) * width - 1])
            key.sort()
            edge = np.flatnonzero(np.diff(key, prepend=-1))
            counts, key = np.diff(edge, append=len(key)), key[edge]
            parts.append((key % width, counts, np.diff(np.searchsorted(key, np.arange(len(some) + 1) * width))))
            some, held = [], 0
    columns, counts, sizes = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
    return columns, counts, np.append(0, np.cumsum(sizes))


def values_of(columns: np.ndarray, counts: np.ndarray, starts: np.ndarray, features: int) -> np.ndarray:
    """1 + log of each count, scaled to length one by row; the same small value in the column that all have."""
    if not len(columns):
        return np.zeros(0)
    own = columns < features
    x = np.where(own, 1 + np.log(counts), 0)
    length = np.sqrt(np.add.reduceat(x * x, starts[:-1]))
    return np.where(own, x / np.repeat(np.where(length > 0, length, 1), np.diff(starts)), 0.2)


def scored(weights: np.ndarray, columns: np.ndarray, values: np.ndarray, starts: np.ndarray, stretch: int = 1 << 8) -> np.ndarray:
    """Probabilities of the labels for each row, a stretch of rows at a time."""
    z = np.zeros((len(starts) - 1, weights.shape[1]))
    for a in range(0, len(z), stretch):
        cuts = starts[a : a + stretch + 1]
        at = slice(cuts[0], cuts[-1])
        z[a : a + stretch] = np.add.reduceat(values[at, None] * weights.take(columns[at], 0), cuts[:-1] - cuts[0])
    return softmax(z) if z.size else z


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def local_steps(weights: np.ndarray, rows: list[tuple[int, float, np.ndarray, np.ndarray]], rate: float, settings: Settings, epoch: int) -> tuple[np.ndarray, float]:
    """Weights behind one pass over rows of (label, class weight, distinct columns, values) in small batches, and the weighted loss on the way.

    w holds the weights over `scale`, so that their decay is a product of one number and a step touches only the columns of its batch. `whole` is the
    same memory, a column's weights being one item: they are taken and put back as such, which is several times as fast."""
    w, scale, loss = np.array(weights, np.float64, order="C"), 1.0, 0.0
    whole = w.view(np.dtype((np.void, w.strides[0]))).ravel()
    order = np.random.default_rng([settings.seed, epoch]).permutation(len(rows))
    rows = [rows[i] for i in order]
    columns, values = np.concatenate([r[2] for r in rows]).astype(np.intp), np.concatenate([r[3] for r in rows])[:, None]
    starts = np.cumsum([0] + [len(r[2]) for r in rows])
    labels, shares = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for at in range(0, len(rows), settings.batch):
        cuts = starts[at : at + settings.batch + 1]
        mine = slice(cuts[0], cuts[-1])
        y, share, which = labels[at : at + settings.batch], shares[at : at + settings.batch], np.arange(len(cuts) - 1)
        begin, x = cuts[:-1] - cuts[0], values[mine]
        p = softmax(np.add.reduceat(w.take(columns[mine], 0) * x, begin) * scale)
        loss -= float((share * np.log(np.maximum(p[which, y], 1e-12))).sum())
        p[which, y] -= 1
        scale *= 1 - rate * settings.l2
        by = np.repeat(p * (rate / scale / share.sum() * share)[:, None], np.diff(cuts), 0)
        by *= x
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            mine = columns[a:b]
            whole[mine] = (w.take(mine, 0) - by[a - cuts[0] : b - cuts[0]]).view(whole.dtype).ravel()
        if scale < 1e-6:
            w *= scale
            scale = 1.0
    return w * scale, loss


def _epoch(rows: DataFrame, model: Classifier, rate: float, epoch: int, stretch: int = 1 << 22) -> tuple[np.ndarray, float]:
    """stretch: how many columns of rows a task holds at a time; its steps go on from one such stretch to the next."""
    weights, settings = model.weights, model.settings

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, loss, n, mine, held = weights, 0.0, 0, [], 0

        def run() -> None:
            nonlocal w, loss, n, mine, held
            w, more = local_steps(w, mine, rate, settings, epoch)
            loss, n, mine, held = loss + more, n + len(mine), [], 0

        for b in batches:
            found = b.column("_columns")
            columns, counts = found.flatten().to_numpy(), b.column("_counts").flatten().to_numpy()
            starts = np.cumsum(np.append(0, np.diff(found.offsets.to_numpy())))
            values = values_of(columns, counts, starts, settings.features)
            for y, share, i, j in zip(b.column("_y").to_pylist(), b.column("_weight").to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                mine.append((y, share, columns[i:j], values[i:j]))
                held += j - i
                if held >= stretch:
                    run()
        if mine:
            run()
        if n:
            change = ((w - weights) * n).ravel()
            used = np.flatnonzero(change)
            at, by = np.append(used, [-1, -2]), np.append(change[used], [n, loss])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(by)], names=["at", "by"])

    # features x labels rows at most
    got = rows.mapInArrow(steps, "at long, by double").groupBy("at").agg(F.sum("by").alias("by")).toArrow()
    at, by = got.column("at").to_numpy(), got.column("by").to_numpy()
    n, loss = float(by[at == -1].sum()), float(by[at == -2].sum())
    out = weights.ravel().copy()
    out[at[at >= 0]] += by[at >= 0] / max(n, 1.0)
    return out.reshape(weights.shape), loss / max(n, 1.0)


def coded(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """df with its text as _columns and _counts (see `counted`), so that texts are cut into words once for all epochs."""
    rest = df.drop(text)
    names = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, counts, starts = counted(b.column(text).to_pylist(), settings)
            cuts = pa.array(starts, pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int32())) for x in (columns, counts)]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], *lists], names=[*names, "_columns", "_counts"])

    lists = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("_columns", "_counts")]
    return df.mapInArrow(run, T.StructType([*rest.schema.fields, *lists]))


def _labelled(model: Classifier, columns: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """The label of the largest score of each row, and that score; ties go to the smaller label."""
    labels = model.labels
    p = scored(model.weights, columns, values_of(columns, counts, starts, model.settings.features), starts)
    best = p.argmax(1) if len(labels) else []
    return [pa.array([labels[k] for k in best] if len(labels) else [None] * len(p), pa.string()), pa.array(p.max(1) if len(labels) else [None] * len(p), pa.float64())]


def predict(df: DataFrame, model: Classifier, text: str, prediction: str = "prediction", score: str = "score") -> DataFrame:
    """MLT2: df with the label of the largest score, and that score; ties go to the smaller label."""
    model = replace(model, history=[])
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _labelled(model, *counted(b.column(text).to_pylist(), model.settings))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], *found], names=[*names, prediction, score])

    schema = T.StructType([*df.schema.fields, T.StructField(prediction, T.StringType()), T.StructField(score, T.DoubleType())])
    return df.mapInArrow(run, schema)


def _predict_coded(rows: DataFrame, model: Classifier) -> DataFrame:
    """_true and _pred of coded rows."""
    model = replace(model, history=[])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, counts = b.column("_columns"), b.column("_counts")
            cuts = np.cumsum(np.append(0, np.diff(columns.offsets.to_numpy())))
            found = _labelled(model, columns.flatten().to_numpy(), counts.flatten().to_numpy(), cuts)
            yield pa.RecordBatch.from_arrays([b.column("_true"), found[0]], names=["_true", "_pred"])

    return rows.mapInArrow(run, "_true string, _pred string")


def macro_f1(df: DataFrame, true: str, pred: str) -> float:
    """AGG13's macro F1 of predicted rows; 0 without any."""
    found = multiclass(df.select(true, pred), true, pred).first()
    return float(found["f1_macro"] or 0.0)


def train_epochs(df: DataFrame, text: str, label: str, key: str, settings: Settings = Settings(), evaluate: Callable[[Classifier, int], float] | None = None) -> tuple[Classifier, DataFrame]:
    """The best classifier, and df with its split (SPL1: train, validation, test). Rows with a null label take no part. evaluate: the number to be raised,
    for a classifier after an epoch; macro F1 of the validation rows if not given."""
    split = stratified_split(df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("string")), label, key, settings.seed)
    split = materialise(split, "splits")
    weights = {r[label]: r["weight"] for r in class_weights(split.where("split = 'train'"), label).collect()}  # a row a class
    labels = sorted(weights)
    number, weight = (F.create_map(*[F.lit(x) for pair in pairs for x in pair]) for pairs in (zip(labels or [""], range(len(labels) or 1), strict=True), weights.items() or [("", 0.0)]))
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    rows = split.where("split = 'train'").select(F.col(key).alias("_id"), F.element_at(number, F.col(label)).alias("_y"), F.element_at(weight, F.col(label)).alias("_weight"), text)
    # an order drawn by keys, whatever it has to do with labels; equal keys by what they hold
    order = [F.xxhash64("_id"), "_id", "_y", F.xxhash64("_columns", "_counts")]
    rows = materialise(coded(rows, text, settings).repartition(int(parts), F.xxhash64("_id")).sortWithinPartitions(*order).drop("_id"), "train-rows")
    held = materialise(coded(split.where("split = 'validation'").select(F.col(label).alias("_true"), text), text, settings), "validation")
    model = Classifier(labels, np.zeros((settings.features + 1, len(labels))), settings)
    evaluate = evaluate or (lambda m, _: macro_f1(_predict_coded(held, m), "_true", "_pred"))
    best, kept, since = -math.inf, model.weights, 0
    for epoch in range(1, settings.max_epochs + 1 if labels else 1):
        model.weights, loss = _epoch(rows, model, settings.rate * settings.decay ** (epoch - 1), epoch)
        value = evaluate(model, epoch)
        model.history.append({"epoch": epoch, "loss": loss, "value": value})
        if value > best:
            best, kept, since, model.best_epoch = value, model.weights, 0, epoch
        else:
            since += 1
            if since >= settings.patience:
                break
    model.weights = kept
    return model, split
