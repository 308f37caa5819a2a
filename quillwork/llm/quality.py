"""Operator 7: quality rules. A logistic regression over hashed word, word-pair and character n-grams, trained on labelled quality rows,
calibrated on rows held out from training, scored in Arrow batches against a fixed threshold; counted base rules come first.

A text's features are the shares of its words, word pairs and runs of 3 and 4 bytes that fall into each hashed column, so a score is a mean of
weights over each of the three families. The training sample is at most `train_rows` labelled rows, the smallest by a hash of doc_id.

Edge cases: null and empty texts have no words, zero counts and fail the base rules; without usable labels every row that passes the base rules
is kept; repeated rows are scored alike; very long texts are read whole, line by line and word by word; other columns pass through `quality_rules`
unread."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, as_bytes, hashed_words, mix64, one_text_each, smallest_draws, windows
from .linear import Rows, fit, platt, sigmoid

SYMBOLS = b"#*$%&|<>"
FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, quality_score double, base_failed boolean, kept boolean"


@dataclass(frozen=True)
class Settings:
    train_rows: int = 4000
    bits: int = 13
    threshold: float = 0.35
    seed: int = 7


@dataclass
class Model:
    """Weights of three families of `1 << bits` columns (words, pairs, characters), the bias, and the calibration."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int

    def trained(self) -> bool:
        return bool(np.any(self.weights))


def _characters(text: bytes, bits: int) -> np.ndarray:
    """Columns of the runs of 3 and 4 bytes of a text."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    three = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    four = three[:-1] | b[3:] << np.uint32(24)
    mixed = np.concatenate([three * np.uint32(0x9E3779B1), (four ^ four >> np.uint32(15)) * np.uint32(0x85EBCA77)])
    return (mixed >> np.uint32(32 - bits)).astype(np.int64)


def _families(text: bytes, hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns, each within its family, of the words, word pairs and character runs of a text."""
    shift = np.uint64(64 - bits)
    pairs = windows(hashes, 2) if len(hashes) > 1 else hashes[:0]
    return (mix64(hashes) >> shift).astype(np.int64), (pairs >> shift).astype(np.int64), _characters(text, bits)


def _columns(text: bytes, hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of a text: counts, as shares of its family."""
    total = np.concatenate([np.bincount(c, minlength=1 << bits) / max(1, len(c)) for c in _families(text, hashes, bits)])
    used = np.flatnonzero(total)
    return used, total[used]


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    size = 3 << settings.bits
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = smallest_draws(usable, F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id", settings.train_rows)
    # at most train_rows labels, and one row for each
    rows = one_text_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "quality": [], "columns": [], "values": []}
            for doc_id, text, quality in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), batch.column("quality").to_pylist(), strict=True):
                hashes, _ = hashed_words(text)
                if not len(hashes):
                    continue
                columns, values = _columns(text, hashes, settings.bits)
                for k, v in zip(out, (doc_id, quality, columns.astype("<u2" if size <= 1 << 16 else "<u4").tobytes(), values.astype("<f4").tobytes()), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("columns", pa.binary()), ("values", pa.binary())]))

    got = rows.mapInArrow(features, "doc_id long, quality int, columns binary, values binary").toArrow()  # bounded by train_rows
    ids = got.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    y = got.column("quality").to_numpy().astype(float)[order]
    kind = "<u2" if size <= 1 << 16 else "<u4"
    parts = [(np.frombuffer(c, kind), np.frombuffer(v, "<f4")) for c, v in zip(got.column("columns").to_pylist(), got.column("values").to_pylist(), strict=True)]
    parts = [parts[i] for i in order]
    held = np.arange(len(parts)) % 4 == 3
    x = Rows.of([p for p, h in zip(parts, held, strict=True) if not h])
    if not len(x):
        return Model(np.zeros(size), 0.0, 1.0, 0.0, settings.bits)
    # columns are scaled by their root mean square, so that frequent and rare n-grams weigh alike
    scale = 1 / np.sqrt(np.bincount(x.columns, x.values**2, size) / len(x) + 1e-6)
    norm = np.sqrt(len(x.columns) / len(x))
    x.values = x.values * scale[x.columns] / norm
    w, bias = fit(x, y[~held], size, l2=2e-4, steps=250)
    w = w * scale / norm
    rest = Rows.of([p for p, h in zip(parts, held, strict=True) if h])
    z = np.bincount(rest.row_of(), w[rest.columns] * rest.values, len(rest)) + bias if len(rest) else np.zeros(0)
    slope, shift = platt(z, y[held])
    return Model(w, bias, slope, shift, settings.bits)


class Scorer:
    """Counts and scores of texts, in one process."""

    def __init__(self, model: Model, threshold: float):
        self.model, self.threshold = model, threshold
        self.families = model.weights.reshape(3, -1)

    def counts(self, text: bytes) -> tuple[int, int, int]:
        word_chars = len(text.decode()) - (len(text) - len(text.translate(None, WHITE)))
        symbols = len(text) - len(text.translate(None, SYMBOLS))
        lines = [x for x in text.split(b"\n") if x.strip()]
        return word_chars, symbols, len(lines) - len(set(lines))

    def row(self, text: bytes | None) -> tuple:
        text = text or b""
        hashes, _ = hashed_words(text)
        n, repeats = len(hashes), repeated_words(hashes)
        word_chars, symbols, lines = self.counts(text)
        failed = n < 10 or 100 * repeats > 20 * n
        score = 1.0
        if n and self.model.trained():
            z = sum(w[c].mean() for w, c in zip(self.families, _families(text, hashes, self.model.bits), strict=True) if len(c))
            score = float(sigmoid(self.model.slope * (z + self.model.bias) + self.model.shift))
        return n, word_chars, symbols, lines, repeats, score, failed, not failed and score >= self.threshold


def repeated_words(hashes: np.ndarray, width: int = 5) -> int:
    """Words that lie in a window of `width` words found twice or more in the text."""
    if len(hashes) <= width:
        return 0
    each = windows(hashes, width)
    order = np.argsort(each, kind="stable")
    run = each[order]
    same = run[1:] == run[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(each), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def quality_rules(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), model: Model | None = None) -> DataFrame:
    """doc_id and FIELDS for each row. kept: the base rules pass and the calibrated probability of quality reaches the threshold."""
    model = model or train(docs, labels, settings)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, settings.threshold)
        kinds = [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]
        names = [x.split()[0] for x in FIELDS.split(", ")]
        for batch in batches:
            rows = [scorer.row(t) for t in as_bytes(batch.column("text"))]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id long, {FIELDS}")
