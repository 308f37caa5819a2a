"""Operator 13: language identification by a sparse multinomial logistic regression on TF-IDF character n-grams, trained with follow-the-regularised-leader
and elastic-net penalties, then calibrated by a temperature.

Features: runs of one to three characters of a text in lower case, everything but letters being one space, in 2^16 hashed columns; 1 + log of a column's
count times its inverse document frequency, scaled to length one. Document frequencies cover all rows that may be learnt from. The driver fits on a
bounded sample: `per_language` distinct rows of each of the `languages` most frequent values of lang at most, drawn by hash; a quarter of them is kept
for the temperature. Scores come in Arrow batches over whole texts.

Rows are learnt from if their doc_id is not null, crc32(doc_id as text) mod 3 is not 1, and lang and text are not null.

Edge cases: a text that is null or has no letter is `und` with score 0, as is every text where nothing can be learnt; with one language learnt every other
text is of that language, score 1; ties go to the smaller name; repeated rows are scored alike; other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory

UNKNOWN = "und"
#: An odd multiplier for each place of an n-gram, and a start for each n.
TIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
START = np.array([0x27D4EB2F, 0x165667B1, 0xD3A2646C], np.uint32)
BLOCK = 500_000


@dataclass(frozen=True)
class Settings:
    """bits: 2^bits columns. alpha, beta, l1, l2: of the learner. passes: over the sample."""

    bits: int = 16
    per_language: int = 1000
    languages: int = 500
    seed: int = 13
    alpha: float = 0.5
    beta: float = 0.1
    l1: float = 2e-3
    l2: float = 1e-3
    passes: int = 4


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # columns x languages
    bias: np.ndarray
    idf: np.ndarray
    temperature: float


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray | None:
    """Code points of the letters of a text in lower case, one 32 for what lies between and at both ends; None without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters()[codes]
    if not is_letter.any():
        return None
    codes = np.where(is_letter, codes, np.uint32(32))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of a run of others
    keep[0] = True
    codes = codes[keep]
    return np.concatenate([codes[:0] if codes[0] == 32 else np.array([32], np.uint32), codes, codes[:0] if codes[-1] == 32 else np.array([32], np.uint32)])


def _columns(codes: np.ndarray, bits: int) -> np.ndarray:
    """Columns of all n-grams that begin in codes."""
    out = []
    for n in (1, 2, 3):
        if len(codes) < n:
            break
        h = np.full(len(codes) - n + 1, START[n - 1])
        for k in range(n):
            h += codes[k : len(codes) - n + 1 + k] * TIMES[k]
            h ^= h >> np.uint32(15)
            h *= TIMES[(k + n) % 3]
        out.append((h >> np.uint32(32 - bits)).astype(np.uint16 if bits <= 16 else np.uint32))
    return np.concatenate(out)


def counts(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Columns of a text, in order, and how often each occurs; None without a letter."""
    codes = _codes(text) if text else None
    if codes is None:
        return None
    if len(codes) <= BLOCK:
        found = np.sort(_columns(codes, bits), kind="stable")
        starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        return found[starts].astype(np.int64), np.diff(starts, append=len(found))
    total = np.zeros(1 << bits, np.int64)
    for at in range(0, len(codes), BLOCK):
        total += np.bincount(_columns(codes[at : at + BLOCK + 2], bits), minlength=1 << bits)
        rest = codes[at + BLOCK : at + BLOCK + 2]  # n-grams that begin in the next block
        if len(rest):
            total -= np.bincount(_columns(rest, bits), minlength=1 << bits)
    used = np.flatnonzero(total)
    return used, total[used]


def weighted(columns: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(n)) * idf[columns]
    return (x / max(np.sqrt((x * x).sum()), 1e-12)).astype(np.float32)


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id) == 1, F.lit(False))


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    for value in batch.column("text"):
        yield value.as_py()


def document_frequencies(rows: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """For each column the number of texts that hold it, and the number of texts with a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in _texts(batch):
                found = counts(text, bits)
                if found:
                    total[found[0]] += 1
                    n += 1
        used = np.flatnonzero(total)
        release_memory()
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))], names=["column", "n"])

    # at most 2^bits + 1 rows
    got = rows.select("text").mapInArrow(count, "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).toArrow()
    columns, n = got.column("column").to_numpy(), got.column("n").to_numpy()
    total = np.zeros(1 << bits, np.int64)
    total[columns[columns >= 0]] = n[columns >= 0]
    return total, int(n[columns < 0].sum())


def sample(rows: DataFrame, settings: Settings) -> tuple[list[str], list[tuple[int, np.ndarray, np.ndarray]]]:
    """Languages in order of name, and for each row of the sample its language's number, columns and counts, in the order of the draw."""
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(settings.languages).collect()  # a row a language
    names = sorted(r["lang"] for r in sizes)
    if not names:
        return [], []
    rate = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, (1.5 * settings.per_language + 50) / r["n"]))])
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(settings.seed)), F.lit(1 << 40))
    drawn = rows.withColumn("draw", draw).where(F.col("draw") < F.try_element_at(rate, F.col("lang")) * (1 << 40))
    # a row that is repeated counts once
    drawn = drawn.groupBy("lang", "doc_id", "draw").agg(F.first("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"lang": [], "draw": [], "columns": [], "counts": []}
            for text, lang, at in zip(_texts(batch), batch.column("lang").to_pylist(), batch.column("draw").to_pylist(), strict=True):
                found = counts(text, settings.bits)
                if found:
                    for k, v in zip(out, (lang, at, found[0].astype("<u4").tobytes(), found[1].astype("<u4").tobytes()), strict=True):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("lang", pa.string()), ("draw", pa.int64()), ("columns", pa.binary()), ("counts", pa.binary())]))

    made = drawn.mapInArrow(features, "lang string, draw long, columns binary, counts binary").orderBy("draw", "lang", "columns").limit(2 * settings.per_language * len(names))
    number, kept, out = {lang: i for i, lang in enumerate(names)}, [0] * len(names), []
    for row in made.collect():  # bounded by per_language and languages
        k = number[row["lang"]]
        kept[k] += 1
        if kept[k] <= settings.per_language:
            out.append((k, np.frombuffer(row["columns"], "<u4").astype(np.int64), np.frombuffer(row["counts"], "<u4")))
    return names, out


def follow_leader(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, width: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a multinomial logistic regression over rows of (class, columns, values), by follow-the-regularised-leader: each coordinate has
    its own rate, from the squares of its gradients; l1 keeps weights at zero, l2 small. The bias is a column that every row has, without penalty."""
    z, n = np.zeros((width + 1, classes)), np.zeros((width + 1, classes))

    def leader(at: np.ndarray) -> np.ndarray:
        l1, l2 = np.where(at < width, settings.l1, 0)[:, None], np.where(at < width, settings.l2, 0)[:, None]
        w = -(z[at] - np.sign(z[at]) * l1) / ((settings.beta + np.sqrt(n[at])) / settings.alpha + l2)
        return np.where(np.abs(z[at]) > l1, w, 0)

    for _ in range(settings.passes):
        for y, columns, x in rows:
            at, values = np.append(columns, width), np.append(x, np.float32(1))
            w = leader(at)
            p = softmax(values @ w)
            p[y] -= 1
            g = values[:, None] * p
            squares = g * g
            z[at] += g - (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / settings.alpha * w
            n[at] += squares
    w = leader(np.arange(width + 1))
    return w[:-1].astype(np.float32), w[-1]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least loss over scores z of classes y, by golden section over its logarithm."""
    if len(y) < 10:
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(z / np.exp(log_t))[np.arange(len(y)), y]
        return float(-np.log(np.maximum(p, 1e-12)).mean() + 1e-4 * log_t * log_t)

    lo, hi, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """docs: doc_id, text, lang."""
    rows = docs.select("doc_id", "text", "lang").where((remainder(F.col("doc_id")) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    names, drawn = sample(rows, settings)
    width = 1 << settings.bits
    frequency, n = document_frequencies(rows, settings.bits)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    learnt = sorted({k for k, _, _ in drawn})
    names, number = [names[k] for k in learnt], {k: i for i, k in enumerate(learnt)}
    rows_ = [(number[k], c, weighted(c, m, idf)) for k, c, m in drawn]
    rest, fitted = rows_[3::4], [r for i, r in enumerate(rows_) if i % 4 != 3]
    weights, bias = follow_leader(fitted, len(names), width, settings)
    scores = np.array([x @ weights[c] + bias for _, c, x in rest]).reshape(len(rest), len(names))
    return Model(names, weights, bias, idf, fit_temperature(scores, np.array([k for k, _, _ in rest], np.int64)))


def identify(docs: DataFrame, model: Model, bits: int = Settings.bits) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of docs (doc_id, text)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], np.zeros(batch.num_rows)
            for i, text in enumerate(_texts(batch)):
                found = counts(text, bits) if model.languages else None
                if found is None:
                    names.append(UNKNOWN)
                    continue
                p = softmax((weighted(*found, model.idf) @ model.weights[found[0]] + model.bias) / model.temperature)
                names.append(model.languages[int(p.argmax())])
                scores[i] = min(1.0, float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])
        release_memory()

    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Predictions for all rows of docs (doc_id, text, lang) by a model that is trained on those that may be learnt from."""
    return identify(docs, train(docs, settings), settings.bits)
