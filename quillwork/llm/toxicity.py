"""Operator 5: toxicity through a noisy channel.

A writer may hide a word by look-alike characters, masks, spacing its letters or repeating them. What is not plainly a word is decoded: each character
becomes a column of a lattice (the letters it may stand for, nothing for separators and repeats, any letter for a mask of one or two signs between letters, the end of a word for white
space and punctuation, each with a channel cost), and Viterbi finds the words that are likeliest under a character trigram model, counted over all
documents. Decoded are: chunks (between white space) with a letter and anything but letters, or a letter three times in a row; letters spaced one by one, by any white
space, however many; and neighbouring chunks of letters mixed with look-alikes, together. Accents are folded for the model and its words. A doubled letter gives a word its
squeezed form besides. There is no limit of length: Viterbi takes linear time. Not decoded: numbers without letters, and scripts other than Latin, which are
read as they are. Texts are then scored as restored: a logistic regression over words and word beginnings that are present. Chosen are those that
speak for toxicity (log-odds over 0.7); the absence of all of them is what speaks against it.

Labels are used from rows whose crc32(doc_id) mod 5 is not 0 only, at most `train_rows` of them, those with the smallest hash of doc_id. A score
depends on the text alone.

Edge cases: null and empty texts get the score of a text without telling words; without labels, or with one class only, all scores are the rate
of toxic rows (0 without labels); repeated rows score alike; null doc_ids count as held out; a `toxicity` column of docs is replaced."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, Cache, as_bytes, one_text_each, release_memory, smallest_draws
from .linear import Rows, fit, platt, sigmoid

#: What a character may stand for besides itself (fixed values).
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "µ": "u", "§": "s"}
#: Characters that may stand for nothing between letters, for any letter, and for the end of a word.
SEPARATORS = " |.-_*~'`^,:;/\\#%&\"\u2019\u00b7"
MASKED = re.compile(r"(?<=[a-z])[*#?%]{1,2}(?=[a-z])")
BREAKS = " .-_,:;/\\!?()[]{}\"|&+=<>"
#: Letters that have no accent to fold (fixed values).
FOLDS = str.maketrans({"ß": "ss", "ø": "o", "æ": "ae", "œ": "oe", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i"})
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SIZE = len(LETTERS) + 1  # 0 is the edge of a word
COST_SELF, COST_LOOK, COST_SKIP, COST_REPEAT, COST_DOUBLE, COST_MASK, COST_BREAK, COST_ODD = 0.05, 0.4, 0.1, 0.2, 1.5, 1.0, 1.0, 3.0
BREAK = -1
EDGES = b".,;:!?\"'()[]{}*#%&$<>|~`^-_=+/\\"
_UNIT = rb"(?:[A-Za-z0-9@$!|*]|\xc3[\x80-\xbf])"
_GAP = rb"(?:[\x20\x09-\x0D]|\xc2\xa0)+"
SPACED = re.compile(rb"(?<![A-Za-z0-9@$\x80-\xff])(?:" + _UNIT + _GAP + rb"){3,}" + _UNIT + rb"(?![A-Za-z0-9@$\xc3-\xff])")
_MIXED = rb"(?=[A-Za-z0-9@$|*]*[A-Za-z])[A-Za-z]*[0-9@$|*][A-Za-z0-9@$|*]*"
BROKEN = re.compile(rb"(?<![^\s])" + _MIXED + rb"(?:[ \t]" + _MIXED + rb")+(?![A-Za-z0-9@$|*])")
_NEAR = re.compile(rb"[0-9@$|*][A-Za-z0-9@$|*]*[ \t][A-Za-z]*[0-9@$|*]")  # without it a text has no BROKEN
#: Chunks that need no decoding, once their edges are off: words, with one hyphen or apostrophe at most. _TRIPLE: a letter three times in a row.
PLAIN = re.compile(r"[^\W\d_]+(?:['\u2019-][^\W\d_]{2,})?")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_RUNS = re.compile(r"(.)\1{3,}", re.S)
_PAIR = re.compile(rb"([a-z])\1")
_PAIRS = re.compile(rb"([a-z])\1+")
#: Edges that may be letters.
_STARTS, _ENDS = (b"$", b"|", b"(", b"<"), (b"$", b"|")
_DOUBLES = re.compile(r"(.)\1+")
_LETTER = re.compile(r"[^\W\d_]")


def fold(word: str) -> str:
    """Lower case without accents."""
    if word.isascii():
        return word.lower()
    low = unicodedata.normalize("NFD", word.lower().translate(FOLDS))
    return "".join(c for c in low if not unicodedata.combining(c))


@dataclass(frozen=True)
class Settings:
    train_rows: int = 8000
    features: int = 4096
    support: int = 4
    prefixes: tuple[int, ...] = (4, 5, 6)
    seed: int = 5


@dataclass
class Model:
    """trigrams: counts of letter triples over the corpus; weights by feature (w and a word, p and the beginning of one)."""

    trigrams: np.ndarray
    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = -20.0
    slope: float = 1.0
    shift: float = 0.0


def letter_trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of letter triples in the plain words of all documents; what is gathered is one count for each triple that occurs."""
    codes = np.zeros(256, np.int64)
    for i, c in enumerate(LETTERS.encode()):
        codes[c] = i + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        strip = bytes(range(33)) + b"\x7f" + EDGES

        def add(words: Counter[bytes]) -> None:
            stripped = ((w.strip(strip), n) for w, n in words.items())
            folded = ((w if w.isascii() else fold(w.decode(errors="ignore")).encode(), n) for w, n in stripped)
            plain = [(w, n) for w, n in folded if w.isascii() and w.isalpha()]
            if not plain:
                return
            lengths = np.fromiter((len(w) + 3 for w, _ in plain), np.int64)
            letters = codes[np.frombuffer(b"".join(b"  " + w + b" " for w, _ in plain), np.uint8)]
            weight = np.repeat(np.fromiter((n for _, n in plain), np.int64), lengths)
            last = np.zeros(len(letters), bool)
            ends = np.cumsum(lengths)
            last[ends - 1] = True
            last[ends - 2] = True
            at = np.flatnonzero(~last[: len(letters) - 2])
            keys = (letters[at] * SIZE + letters[at + 1]) * SIZE + letters[at + 2]
            np.add(total, np.bincount(keys, weight[at], SIZE**3).astype(np.int64), out=total)

        words: Counter[bytes] = Counter()
        for batch in batches:
            for text in as_bytes(batch.column("text")):
                if text:
                    words.update(text.translate(LOWER_BYTES).split())
                if len(words) > 60_000:  # bounds what a task holds
                    add(words)
                    words = Counter()
        add(words)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["triple", "n"])
        release_memory()

    rows = docs.select("text").mapInArrow(count, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SIZE**3)
    out[rows.column("triple").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(SIZE, SIZE, SIZE)


class Channel:
    """Viterbi over character lattices under an interpolated trigram model."""

    def __init__(self, trigrams: np.ndarray):
        one = trigrams.sum((0, 1)) + 1.0
        two = trigrams.sum(0) + 0.1
        p1 = one / one.sum()
        p2 = two / two.sum(1, keepdims=True)
        seen = trigrams.sum(2, keepdims=True)
        p3 = np.divide(trigrams, seen, out=np.zeros_like(trigrams), where=seen > 0)
        trust = seen / (seen + 10.0)
        cost = -np.log(trust * 0.9 * p3 + (1 - trust * 0.9) * (0.9 * p2[None] + 0.1 * p1[None, None]))
        self.cost: list[float] = cost.ravel().tolist()  # of a letter behind two others

    def columns(self, seen: str) -> list[list[tuple[int, float]]]:
        """For each character the letters that it may stand for (0: nothing, BREAK: the end of a word) and their costs."""
        out: list[list[tuple[int, float]]] = []
        masks = {i for m in MASKED.finditer(seen) for i in range(*m.span())}
        for i, c in enumerate(seen):
            options: list[tuple[int, float]] = []
            repeated = i > 0 and seen[i - 1] == c
            if c.isspace():
                c = " "
            if "a" <= c <= "z":
                options.append((ord(c) - 96, COST_DOUBLE if repeated else COST_SELF))
                if repeated:
                    options.append((0, COST_REPEAT))
            else:
                options += [(ord(x) - 96, COST_LOOK) for x in LOOKALIKES.get(c, "")]
                if i in masks:
                    options += [(x, COST_MASK) for x in range(1, SIZE)]
                if c in SEPARATORS or repeated:
                    options.append((0, COST_SKIP))
                if c in BREAKS:
                    options.append((BREAK, COST_BREAK))
                if not options:
                    options.append((0, COST_ODD))
            out.append(options)
        return out

    def decode(self, seen: str) -> list[str]:
        """The likeliest words behind `seen` (folded)."""
        cost_of = self.cost
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}  # the last two letters -> cost, path
        for options in self.columns(seen):
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (cost, path) in states.items():
                for letter, channel in options:
                    if letter > 0:
                        key, new, way = state % SIZE * SIZE + letter, cost + channel + cost_of[state * SIZE + letter], (letter, path)
                    elif letter == 0:
                        key, new, way = state, cost + channel, path
                    elif state:
                        key, new, way = 0, cost + channel + cost_of[state * SIZE], (0, path)
                    else:  # no word has begun
                        key, new, way = 0, cost + channel, path
                    held = after.get(key)
                    if held is None or new < held[0]:
                        after[key] = (new, way)
            states = after
        best = min(states.items(), key=lambda x: (x[1][0] + (cost_of[x[0] * SIZE] if x[0] else 0.0), x[0]))[1][1]
        letters = []
        while best is not None:
            letters.append(chr(best[0] + 96) if best[0] else " ")
            best = best[1]
        return "".join(reversed(letters)).split()


class Reader:
    """The features of texts, in one process: each distinct chunk is restored once."""

    def __init__(self, trigrams: np.ndarray, settings: Settings, keep: dict[bytes, float] | None = None):
        self.channel, self.settings, self.keep = Channel(trigrams), settings, keep
        self.chunks = Cache(self._chunk, 400_000)
        self.runs = Cache(self._run, 10_000)
        self.least = min(settings.prefixes)

    def _names(self, word: bytes) -> list[bytes]:
        """The features of a word: itself and its beginnings."""
        if len(word) <= self.least:
            return [b"w" + word]
        if word.isascii():
            return [b"w" + word, *[b"p" + word[:n] for n in self.settings.prefixes if len(word) > n]]
        text = word.decode()
        return [b"w" + word, *[b"p" + text[:n].encode() for n in self.settings.prefixes if len(text) > n]]

    def _words(self, words: Iterable[bytes]) -> tuple[bytes, ...]:
        found = [name for word in words if word for name in self._names(word)]
        if self.keep is not None:
            keep = self.keep
            found = [name for name in found if name in keep]
        return tuple(sorted(set(found))) if found else ()

    def _restored(self, seen: str) -> list[str]:
        return self.channel.decode(_RUNS.sub(r"\1\1\1", fold(seen)))

    def _run(self, run: bytes) -> tuple[bytes, ...]:
        return self._words(w.encode() for w in self._restored(run.decode(errors="ignore")))

    def _chunk(self, chunk: bytes) -> tuple[bytes, ...]:
        low = chunk.translate(LOWER_BYTES)
        core = low.strip(EDGES)
        words = {core}
        if core.isalpha():  # ASCII letters only: these are bytes
            plain = True
            if _PAIR.search(core):
                words.add(_PAIRS.sub(rb"\1", core))
                plain = not _TRIPLE.search(core.decode())
        else:
            text = core.decode(errors="ignore").lower()
            forms = {text, fold(text)}
            words = {w.encode() for w in forms | {_DOUBLES.sub(r"\1", w) for w in forms}}
            plain = (PLAIN.fullmatch(text) and not _TRIPLE.search(text)) or not _LETTER.search(text)
        hidden = len(low) > len(core) and (low[-1:] in _ENDS or low[:1] in _STARTS) and _LETTER.search(low.decode(errors="ignore"))
        if not plain:
            words.update(w.encode() for w in self._restored(core.decode(errors="ignore")))
        if hidden:  # what the edges may hide, as in a$$
            words.update(w.encode() for w in self._restored(low.decode(errors="ignore")))
        return self._words(words)

    def features(self, text: bytes | None) -> set[bytes]:
        found: set[bytes] = set()
        if not text:
            return found
        for hit in set(map(self.chunks.__getitem__, text.split())):
            found.update(hit)
        for run in SPACED.finditer(text):
            found.update(self.runs[run.group()])
        if _NEAR.search(text):
            for run in BROKEN.finditer(text):
                found.update(self.runs[run.group()])
        return found


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    trigrams = letter_trigrams(docs)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    chosen = smallest_draws(usable, F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id", settings.train_rows)
    # at most train_rows rows are broadcast, and one row for each is learnt from
    rows = one_text_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = Reader(trigrams, settings), (Counter(), Counter())
        docs_of = [0, 0]
        for batch in batches:
            for text, y in zip(as_bytes(batch.column("text")), batch.column("_toxic").to_pylist(), strict=True):
                seen[y].update(reader.features(text))
                docs_of[y] += 1
        keys = sorted(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_pydict({"feature": pa.array([b""], pa.binary()), "total": [True], "neg": [docs_of[0]], "pos": [docs_of[1]]})
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(np.zeros(len(keys), bool)), pa.array([seen[0][k] for k in keys], pa.int64()), pa.array([seen[1][k] for k in keys], pa.int64())], names=["feature", "total", "neg", "pos"])

    counts = rows.mapInArrow(count, "feature binary, total boolean, neg long, pos long").groupBy("feature", "total").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    counts = counts.where(F.col("total") | (F.col("neg") + F.col("pos") >= settings.support))
    # the gain of knowing a feature, from its counts alone: docs are few, so the class sizes can follow
    ratio = F.abs(F.log((F.col("pos") + 0.1) / (F.col("neg") + F.col("pos") + 0.2)))
    rank = F.when(F.col("total"), F.lit(1e18)).otherwise((F.col("pos") + 0.0) / F.greatest(F.lit(0.05), ratio))
    top = counts.orderBy(rank.desc(), "feature").limit(settings.features + 1).collect()  # bounded by `features`
    neg = next((r["neg"] for r in top if r["total"]), 0)
    pos = next((r["pos"] for r in top if r["total"]), 0)
    if not pos or not neg:
        return Model(trigrams, {}, (-20.0 if not pos else 20.0))
    odds = {bytes(r["feature"]): math.log((r["pos"] + 0.1) / (pos + 0.2)) - math.log((r["neg"] + 0.1) / (neg + 0.2)) for r in top if not r["total"]}
    chosen_features = {k: v for k, v in odds.items() if v > 0.7}
    columns = {f: i for i, f in enumerate(sorted(chosen_features))}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(trigrams, settings, chosen_features)
        for batch in batches:
            found = [np.array(sorted(columns[f] for f in reader.features(t)), "<u2").tobytes() for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_toxic"), pa.array(found, pa.binary())], names=["doc_id", "toxic", "found"])

    got = rows.mapInArrow(present, "doc_id long, toxic int, found binary").toArrow()  # bounded by train_rows and features
    order = np.lexsort([got.column("doc_id").to_numpy()])
    found, y = got.column("found").to_pylist(), got.column("toxic").to_numpy().astype(float)[order]
    sparse = [(c := np.frombuffer(found[i], "<u2"), np.ones(len(c))) for i in order]
    test = np.arange(len(order)) % 4 == 3
    w, bias = fit(Rows.of([s for s, t in zip(sparse, test, strict=True) if not t]), y[~test], len(columns), l2=1e-4, steps=400)
    rest = Rows.of([s for s, t in zip(sparse, test, strict=True) if t])
    z = np.bincount(rest.row_of(), w[rest.columns], len(rest)) + bias if len(rest) else np.zeros(0)
    slope, shift = platt(z, y[test])
    return Model(trigrams, {f: float(w[i]) for f, i in columns.items()}, bias, slope, shift)


def score_toxicity(docs: DataFrame, model: Model, settings: Settings = Settings(), name: str = "toxicity") -> DataFrame:
    """docs with `toxicity` (or another name), the calibrated probability that the restored text is toxic."""
    docs = docs.drop(name)
    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = Reader(model.trigrams, settings, model.weights), model.weights
        for batch in batches:
            z = np.fromiter((model.bias + sum(weights[f] for f in sorted(reader.features(t))) for t in as_bytes(batch.column("text"))), np.float64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(model.slope * z + model.shift))], names=[*names, name])
        del reader
        release_memory()

    from pyspark.sql import types as T

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return score_toxicity(docs, train(docs, labels, settings), settings)
