"""Operator 6: lexical retrieval packing.

Documents are dealt to shards by content: each goes by its heaviest term (largest tf * idf among terms that another document has), documents of one
term lie side by side, and a term that very many documents have is salted. A shard is a run of such documents of bounded size, inside one task, with
a BM25 inverted index over its words; document frequencies and the mean length come from all documents, by one pass before. A seed document opens a
window; the index scores its unused neighbours by all words of the seed and returns them best first, which fill the window; what is cut off the last
one opens the next window as its seed. A window that finds no more neighbours takes the next unused documents in order. The open window goes on into
the task's next shard; the last one is cut into runs whose lengths are powers of two. So no sequence needs padding.

Within a shard words are told apart by 64-bit hashes. Their document frequencies are kept for hashed buckets, whose number grows with the number of
documents from 2 ** 18 to 2 ** 22, which bounds what the driver gathers and each task holds; a bucket's words share the frequency of all of them.

Edge cases: null and empty texts are the end id alone; repeated rows are packed as often as they come; a document longer than the window runs over
several; texts without white space are one word and bounded by their bytes; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, distinct, hashed_words, mix64, release_memory
from .tokens import END_ID, crc_u32, default_tokenizer, encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in PIECES.split(", ")]


@dataclass(frozen=True)
class Settings:
    window: int = 4096
    least_bits: int = 18
    most_bits: int = 22
    shard_docs: int = 2048
    shard_words: int = 600_000
    shard_bytes: int = 8_000_000
    k1: float = 1.2
    b: float = 0.75


@dataclass
class Corpus:
    """What BM25 knows of all documents. frequency: by bucket, the upper bits of a word's hash."""

    docs: int
    mean: float
    frequency: np.ndarray

    def df(self, hashes: np.ndarray) -> np.ndarray:
        bits = len(self.frequency).bit_length() - 1
        return self.frequency[(hashes >> np.uint64(64 - bits)).astype(np.int64)]

    def idf(self, hashes: np.ndarray) -> np.ndarray:
        df = self.df(hashes)
        return np.log1p((self.docs - df + 0.5) / (df + 0.5))


def hashed_texts(texts: list[bytes | None], size: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Many texts at once: the place of the first, hashes of words, and where each text's begin (one more at the end)."""
    first, group, held = 0, [], 0
    for i, text in enumerate(texts):
        group.append(text or b"")
        held += len(group[-1])
        if held >= size or i + 1 == len(texts):
            h, at = hashed_words(b"\n".join(group))
            begin = np.cumsum([0] + [len(t) + 1 for t in group])
            yield first, h, np.searchsorted(at, begin)
            first, group, held = i + 1, [], 0


def corpus_statistics(docs: DataFrame, settings: Settings = Settings()) -> Corpus:
    """Document frequencies of hashed words, counted over all documents."""
    rows = docs.count()
    bits = min(settings.most_bits, max(settings.least_bits, (2 * rows).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(1 << bits, np.int64), 0, 0
        for batch in batches:
            for _, h, cuts in hashed_texts(as_bytes(batch.column("text"))):
                n, total = n + len(cuts) - 1, total + len(h)
                owner = np.repeat(np.arange(len(cuts) - 1, dtype=np.uint64), np.diff(cuts))
                each = distinct(owner << np.uint64(bits) | h >> np.uint64(64 - bits))
                df += np.bincount((each & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], used]), pa.int32()), pa.array(np.concatenate([[n, total], df[used]]), pa.int64())], names=["term", "n"])

    got = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # at most one row per bucket
    terms, n = got.column("term").to_numpy(), got.column("n").to_numpy()
    frequency = np.zeros(1 << bits, np.int32)
    frequency[terms[terms >= 0]] = np.minimum(n[terms >= 0], 2**31 - 1)
    count_of = {int(t): int(v) for t, v in zip(terms[terms < 0], n[terms < 0], strict=True)}
    return Corpus(count_of.get(-1, 0), count_of.get(-2, 0) / max(1, count_of.get(-1, 0)), frequency)


def heaviest_words(h: np.ndarray, cuts: np.ndarray, corpus: Corpus, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The heaviest word of each text, of equal ones that of the largest hash, and whether it has one; 0 without a word."""
    n = len(cuts) - 1
    bits = np.uint64(max(1, n.bit_length()))
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(cuts))
    # words are counted by a text's number and the upper bits of their hash in one integer, which sorts several times as fast as two columns
    word = np.sort(owner << (np.uint64(64) - bits) | h >> bits)
    edge = np.flatnonzero(np.diff(word, prepend=~word[:1]))
    tf, word = np.diff(edge, append=len(word)), word[edge]
    upper = word << bits
    df = corpus.df(upper)
    weight = np.where(df > 1, tf / (tf + settings.k1) * corpus.idf(upper), 0)
    size = np.diff(np.searchsorted(word >> (np.uint64(64) - bits), np.arange(n + 1, dtype=np.uint64)))
    last, best = size > 0, np.zeros(n, np.uint64)
    if last.any():
        begin = (np.cumsum(size) - size)[last]
        top = np.repeat(np.maximum.reduceat(weight, begin), size[last])
        best[last] = np.maximum.reduceat(np.where(weight == top, upper, 0), begin)
        # the whole hashes of these words
        at = np.flatnonzero(h >> bits << bits == np.repeat(best, np.diff(cuts)))
        best[owner[at].astype(np.int64)] = h[at]
    return best, last


def dealt(docs: DataFrame, corpus: Corpus, settings: Settings) -> DataFrame:
    """doc_id, text and key: the heaviest term, salted so that no key has many more documents than a shard."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for batch in batches:
            keys = []
            for _, h, cuts in hashed_texts(as_bytes(batch.column("text"))):
                n = len(cuts) - 1
                key, last = heaviest_words(h, cuts, corpus, settings)
                many = np.where(last, corpus.df(key), corpus.docs)
                salt = (np.arange(row, row + n) % (many // settings.shard_docs + 1)).astype(np.uint64)
                keys.append(mix64(key + salt * np.uint64(0x9E3779B97F4A7C15)))
                row += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(keys).view(np.int64) if keys else [], pa.int64())], names=["doc_id", "text", "key"])

    text = docs.schema["text"].dataType.simpleString()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(deal, f"doc_id long, text {text}, key long")


class Shard:
    """The inverted index of some documents, each given by the hashes of its words."""

    def __init__(self, words: list[np.ndarray], corpus: Corpus, settings: Settings):
        self.n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, self.n)
        h = np.concatenate(words) if words else np.zeros(0, np.uint64)
        # the upper bits of a word's hash and the document in one integer; words of one shard that agree in these bits (53 and more) count as one
        bits = np.uint64(max(0, self.n - 1).bit_length())
        pair = np.sort(h >> bits << bits | np.repeat(np.arange(self.n, dtype=np.uint64), lengths))
        edge = np.flatnonzero(np.diff(pair, prepend=~pair[:1]))
        tf, pair = np.diff(edge, append=len(pair)), pair[edge]
        word, doc = pair >> bits << bits, (pair & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        edge = np.flatnonzero(np.diff(word, prepend=~word[:1]))
        size = np.diff(edge, append=len(word))
        shared = np.repeat(size > 1, size)  # a word of one document finds no neighbour
        word, size = word[edge[size > 1]], size[size > 1]
        self.doc, tf = doc[shared], tf[shared]
        self.first, self.size = np.cumsum(size) - size, size
        norm = settings.k1 * (1 - settings.b + settings.b * lengths[self.doc] / max(corpus.mean, 1e-9))
        self.weight = np.repeat(corpus.idf(word), size) * tf * (settings.k1 + 1) / (tf + norm)
        of_doc = np.sort(self.doc << 32 | np.repeat(np.arange(len(size)), size))
        self.of_doc = of_doc & ((1 << 32) - 1)
        self.starts = np.searchsorted(of_doc >> 32, np.arange(self.n + 1))

    def neighbours(self, doc: int) -> np.ndarray:
        """Documents of the shard by falling BM25 score for the words of doc; those without a common word are left out."""
        mine = self.of_doc[self.starts[doc] : self.starts[doc + 1]]
        if not len(mine):
            return mine
        size = self.size[mine]
        at = np.repeat(self.first[mine] - np.cumsum(size) + size, size) + np.arange(size.sum())
        score = np.bincount(self.doc.take(at), self.weight.take(at), self.n)
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


class Packer:
    """Fills windows from one shard after another."""

    def __init__(self, corpus: Corpus, settings: Settings, first_sequence: int = 0):
        self.corpus, self.settings, self.sequence = corpus, settings, first_sequence
        self.window: list[tuple] = []  # (doc_id, start, ids of the piece, doc_tokens)
        self.room = settings.window
        self.out: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            self.out.append((doc_id, start, len(ids), crc_u32(ids), tokens, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def _put(self, doc_id, ids: np.ndarray, start: int) -> int:
        """Puts what has room; returns where the rest starts."""
        take = min(self.room, len(ids) - start)
        self.window.append((doc_id, start, ids[start : start + take], len(ids)))
        self.room -= take
        if not self.room:
            self._emit(self.window)
            self.window, self.room = [], self.settings.window
        return start + take

    def shard(self, docs: list[tuple]) -> None:
        """docs: (doc_id, ids, hashes of words)."""
        index = Shard([d[2] for d in docs], self.corpus, self.settings)
        used, at = np.zeros(len(docs), bool), 0
        ranked: Iterator[int] = iter(())
        while True:
            doc = next((d for d in ranked if not used[d]), None)
            is_seed = doc is None
            if is_seed:
                while at < len(docs) and used[at]:
                    at += 1
                if at == len(docs):
                    return
                doc = at
            used[doc] = True
            doc_id, ids, _ = docs[doc]
            start, windows = 0, self.sequence
            while start < len(ids):
                start = self._put(doc_id, ids, start)
            # a document whose rest opens a window is the seed of that window
            if is_seed or windows != self.sequence:
                ranked = iter(index.neighbours(doc).tolist() if self.window else ())

    def flush(self) -> None:
        """Ends the open window as runs of power-of-two lengths, longest first."""
        left, pieces = self.settings.window - self.room, list(self.window)
        for bit in reversed(range(left.bit_length())):
            if not left >> bit & 1:
                continue
            need, run = 1 << bit, []
            while need:
                doc_id, start, ids, tokens = pieces[0]
                take = min(need, len(ids))
                run.append((doc_id, start, ids[:take], tokens))
                pieces[0] = (doc_id, start + take, ids[take:], tokens)
                if take == len(ids):
                    pieces.pop(0)
                need -= take
            self._emit(run)
        self.window, self.room = [], self.settings.window


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, settings: Settings = Settings()) -> DataFrame:
    """One row per piece: PIECES. sequence_id is unique over the table: the task's number in the upper bits, then a count."""
    tokenizer, corpus = tokenizer or default_tokenizer(), corpus_statistics(docs, settings)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(tokenizer)
        packer = Packer(corpus, settings, TaskContext.get().partitionId() << 40)
        waiting: list[tuple] = []
        words_waiting = bytes_waiting = 0

        def rows() -> pa.RecordBatch:
            columns = list(zip(*packer.out, strict=True)) or [[]] * len(_NAMES)
            packer.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)

        for batch in batches:
            texts, ids_ = as_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            encoded = enc.batch(texts, end_id)
            for first, h, cuts in hashed_texts(texts):
                for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True), first):
                    waiting.append((ids_[i], np.frombuffer(next(encoded), enc.dtype), h[a:b]))
                    words_waiting += b - a
                    bytes_waiting += len(texts[i] or b"")
                    if len(waiting) >= settings.shard_docs or words_waiting >= settings.shard_words or bytes_waiting >= settings.shard_bytes:
                        packer.shard(waiting)
                        waiting, words_waiting, bytes_waiting = [], 0, 0
                        yield rows()
        if waiting:
            packer.shard(waiting)
        packer.flush()
        yield rows()
        del packer, waiting
        release_memory()

    # equal keys side by side, in an order that a rerun repeats
    return dealt(docs, corpus, settings).repartition(F.xxhash64("key")).sortWithinPartitions("key", "doc_id").select("doc_id", "text").mapInArrow(fill, PIECES)
