"""What several operators share: word caches, hashes of words and shingles, model transport, and scratch storage (of the library)."""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import free_name, materialise, ordered_positions, release_shuffles, scratch, shared_dir, temporary  # noqa: F401  (shared with the other operators)

#: Words of a text: runs of anything but the six ASCII white-space characters. bytes.split() splits exactly there.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def parallelism(spark: SparkSession) -> int:
    """Partitions for a shuffle of small rows."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * MIX2
    x = x ^ (x >> np.uint64(32))
    x = x * MIX2
    return x ^ (x >> np.uint64(32))


def hash_word(word: bytes) -> int:
    """64 bits of a word, the same in every process."""
    import xxhash

    return xxhash.xxh64_intdigest(word)


class Cache(dict):
    """Values of words, computed once per process. Words over max_bytes are not kept, and past max_items it starts anew, so memory is bounded."""

    def __init__(self, make, max_items: int = 400_000, max_bytes: int = 48):
        super().__init__()
        self.make, self.max_items, self.max_bytes = make, max_items, max_bytes

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.max_bytes:
            if len(self) >= self.max_items:
                self.clear()
            self[word] = value
        return value


WHITE = b" \t\n\x0b\x0c\r"
_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE)] = True
#: A random number for each byte at each of 64 places; a word's hash is the sum over its bytes. White space counts for nothing.
_TABLE = np.random.default_rng(20).integers(0, 1 << 64, (64, 256), dtype=np.uint64)
_TABLE[:, list(WHITE)] = 0
_FLAT = _TABLE.ravel()
BLOCK = 1 << 20


def hashed_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word and where it starts, without making the words. Long texts go block by block; words over 64 bytes are hashed apart."""
    if len(text) > BLOCK + 65536:
        parts, at = [], 0
        while at < len(text):
            end = min(len(text), at + BLOCK)
            while end < len(text) and not _SPACE[text[end]]:
                end += 1
            h, starts = hashed_words(text[at:end]) if end - at <= BLOCK + 65536 else _words_apart(text[at:end])
            parts.append((h, starts + at))
            at = end
        return np.concatenate([h for h, _ in parts]), np.concatenate([s for _, s in parts])
    b = np.frombuffer(text, np.uint8)
    word = ~_SPACE[b]
    if not word.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edge = np.flatnonzero(np.diff(word, prepend=False))
    starts, ends = edge[::2], edge[1::2]
    if len(ends) < len(starts):
        ends = np.append(ends, len(b))
    first = int(starts[0])
    rest = b[first:]
    place = np.arange(len(rest), dtype=np.int32) - np.repeat((starts - first).astype(np.int32), np.diff(starts, append=len(b)))
    place &= 63
    place <<= 8
    place |= rest
    h = np.add.reduceat(_FLAT[place], starts - first)
    for i in np.flatnonzero(ends - starts > 64).tolist():
        h[i] = hash_word(text[starts[i] : ends[i]])
    return mix64(h), starts


def hashed_runs(text: bytes, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end and kind of each run of bytes of one kind but 0; kind: a number for each byte value, 0 for white space."""
    b = np.frombuffer(text, np.uint8)
    k = kind[b]
    starts = np.flatnonzero(np.diff(k, prepend=np.uint8(255)))
    ends = np.append(starts[1:], len(b))
    place = np.arange(len(b), dtype=np.int32) - np.repeat(starts.astype(np.int32), ends - starts)
    place &= 63
    place <<= 8
    place |= b
    h = np.add.reduceat(_FLAT[place], starts) if len(b) else np.zeros(0, np.uint64)
    kinds = k[starts]
    for i in np.flatnonzero((ends - starts > 64) & (kinds > 0)).tolist():
        h[i] = hash_word(text[starts[i] : ends[i]])
    used = kinds > 0
    return mix64(h[used]), starts[used], ends[used], kinds[used]


def _words_apart(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The same for a block with a word that is longer than a block."""
    found = [(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    h = [hash_word(w) if len(w) > 64 else int(_TABLE[np.arange(len(w)), np.frombuffer(w, np.uint8)].sum(dtype=np.uint64)) for _, w in found]
    return mix64(np.array(h, np.uint64)), np.array([at for at, _ in found], np.int64)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of `width` neighbours; a shorter sequence is one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(width, n)
    out = mix64(hashes[: n - k + 1] + np.uint64(int(MIX1) * k % (1 << 64)))
    for i in range(1, k):
        out = out * MIX1 + hashes[i : n - k + 1 + i]
        out ^= out >> np.uint64(29)
    return mix64(out)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting, which is several times as fast here as numpy's own way by hashing)."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def pack(array: np.ndarray) -> bytes:
    return zlib.compress(array.tobytes(), 1)


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype)


def smallest_draws(df: DataFrame, draw: Column, ties: str, n: int) -> DataFrame:
    """The n rows with the smallest hashes `draw` (a 64-bit hash). A threshold from the number of rows leaves about 1.5 n of them before the sort, so
    that what partitions send to be merged doesn't grow with their number."""
    total = df.count()
    if total > 2 * n + 1000:
        df = df.where(F.pmod(draw, F.lit(1 << 40)) < int((1.5 * n + 100) / total * (1 << 40)))
    return df.orderBy(F.pmod(draw, F.lit(1 << 40)), ties).limit(n)


def one_text_each(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text and others that go by doc_id) with one row for each doc_id, that of the smallest hash of its text, so that a doc_id of many rows
    counts once. Each task sends one text for each doc_id at most."""
    others = [c for c in rows.columns if c not in ("doc_id", "text")]
    return rows.groupBy("doc_id", *others).agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def release_memory() -> None:
    """Gives freed memory back to the system at the end of a task: Python workers live on, beside executors that use what is left."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def as_bytes(column) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow string column."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
