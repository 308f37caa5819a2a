"""Operator 12: groups of spelling variants among the words of a corpus: words within one inserted, deleted or replaced letter of each other.

Method: an inverted index of positional 3-grams (words padded by two at both ends) with a count filter. One edit destroys three of a word's grams at
most, so of the four that are rarest in the vocabulary one is left in any near word, at the same place or one further: only those four are posted. The
shuffle sorts the postings by gram and merges them in runs; a task reads them in that order and pairs what lies in one list under the limits of length
(equal, or one more) and position (equal, or one more for the longer word), keeps pairs whose shared grams reach the one-edit bound, and verifies them.
Lists over `most` words are indexed anew among themselves, where what they share is no longer rare, until they are short or don't shrink. A pair counts
in the list of the rarest gram that posts both in reach, so that it is counted once and rows of pairs are never made: each task sends, for each word, the
number of its near words and the best of them.

Word counts are exact, over whole texts, with map-side combining. Gram counts (91^3 at most) are the only thing that reaches the driver. Lists of a gram
that many words hold are dealt out by length and position.

Edge cases: null and empty texts have no words; a null doc_id is an empty string in the hash; repeated rows count as often as they come; ties of counts go
to the smaller word in code-point order; words of any length are compared whole; other columns are ignored; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, materialise, release_memory

RUN = "[a-zÀ-ÿ]+"
DAMAGE = 97
#: Letters by number from 1; 0 pads.
LETTER = np.zeros(256, np.int64)
LETTER[ord("a") : ord("z") + 1] = np.arange(1, 27)
LETTER[0xC0:] = np.arange(27, 91)
BASE, GRAMS, KEPT = 91, 91**3, 4
#: A gram in fewer places is never dealt out.
HOT_LEAST = 1000
MASK = np.int64((1 << 20) - 1)
SALTED = np.int64(1 << 62)


def word_counts(docs: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """word, n: runs of letters in lower case, a letter left out of those whose hash with the doc_id 97 divides."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower())
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all(text, F.lit(RUN), 0)).alias("w"))
    runs = runs.where(F.length("w") >= min_length).withColumn("h", F.crc32(F.concat("d", F.lit(":"), "w").cast("binary")))
    at = F.pmod("h", F.length("w")).cast("int")
    without = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    words = runs.select(F.when(F.col("h") % DAMAGE == 0, without).otherwise(F.col("w")).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


class Words:
    """Letters of words, and what is made of them for many at a time."""

    def __init__(self, words: list[str]):
        data = [w.encode("latin-1") for w in words]
        self.length = np.array([len(d) for d in data], np.int64)
        self.place = np.cumsum(self.length) - self.length
        self.flat = LETTER[np.frombuffer(b"".join(data), np.uint8)].astype(np.uint8)

    def letters(self, rows: np.ndarray, length: int) -> np.ndarray:
        return self.flat[self.place[rows][:, None] + np.arange(length)]

    def by_length(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Lengths, with the places in rows of the words of that length; long words few at a time."""
        if not len(rows):
            return
        order = np.argsort(self.length[rows], kind="stable")
        sizes, starts = np.unique(self.length[rows][order], return_index=True)
        for size, a, b in zip(sizes.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
            step = max(1, 4_000_000 // size)
            for at in range(a, b, step):
                yield size, order[at : min(b, at + step)]

    def grams(self, rows: np.ndarray, length: int) -> np.ndarray:
        m = np.zeros((len(rows), length + 4), np.int64)
        m[:, 2:-2] = self.letters(rows, length)
        return (m[:, :-2] * BASE + m[:, 1:-1]) * BASE + m[:, 2:]

    def rarest(self, rows: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and positions of the four rarest grams of each word."""
        ranks, places = np.zeros((len(rows), KEPT), np.int64), np.zeros((len(rows), KEPT), np.int64)
        for length, some in self.by_length(rows):
            g = rank[self.grams(rows[some], length)]
            at = np.argsort(g, axis=1, kind="stable")[:, :KEPT]
            ranks[some], places[some] = np.take_along_axis(g, at, 1), at
        return ranks, places

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs are one edit apart. j's word is as long as i's or one longer; other pairs are not near."""
        out = np.zeros(len(i), bool)
        longer = self.length[j] - self.length[i]
        for more in (0, 1):
            of = np.flatnonzero(longer == more)
            for length, some in self.by_length(i[of]):
                at = of[some]
                a, b = self.letters(i[at], length), self.letters(j[at], length + more)
                same = a == b[:, :length]
                if more:
                    # grams shared at the same place or one further: length of them at least
                    moved = a == b[:, 1:]
                    fit = np.flatnonzero(_windows(same, True, False) + _windows(moved, False, True) >= length)
                    head, tail = np.cumprod(same[fit], 1, np.uint8).sum(1), np.cumprod(moved[fit, ::-1], 1, np.uint8).sum(1)
                    out[at[fit[head + tail >= length]]] = True
                else:
                    fit = np.flatnonzero(_windows(same, True, True) >= length - 1)
                    out[at[fit[(~same[fit]).sum(1) == 1]]] = True
        return out


def _windows(same: np.ndarray, left: bool, right: bool) -> np.ndarray:
    """Runs of three equal places in each row; the padding counts as equal on the sides that are given."""
    m = np.zeros((len(same), same.shape[1] + 4), bool)
    m[:, :2], m[:, 2:-2], m[:, -2:] = left, same, right
    return (m[:, :-2] & m[:, 1:-1] & m[:, 2:]).sum(1)


def _expand(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, most: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of stretches a[k] .. a[k]+na[k] and b[k] .. b[k]+nb[k], about `most` at a time."""
    while (big := na > np.maximum(1, most // nb)).any():  # long stretches in parts
        cut = np.maximum(1, most // nb)
        a, b, nb = np.concatenate([a, (a + cut)[big]]), np.concatenate([b, b[big]]), np.concatenate([nb, nb[big]])
        na = np.concatenate([np.minimum(na, cut), (na - cut)[big]])
    total = na * nb
    groups = (np.cumsum(total) - total) // most
    for lo, hi in _stretches(groups):
        t, width = total[lo:hi], nb[lo:hi]
        k = np.repeat(np.arange(hi - lo), t)
        inside = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
        yield a[lo:hi][k] + inside // width[k], b[lo:hi][k] + inside % width[k]


def _stretches(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal neighbours begin and end."""
    if len(x):
        starts = np.append(0, np.flatnonzero(np.diff(x)) + 1).tolist()
        yield from zip(starts, [*starts[1:], len(x)], strict=True)


def near_pairs(words: Words, group: np.ndarray, row: np.ndarray, place: np.ndarray, most: int = 256, parent: int = 1 << 62) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of words that are near and that some group posts at places in reach; each pair once, j's word the longer one, or the later row."""
    length = words.length[row]
    order = np.lexsort((row, place, length, group))
    group, row, place, length = group[order], row[order], place[order], length[order]
    new = np.ones(len(row), bool)
    new[1:] = (group[1:] != group[:-1]) | (length[1:] != length[:-1]) | (place[1:] != place[:-1])
    start = np.flatnonzero(new)
    size = np.diff(start, append=len(row))
    # lists by group, length and place; lists of the next length at the same place and one further
    key = lambda g, n, p: (g << np.int64(40)) | ((n & MASK) << np.int64(20)) | (p & MASK)
    g, n, p = group[start], length[start], place[start]
    keys = key(g, n, p)
    by_key = np.argsort(keys, kind="stable")
    found: list[np.ndarray] = []

    def partner(shift: int) -> tuple[np.ndarray, np.ndarray]:
        want = key(g, n + 1, p + shift)
        at = by_key[np.minimum(np.searchsorted(keys, want, sorter=by_key), len(keys) - 1)] if len(keys) else by_key
        return at, keys[at] == want

    partners = [partner(shift) for shift in (0, 1)]
    big = size > most
    for k in np.flatnonzero(big).tolist():
        lists = [k, *[int(at[k]) for at, there in partners if there[k]]]
        rows = np.unique(np.concatenate([row[start[x] : start[x] + size[x]] for x in lists]))
        if len(rows) > 0.9 * parent:
            big[k] = False
        else:
            found.append(np.stack(_among(words, rows, most)))
    small = np.flatnonzero(~big)
    for at, there in [(np.arange(len(start)), np.ones(len(start), bool)), *partners]:
        k = small[there[small]]
        for x, y in _expand(start[k], size[k], start[at[k]], size[at[k]]):
            i, j = row[x], row[y]
            ordered = (words.length[i] < words.length[j]) | (i < j)
            i, j = i[ordered], j[ordered]
            near = words.near(i, j)
            found.append(np.stack([i[near], j[near]]))
    pairs = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
    packed = np.unique(pairs[0] << np.int64(32) | pairs[1])
    return packed >> np.int64(32), packed & np.int64(0xFFFFFFFF)


def _among(words: Words, rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All near pairs among rows, by the grams that are rare there."""
    count = np.zeros(GRAMS, np.int64)
    for length, some in words.by_length(rows):
        g, n = np.unique(words.grams(rows[some], length), return_counts=True)
        count[g] += n
    ranks, places = words.rarest(rows, ranked(count))
    return near_pairs(words, ranks.ravel(), np.repeat(rows, KEPT), places.ravel(), most, len(rows))


def ranked(count: np.ndarray) -> np.ndarray:
    """Rank of each gram, from the rarest; ties by its number."""
    rank = np.zeros(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    return rank


def _first_shared(ranks: np.ndarray, places: np.ndarray, length: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest rank that both words of a pair post in reach, and the smallest place (the later of the two) where they do."""
    best, where = np.full(len(i), 1 << 60, np.int64), np.full(len(i), 1 << 60, np.int64)
    longer = length[j] > length[i]
    for x in range(KEPT):
        for y in range(KEPT):
            gap = places[j, y] - places[i, x]
            fit = (ranks[i, x] == ranks[j, y]) & ((gap == 0) | (longer & (gap == 1)))
            r, w = np.where(fit, ranks[i, x], 1 << 60), np.where(fit, places[j, y], 1 << 60)
            where = np.where(r < best, w, np.where(r == best, np.minimum(where, w), where))
            best = np.minimum(best, r)
    return best, where


def gram_counts(words: DataFrame) -> np.ndarray:
    """In how many places of words each gram stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(GRAMS, np.int64)
        for batch in batches:
            w = Words(batch.column("word").to_pylist())
            for length, some in w.by_length(np.arange(batch.num_rows)):
                g, n = np.unique(w.grams(some, length), return_counts=True)
                total[g] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["g", "n"])

    # one row a gram: 91^3 at most
    got = words.select("word").mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(GRAMS, np.int64)
    total[got.column("g").to_numpy()] = got.column("n").to_numpy()
    return total


def nearest(words: DataFrame, most: int = 256, share: float = 0.002) -> DataFrame:
    """word, n_near, best, best_n of each word (word, n) that has near words. share: grams that this share of words hold are dealt out by length and place."""
    count = gram_counts(words)
    rank = ranked(count)
    hot = np.zeros(GRAMS, bool)
    hot[rank] = count > max(HOT_LEAST, share * count.sum() / 10)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words(batch.column("word").to_pylist())
            rows = np.arange(batch.num_rows)
            ranks, places = w.rarest(rows, rank)
            key, row = ranks.ravel(), np.repeat(rows, KEPT)
            split = hot[key]
            keys, whose = [key[~split]], [row[~split]]
            for more in (0, 1):
                for on in (0, 1):
                    at, size = (places.ravel()[split] + on) & MASK, (w.length[row[split]] + more) & MASK
                    keys.append(SALTED | at << np.int64(40) | size << np.int64(20) | key[split])
                    whose.append(row[split])
            key, row = np.concatenate(keys), np.concatenate(whose)
            order = np.lexsort((key, row))
            key, row = key[order], row[order]
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            key, row = key[first], row[first]
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("word").take(pa.array(row)), batch.column("n").take(pa.array(row))], names=["key", "word", "n"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 200_000:
                table = pa.Table.from_batches(held)
                keys = table.column("key").to_numpy()
                last = int(np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))[-1])  # the last list may go on
                if last:
                    yield from lists(table.slice(0, last))
                held = table.slice(last).to_batches()
                size = table.num_rows - last
        if size:
            yield from lists(pa.Table.from_batches(held))
        release_memory()

    def lists(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key, n, text = table.column("key").to_numpy(), table.column("n").to_numpy(), table.column("word").to_pylist()
        words_, rows = Words(text), np.arange(len(text))
        ranks, places = words_.rarest(rows, rank)
        group = np.cumsum(np.diff(key, prepend=key[0]) != 0)
        gram = key & MASK
        mine = ranks == gram[:, None]
        row = np.repeat(rows, KEPT)[mine.ravel()]
        i, j = near_pairs(words_, group[row], row, places.ravel()[mine.ravel()], most)
        best, where = _first_shared(ranks, places, words_.length, i, j)
        salted = key[i] >= SALTED
        in_class = ((words_.length[j] & MASK) == ((key[i] >> np.int64(20)) & MASK)) & ((where & MASK) == ((key[i] >> np.int64(40)) & MASK))
        whole = (best == gram[i]) & (~salted | in_class)
        i, j = i[whole], j[whole]
        if not len(i):
            return
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        used = np.unique(a)
        order = np.zeros(len(text), np.int64)
        order[sorted(used.tolist(), key=text.__getitem__)] = np.arange(len(used))
        by = np.lexsort((order[b], -n[b], a))
        a, b = a[by], b[by]
        start = np.flatnonzero(np.diff(a, prepend=-1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([text[x] for x in a[start].tolist()]), pa.array(np.diff(start, append=len(a))), pa.array([text[x] for x in b[start].tolist()]), pa.array(n[b[start]])],
            names=["word", "n_near", "best", "best_n"],
        )

    routed = words.mapInArrow(route, "key long, word string, n long").repartition("key").sortWithinPartitions("key")
    found = routed.mapInArrow(join, "word string, n_near long, best string, best_n long")
    # the largest count, the smaller word of equal ones
    first = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("f")).select("word", "n_near", F.col("f.w").alias("best"), (-F.col("f.m")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain of forms (word, form), by doubling; counts grow at least twofold a step, so no chain is long or closed."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialise(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = step.drop("moved")
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, most: int = 256) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of docs (doc_id, text)."""
    words = materialise(word_counts(docs), "words")
    near = nearest(words, most)
    form = F.col("best_n") >= 2 * F.col("n")
    joined = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n"))
    joined = materialise(joined, "forms")
    ends = roots(joined.where("form is not null"))
    return joined.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
