"""Operator 1: approximate nearest neighbours by an inverted file with product-quantised residuals.

Coarse centroids and residual codebooks are fitted on a bounded sample (`sample` vectors, those with the smallest hashes of vec_id). Every vector is
then put in the list of its nearest centroid, with the codes of its residual. A query probes the lists with the largest inner products; in a list,
asymmetric distance tables (query against codebooks) rank the codes, and the best are reranked exactly, in double precision, on original vectors.
Equal table sums at the cut are all reranked, so groups of copies, which share their codes, lose nothing to the cut. How many lists a query probes is
read off the sample: the fewest with which sampled queries find `recall` of their true neighbours there.

Queries whose probed lists hold too few candidates probe on until they hold k or all lists are read.

An exact check follows. The k-th score that a query has found bounds what it may miss: a list holds nothing better where the query's inner product with
the centroid, and its length times the radius of the list, stay below. Queries go once more to the bins with lists that are not ruled out so, and what the
first pass has not found there and is as good is added. So the result is exact on any rows; the sample decides only how much the bounds rule out.

Neighbouring lists share a bin of about `block` vectors, and a larger list is cut into several blocks, so that a list, or a vector with its copies, may
hold a third of all rows. Each vector is shuffled once, to its block; a query goes to the blocks of the bins that it probes, and a task holds one block
while its queries stream past. The number of lists is the square root of the number of vectors up to `lists`, and the sample grows with it. Only counts, one for each
centroid, reach the driver.

Edge cases: vectors that are null, zero, hold a null or non-finite component, or have another length than most, take no part as candidates or queries;
equal scores go to the smaller vec_id; a repeated vec_id is one candidate per row, but never its own query's, and one query, by its smallest vector;
null vec_ids take no part; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise


@dataclass(frozen=True)
class Settings:
    k: int = 20
    sample: int = 20_000  # at least; `per_list` for each list, if that is more
    per_list: int = 16
    lists: int = 4096  # at most; the square root of the number of vectors, if that is less
    recall: float = 0.97  # of sampled queries in the sample, by the lists probed
    trials: int = 200  # sampled queries
    parts: int = 16
    words: int = 256
    rerank: int = 512
    block: int = 4096
    seed: int = 3


@dataclass
class Index:
    centroids: np.ndarray  # lists x dim
    books: np.ndarray  # parts x words x width
    probe: int  # lists that a query probes


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (centres**2).sum(1) / 2
    for i in range(0, len(x), 8192):
        out[i : i + 8192] = np.argmax(x[i : i + 8192] @ centres.T - half, 1)
    return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[np.sort(rng.choice(len(distinct), k, replace=False))].astype(np.float64)
    for _ in range(rounds):
        at = _nearest(x, centres)
        n = np.bincount(at, minlength=k)
        sums = np.stack([np.bincount(at, x[:, d], k) for d in range(x.shape[1])], 1)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _split(x: np.ndarray, parts: int) -> np.ndarray:
    """rows x parts x width, with zeros where the parts do not divide the dimension."""
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, width * parts - x.shape[1]))).reshape(len(x), parts, width)


def fit_index(sample: np.ndarray, n: int, settings: Settings = Settings()) -> Index:
    rng = np.random.default_rng(settings.seed)
    lists = int(max(1, min(settings.lists, np.sqrt(n), len(sample))))
    centroids = _kmeans(sample, lists, rng)
    rest = _split(sample - centroids[_nearest(sample, centroids)], settings.parts)
    books = np.zeros((settings.parts, settings.words, rest.shape[2]))
    for m in range(settings.parts):
        found = _kmeans(rest[:, m], settings.words, rng, 6)
        books[m] = np.concatenate([found, np.repeat(found[:1], settings.words - len(found), 0)])
    return Index(centroids, books, _probes_needed(sample, centroids, settings))


def encode(x: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    at = _nearest(x, index.centroids)
    rest = _split(x - index.centroids[at], len(index.books))
    return at, np.stack([_nearest(rest[:, m], index.books[m]) for m in range(len(index.books))], 1).astype(np.uint8)


def _probes_needed(sample: np.ndarray, centroids: np.ndarray, settings: Settings) -> int:
    q = sample[: settings.trials]
    score = q @ sample.T
    score[np.arange(len(q)), np.arange(len(q))] = -np.inf  # not the query itself, which need not be its own nearest
    near = np.argsort(-score, 1, kind="stable")[:, : min(settings.k, len(sample) - 1)]
    place = np.argsort(np.argsort(-(q @ centroids.T), 1, kind="stable"), 1)
    needed = np.sort(np.take_along_axis(place, _nearest(sample, centroids)[near], 1).ravel())
    return int(needed[min(len(needed) - 1, int(settings.recall * len(needed)))]) + 1 if len(needed) else 1


def probes(q: np.ndarray, index: Index, counts: np.ndarray, need: np.ndarray) -> list[np.ndarray]:
    """The lists that each query probes, best first: index.probe of them, or as many as hold `need` vectors. counts: vectors by list."""
    order = np.argsort(-(q @ index.centroids.T), axis=1, kind="stable")
    held = np.cumsum(counts[order], 1)
    enough = (held < need[:, None]).sum(1) + 1
    return [o[: max(index.probe, n)] for o, n in zip(order, enough.tolist(), strict=True)]


def search_bin(q: np.ndarray, q_ids: np.ndarray, probed: list[np.ndarray], x: np.ndarray, ids: np.ndarray, at: np.ndarray, codes: np.ndarray, index: Index, k: int, rerank: int):
    """For each query its k best of one bin: rows of q, rows of x, scores. x: original vectors, at: their lists, probed: the lists of each query."""
    lists, local = np.unique(at, return_inverse=True)
    rows, found, scores = [], [], []
    for i in range(0, len(q), 64):
        part = q[i : i + 64]
        tables = np.einsum("qmw,mvw->mqv", _split(part, len(index.books)), index.books).astype(np.float32)
        wanted = np.stack([np.isin(lists, p) for p in probed[i : i + 64]])
        base = np.where(wanted, part @ index.centroids[lists].T, -np.inf).astype(np.float32)
        rough = base[:, local]
        for m in range(len(tables)):
            rough += tables[m][:, codes[:, m]]
        for j in range(len(part)):
            r = rough[j]
            cut = np.partition(r, len(r) - rerank)[len(r) - rerank] if len(r) > rerank else -np.inf
            near = np.flatnonzero((r >= cut) & (r > -np.inf))
            near = near[ids[near] != q_ids[i + j]]
            exact = (x[near] * part[j]).sum(1)
            best = np.lexsort((ids[near], -exact))[:k]
            rows.append(np.full(len(best), i + j))
            found.append(near[best])
            scores.append(exact[best])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def reaching(q: np.ndarray, least: np.ndarray, index: Index, radius: np.ndarray) -> np.ndarray:
    """queries x lists: whether a list may hold a vector whose inner product with the query is `least` or more. radius: by list, below 0 for empty ones."""
    lengths = np.sqrt((q * q).sum(1))
    bound = q @ index.centroids.T + lengths[:, None] * radius
    slip = 1e-9 * lengths[:, None] * (np.sqrt((index.centroids**2).sum(1)) + np.abs(radius))  # of rounding
    return (bound + slip >= least[:, None]) & (radius >= 0)


def check_bin(q: np.ndarray, q_ids: np.ndarray, least: np.ndarray, wanted: np.ndarray, x: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int):
    """For each query its k best vectors of one block, among those of its wanted lists (queries x lists) with a score of `least` or more: rows of q, rows
    of x, scores."""
    lengths = np.sqrt((x * x).sum(1))
    rows, found, scores = [], [], []
    for i in range(0, len(q), 64):
        part = q[i : i + 64]
        rough = part @ x.T
        slip = 1e-9 * np.sqrt((part * part).sum(1))[:, None] * lengths  # products of matrices round in another order
        able = (rough + slip >= least[i : i + 64, None]) & wanted[i : i + 64][:, at]
        for j in range(len(part)):
            near = np.flatnonzero(able[j])
            near = near[ids[near] != q_ids[i + j]]
            if len(near) > 4 * k:  # only what may be among the k best
                r, s = rough[j, near], slip[j, near]
                near = near[r + s >= np.partition(r - s, len(r) - k)[len(r) - k]]
            exact = (x[near] * part[j]).sum(1)
            best = np.lexsort((ids[near], -exact))[:k]
            rows.append(np.full(len(best), i + j))
            found.append(near[best])
            scores.append(exact[best])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array<double>) of the vectors that take part."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(finite & F.exists("embedding", lambda x: x != 0))
    common = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.where(F.size("embedding") == (common["n"] if common else 0))


def build(vectors: DataFrame, settings: Settings = Settings()) -> tuple[Index, DataFrame]:
    """The fitted index, and every usable vector with list, codes, embedding, distance to its centroid and a number, written to the shared folder."""
    v = usable(vectors)
    n = v.count()
    # about `size` of the vectors by a hash threshold; at most `size` of those are taken
    size = max(settings.sample, settings.per_list * min(settings.lists, int(n**0.5)))
    share = min(1.0, 1.2 * size / max(1, n))
    drawn = v.where(F.pmod(F.xxhash64("vec_id", F.lit(settings.seed)), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else v
    got = drawn.orderBy(F.xxhash64("vec_id", F.lit(settings.seed)), "vec_id").limit(size).select("embedding").toArrow()
    sample = _matrix(got.column("embedding").combine_chunks()) if len(got) else np.zeros((1, 1))
    index = fit_index(sample, n, settings)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("embedding"))
                at, codes = encode(x, index)
                far = np.sqrt(((x - index.centroids[at]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(at, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(far)], names=["vec_id", "embedding", "list", "codes", "far"])

    placed = v.mapInArrow(put, "vec_id long, embedding array<double>, list int, codes binary, far double")
    return index, materialise(placed.withColumn("row", F.monotonically_increasing_id()), "ivf")


def _bins(counts: dict[int, int], block: int) -> dict[int, tuple[int, int]]:
    """list -> (bin, number of blocks of that bin)."""
    out, number, held = {}, 0, 0
    for i in sorted(counts):
        if held and held + counts[i] > block:
            number, held = number + 1, 0
        out[i] = (number, max(1, -(-counts[i] // block)))
        held += counts[i]
    return out


ROUTED = "query_id long, query array<double>, least double, bin int, lists array<int>"
RESULT = "query_id long, row long, vec_id long, score double"


def _routed(asked: DataFrame, bins: dict[int, tuple[int, int]], choose: Callable[[pa.RecordBatch], list[np.ndarray]]) -> DataFrame:
    """A row for each query and bin that it visits, with its lists there. choose: the lists of each query of a batch."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, numbers, lists = [], [], []
            for i, probed in enumerate(choose(batch)):
                of: dict[int, list[int]] = {}
                for p in probed.tolist():
                    if p in bins:
                        of.setdefault(bins[p][0], []).append(p)
                rows += [i] * len(of)
                numbers += list(of)
                lists += list(of.values())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in ("vec_id", "embedding", "least")), pa.array(numbers, pa.int32()), pa.array(lists, pa.list_(pa.int32()))], names=["query_id", "query", "least", "bin", "lists"])

    return asked.mapInArrow(route, ROUTED)


def _met(stored: DataFrame, routed: DataFrame, bins: dict[int, tuple[int, int]], search: Callable) -> DataFrame:
    """RESULT: what search finds for the queries of each block in it. Each vector goes to its block, each query to all blocks of its bins."""
    # one row per list, and the number of lists is bounded
    table = stored.sparkSession.createDataFrame([(i, n, blocks) for i, (n, blocks) in bins.items()], "list int, bin int, blocks int")
    per_bin = table.groupBy("bin").agg(F.max("blocks").alias("blocks"))
    null = lambda kind: F.lit(None).cast(kind)
    left = stored.join(F.broadcast(table), "list").withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int"))
    left = left.select("bin", "block", F.lit(False).alias("is_query"), F.col("vec_id").alias("id"), "row", F.col("embedding").alias("vector"), null("double").alias("least"), "list", "codes", null("array<int>").alias("lists"))
    right = routed.join(F.broadcast(per_bin), "bin").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = right.select("bin", "block", F.lit(True).alias("is_query"), F.col("query_id").alias("id"), null("long").alias("row"), F.col("query").alias("vector"), "least", null("int").alias("list"), null("binary").alias("codes"), "lists")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come block by block, vectors before queries."""
        block, held, ready = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column("bin").to_numpy(), batch.column("block").to_numpy(), batch.column("is_query").to_numpy(zero_copy_only=False)], 1)
            cuts = np.flatnonzero(np.append(True, (marks[1:] != marks[:-1]).any(1)))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(marks)], strict=True):
                part, at = batch.slice(a, b - a), tuple(marks[a, :2].tolist())
                if at != block:
                    block, held, ready = at, [], None
                if not marks[a, 2]:
                    held.append(part)
                    continue
                if not held:
                    continue
                if ready is None:
                    x = pa.Table.from_batches(held).combine_chunks()
                    codes = np.frombuffer(b"".join(x.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
                    ready = _matrix(x.column("vector").chunk(0)), x.column("id").to_numpy(), x.column("list").to_numpy(), codes
                    numbers, held = x.column("row").to_numpy(), held[:1]
                q_ids = part.column("id").to_numpy()
                rows, found, scores = search(_matrix(part.column("vector")), q_ids, part.column("least").to_numpy(zero_copy_only=False), [np.array(p) for p in part.column("lists").to_pylist()], *ready)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[rows]), pa.array(numbers[found]), pa.array(ready[1][found]), pa.array(scores)], names=["query_id", "row", "vec_id", "score"])

    dealt = left.unionByName(right).repartition(F.xxhash64("bin", "block")).sortWithinPartitions("bin", "block", "is_query")
    return dealt.mapInArrow(run, RESULT)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, every: int = 20, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose vec_id is divisible by `every`, its k nearest others."""
    index, stored = build(vectors, settings)
    # one row per list
    per_list = {r["list"]: r for r in stored.groupBy("list").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    bins = _bins({i: r["n"] for i, r in per_list.items()}, settings.block)
    counts = np.array([per_list[i]["n"] if i in per_list else 0 for i in range(len(index.centroids))])
    radius = np.array([per_list[i]["far"] if i in per_list else -1.0 for i in range(len(index.centroids))])
    asked = stored.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.count("*").alias("own"))

    def by_probes(batch: pa.RecordBatch) -> list[np.ndarray]:
        return probes(_matrix(batch.column("embedding")), index, counts, batch.column("own").to_numpy() + settings.k)  # its own rows are no candidates

    def by_bounds(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [np.flatnonzero(r) for r in reaching(_matrix(batch.column("embedding")), batch.column("least").to_numpy(), index, radius)]

    def search(q, q_ids, least, lists, x, ids, at, codes):
        return search_bin(q, q_ids, lists, x, ids, at, codes, index, settings.k, settings.rerank)

    def check(q, q_ids, least, lists, x, ids, at, codes):
        wanted = np.zeros((len(q), len(index.centroids)), bool)
        for i, mine in enumerate(lists):
            wanted[i, mine] = True
        return check_bin(q, q_ids, least, wanted, x, ids, at, settings.k)

    first = materialise(_ranked(_met(stored, _routed(asked.withColumn("least", F.lit(None).cast("double")), bins, by_probes), bins, search), settings.k), "found")
    # fewer than k are all there are: probes go on until they hold k
    kth = first.where(F.col("rank") == settings.k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    more = _met(stored, _routed(asked.join(kth, "vec_id"), bins, by_bounds), bins, check).join(first.select("query_id", "row"), ["query_id", "row"], "left_anti")
    return _ranked(first.select("query_id", "row", "vec_id", "score").unionByName(more), settings.k).select("query_id", "rank", "vec_id", "score")
