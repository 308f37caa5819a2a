"""Operator 3: MinHash near-dedup by a chosen-path set similarity join.

A document's set holds the hashes of its distinct 5-word shingles. Documents with equal sets (equal in 128 bits of a cryptographic digest) form a
class, which goes on as one. Each class has `coordinates` minwise tokens. In each of `trees` independent trees a class follows a path of two chosen
coordinates, whose tokens name its node; a node with more classes than can be compared is branched further, inside a task down to `small`, by Spark
while it is larger than `large`, by 5/3 chosen coordinates on average. That is more than 1 / 0.75, so a pair at 0.75 that has come to a node is found
below it with a chance of 2/3 however deep the branching goes; with 16 trees it is lost with one of 0.00055 (0.00001 where nodes are small).

A large node that is alike, that is, of which a sixteenth is linked with its leader (confirmed on full sets), is not branched: those links are kept, and
the leader's family, which is one component, leaves the node. What remains goes on as a node. Jaccard distances are a metric, so what is linked with a
member of the family has a similarity of 2 * 0.75 - 1 with the leader at least; classes of that kind (by estimate, with slack) meet all of the family in
nodes of `large` classes at most, a block of it in each. So a family of near copies of any size takes rows in proportion, and loses no link.
Inside a task classes that agree on nearly all tokens with a node's leader leave it once everything near them is compared with them. Small nodes are
compared exhaustively by the share of equal tokens; before signatures are sent there, one bit of each token tells which classes have no partner at all.

What is wanted are components, so not all pairs of a node are sent on. First round: the edges of each node's maximum spanning forest over pairs
whose estimate may be a link. They are confirmed on full sets, and the confirmed ones give components. Second round: in each node the classes that may be
linked with another component come together with their full sets, and all of them are compared there, so that what leaves a task are no pairs but links
that join components. So no link between different texts is lost to a limit; one is lost only if the two share no node or if its estimate is too low by chance.

Components are found by contraction: union-find over bounded runs of edges gives stars, whose members with several centres give the next, smaller
edges. Nothing but counts reaches the driver.

Edge cases: null and blank texts have an empty set and are linked with nothing; a text of fewer than 5 words is one shingle; repeated rows and
repeated doc_ids keep a row each; null doc_ids never become component_id, which is null if no doc_id is reachable, and then kept is false; a
very long text is hashed whole, in blocks; other columns pass through `near_dedup`, whatever their names."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER_BYTES, MIX1, MIX2, as_bytes, distinct, free_name, hashed_words, materialise, mix64, release_memory, release_shuffles, temporary, windows

EDGE = "a long, b long"


@dataclass(frozen=True)
class Settings:
    width: int = 5
    similarity: float = 0.75
    coordinates: int = 512
    trees: int = 16
    slack: float = 0.07  # how far an estimate may lie under the similarity of a link: 3.6 standard deviations
    small: int = 2048
    large: int = 16_384
    seed: int = 11


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return distinct(windows(hashed_words((text or b"").translate(LOWER_BYTES))[0], width))


def digest(hashes: np.ndarray) -> bytes:
    """128 bits of a set; equal sets have equal ones. An empty set has none."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else b""


SET_BYTES = 6


def pack_set(hashes: np.ndarray) -> bytes:
    """A sorted set by the upper 48 bits of its hashes."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - SET_BYTES :].tobytes()


def unpack_set(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    out[:, 8 - SET_BYTES :] = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    return out.view("<u8")[:, 0]


class Signer:
    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.a = (rng.integers(0, 1 << 31, settings.coordinates, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, settings.coordinates, dtype=np.uint32)[:, None]

    def sign(self, hashes: np.ndarray) -> np.ndarray:
        """The minwise tokens of a set, 16 bits each."""
        h = (hashes >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for k in range(0, len(low), 64):  # blocks that stay in the processor's cache
            a, b, mine = self.a[k : k + 64], self.b[k : k + 64], low[k : k + 64]
            for i in range(0, len(h), 1024):
                np.minimum(mine, (a * h[i : i + 1024] + b).min(1), out=mine)
        return (low ^ low >> np.uint32(16)).astype("<u2")


FEATURES = "doc_id long, n_shingles long, digest binary, sign binary, bits binary, hashes binary"


def features(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, class (0: empty set), digest, signature, its lowest bits and full set of each row, written once: texts are hashed once, never shuffled."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(settings)
        for batch in batches:
            n, digests, signs, bits, sets = [], [], [], [], []
            for text in as_bytes(batch.column("text")):
                s = shingles(text, settings.width)
                n.append(len(s))
                digests.append(digest(s))
                sign = signer.sign(s) if len(s) else None
                signs.append(None if sign is None else sign.tobytes())
                bits.append(None if sign is None else np.packbits((sign & 1).astype(np.uint8)).tobytes())
                sets.append(pack_set(s))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary()), pa.array(bits, pa.binary()), pa.array(sets, pa.binary())], names=["doc_id", "n_shingles", "digest", "sign", "bits", "hashes"])
        release_memory()

    return with_class(materialise(docs.select("doc_id", "text").mapInArrow(make, FEATURES), "features"))


def _half(at: int) -> Column:
    """Eight bytes of a digest as a long, 0 for the empty one."""
    return F.when(F.length("digest") == 0, F.lit(0).cast("long")).otherwise(F.conv(F.hex(F.substring("digest", at, 8)), 16, -10).cast("long"))


def with_class(rows: DataFrame) -> DataFrame:
    """Adds class: the first half of the digest, or where two digests agree in it, the second."""
    rows = rows.withColumn("class", _half(1))
    torn = rows.groupBy("class").agg(F.min("digest").alias("_low"), F.max("digest").alias("_high")).where("_low <> _high").select("class").collect()
    if torn:  # about one in 10^19 pairs of sets
        rows = rows.withColumn("class", F.when(F.col("class").isin([r["class"] for r in torn]), _half(9)).otherwise(F.col("class")))
    return rows


def _token(at: Column) -> Column:
    return F.substring("sign", at * 2 + 1, F.lit(2))


def paths(settings: Settings) -> np.ndarray:
    """The two coordinates of each tree; no two trees share one."""
    return np.random.default_rng(settings.seed + 1).permutation(settings.coordinates)[: 2 * settings.trees].reshape(-1, 2)


def first_nodes(classes: DataFrame, settings: Settings) -> DataFrame:
    """tree, node, class: one node in each tree, named by the tokens at two coordinates."""
    names = F.array(*[F.xxhash64(F.lit(r), _token(F.lit(i)), _token(F.lit(j))) for r, (i, j) in enumerate(paths(settings).tolist())])
    return classes.select(F.posexplode(names).alias("tree", "node"), "class")


def branch(entries: DataFrame, settings: Settings) -> DataFrame:
    """The children of nodes: one coordinate chosen by the node, and another for two nodes in three."""
    pick = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(settings.coordinates)).cast("int")
    chosen = F.when(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(3)) != 0, F.array(pick(1), pick(2))).otherwise(F.array(pick(1)))
    return entries.withColumn("_at", F.explode(chosen)).withColumn("node", F.xxhash64("node", "_at", _token(F.col("_at")))).drop("_at")


def part_families(big: DataFrame, rows: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Large nodes: (entries of alike ones without the families of their leaders; entries in which those families meet the others that may be linked with
    them, in nodes of `large` classes at most; entries of the nodes that aren't alike; pairs that were tested with leaders; those that are links)."""
    least = settings.similarity - settings.slack
    # a member's partner; the slack of an estimate is widest at a half
    edge = 2 * settings.similarity - 1 - settings.slack * 0.5 / max(0.1, (settings.similarity * (1 - settings.similarity)) ** 0.5)
    draw = F.xxhash64("node", "class")
    leaders = materialise(big.groupBy("node").agg(F.min_by("class", draw).alias("leader"), F.min_by("sign", draw).alias("lead"), F.count("*").alias("_all")), "leaders")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("sign", "lead"))
                share = (x == y).mean(1)
                out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "class", "leader")), pa.array(share >= least)], names=["node", "class", "leader", "like"])
                yield out.filter(pa.array(share >= edge))

    found = big.join(leaders, "node").where("class <> leader").select("node", "class", "leader", "sign", "lead").mapInArrow(near, "node long, class long, leader long, like boolean")
    found = materialise(found.select("node", "class", "like", F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b")), "near")
    tested = materialise(found.where("like").select("a", "b").distinct(), "tested")
    links = confirm(tested, full_sets(rows, tested.select(F.explode(F.array("a", "b")).alias("class")).distinct()), settings)
    linked = materialise(found.where("like").join(links, ["a", "b"], "left_semi").select("node", "class"), "linked")
    share = linked.groupBy("node").agg(F.count("*").alias("_linked")).join(leaders.select("node", "leader", "_all"), "node").where("_linked * 16 >= _all")
    alike = materialise(share.select("node", "leader", "_linked"), "alike")
    family = linked.join(alike.select("node"), "node", "left_semi")
    gone = family.unionByName(alike.select("node", F.col("leader").alias("class")))
    stay = big.join(alike.select("node"), "node", "left_semi").join(gone, ["node", "class"], "left_anti")
    # members and others in blocks of half a node; every block of the one meets every block of the other
    others = found.join(alike.select("node"), "node", "left_semi").join(family, ["node", "class"], "left_anti").select("node", "class")
    half = max(1, settings.large // 2)
    cuts = others.groupBy("node").agg(F.count("*").alias("_others")).join(alike, "node").select("node", F.ceil(F.col("_linked") / half).alias("_fs"), F.ceil(F.col("_others") / half).alias("_os"))
    block = lambda n: F.pmod(F.xxhash64("class", F.lit(settings.seed)), n)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    meeting = family.join(cuts, "node").select("node", "class", block(F.col("_fs")).alias("_f"), each("_os").alias("_o"))
    meeting = meeting.unionByName(others.join(cuts, "node").select("node", "class", each("_fs").alias("_f"), block(F.col("_os")).alias("_o")))
    meeting = big.join(meeting, ["node", "class"]).withColumn("node", F.xxhash64("node", "_f", "_o")).drop("_f", "_o")
    stay = stay.withColumn("node", F.xxhash64("node", F.lit(settings.seed)))  # so that another class leads it next time
    return stay, meeting, big.join(alike.select("node"), "node", "left_anti"), tested, links


def with_partners(entries: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The entries (tree, node, class, _n) of small nodes that may have a link there, by the share of equal bits of their signatures, with a slack of 4.5
    standard deviations; and those of larger nodes. Spares the others the shuffles of signatures."""
    least = settings.similarity - 4.5 * 2 * (((1 + settings.similarity) * (1 - settings.similarity) / 4) / settings.coordinates) ** 0.5

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in ("tree", "node", "class", "_n")}
        rows = 0
        for node in _by_node(batches, "bits", np.uint8):
            x = np.unpackbits(node["bits"], axis=1, count=settings.coordinates).astype(np.float32) * 2 - 1
            share = x @ x.T  # of equal bits less that of others, which is what the sets share, and chance
            np.fill_diagonal(share, -np.inf)
            keep = share.max(1) >= least * settings.coordinates
            if keep.any():
                rows += int(keep.sum())
                for c, held in out.items():
                    held.append(node[c][keep])
            if rows > 50_000:
                yield pa.RecordBatch.from_pydict({c: np.concatenate(v) for c, v in out.items()})
                out, rows = {c: [] for c in out}, 0
        if rows:
            yield pa.RecordBatch.from_pydict({c: np.concatenate(v) for c, v in out.items()})

    small = entries.where(F.col("_n") <= settings.small).select("tree", "node", "class", "_n").join(classes.select("class", "bits"), "class")
    small = small.repartition(F.xxhash64("node")).sortWithinPartitions("node").mapInArrow(sieve, "tree int, node long, class long, _n long")
    return small.unionByName(entries.where(F.col("_n") > settings.small).select("tree", "node", "class", "_n"))


def nodes(classes: DataFrame, rows: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, pairs tested so far, links among them). Entries: node, class, sign, tree, whole of all nodes with two classes at least and `large` at
    most. whole: the trees (bits) in which the class lies in a node that is compared as it is; tree is `trees` for nodes that came of branching or
    of families, so that each pair can be left to the first tree that has it. rows: what `features` gives."""
    out, entries, first = None, first_nodes(classes, settings), True
    tested = links = classes.sparkSession.createDataFrame([], EDGE)
    for _ in range(100):
        sizes = entries.groupBy("node").agg(F.count("*").alias("_n")).where("_n > 1")
        entries = entries.join(sizes, "node")
        if first:
            entries, first = materialise(entries, "nodes"), False
            whole = entries.groupBy("class").agg(F.bit_or(F.when(F.col("_n") <= settings.small, F.expr("shiftleft(1, tree)")).otherwise(0)).alias("whole"))
            entries = materialise(with_partners(entries, classes, settings), "partnered")
            own = materialise(entries.select("class").distinct(), "wanted")
            signs = marked(classes.select("class", "sign"), own).join(own, "class", "left_semi")
            entries = entries.join(signs.join(whole, "class"), "class")
        entries = materialise(entries.withColumn("tree", F.when(F.col("_n") <= settings.small, F.col("tree")).otherwise(settings.trees)), "nodes")
        fit = entries.where(F.col("_n") <= settings.large).select("node", "class", "sign", "tree", "whole")
        out = fit if out is None else out.unionByName(fit)
        big = entries.where(F.col("_n") > settings.large).drop("_n")
        if not big.limit(1).count():
            return out, tested, links
        alike, meeting, others, pairs, confirmed = part_families(big, rows, settings)
        out = out.unionByName(meeting.withColumn("tree", F.lit(settings.trees)).select(*out.columns))
        tested, links = tested.unionByName(pairs), links.unionByName(confirmed)
        entries = alike.unionByName(branch(others, settings)).withColumn("tree", F.lit(settings.trees))
    return out.unionByName(big.select(*out.columns)), tested, links  # nodes that nothing splits: tasks compare them as they are


def estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Shares of equal tokens, rows of x by rows of y."""
    out = np.empty((len(x), len(y)), np.float32)
    step = max(1, 4_000_000 // max(1, y.size))
    for i in range(0, len(x), step):
        out[i : i + step] = (x[i : i + step, None, :] == y[None]).mean(2, dtype=np.float32)
    return out


def forest(est: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest over the pairs with an estimate of `least` or more."""
    m = len(est)
    best, parent, inside = est[0].copy(), np.zeros(m, np.int64), np.zeros(m, bool)
    inside[0] = True
    best[0] = -1
    out = []
    for _ in range(m - 1):
        i = int(np.argmax(best))
        if best[i] >= least:
            out.append((int(parent[i]), i))
        elif best[i] < 0:
            break
        inside[i] = True
        better = (est[i] > best) & ~inside
        best[better], parent[better] = est[i][better], i
        best[i] = -1
    return out


Compare = Callable[[np.ndarray, np.ndarray, np.ndarray], list[tuple[int, int]]]


def resolve(signs: np.ndarray, ids: np.ndarray, settings: Settings, compare: Callable, salt: int = 1, depth: int = 0) -> list[tuple[int, int]]:
    """Pairs (rows) of one node by chosen-path recursion. compare(est, x, y): pairs to send on of the rows x against the rows y."""
    rows = np.arange(len(ids))
    stack, out = [(rows, np.uint64(salt), depth)], []
    while stack:
        rows, name, depth = stack.pop()
        if len(rows) <= settings.small:
            if len(rows) > 1:
                out += compare(estimates(signs[rows], signs[rows]), rows, rows)
            continue
        draw = mix64(ids[rows].view(np.uint64) ^ name)
        leader = rows[int(np.argmin(draw))]
        est = estimates(signs[leader : leader + 1], signs[rows])[0]
        close = est >= 0.9
        if close.sum() > len(rows) // 4 or depth > 40:
            # too alike to be split: the leader's likes leave the node, once all that is near them is compared with them
            near, rest = rows[close], rows[~close]
            grey = rest[est[~close] >= 0.9 - 2 * (1 - settings.similarity)]
            for i in range(0, len(near), settings.small):
                part = near[i : i + settings.small]
                out += compare(estimates(signs[[leader]], signs[part]), np.array([leader]), part)
                for j in range(0, len(grey), settings.small):
                    other = grey[j : j + settings.small]
                    out += compare(estimates(signs[part], signs[other]), part, other)
            if len(rest):
                stack.append((np.append(rest, leader), mix64(np.array([name]) + MIX2)[0], depth + 1 if not close.sum() > 1 else 0))
            continue
        chosen = mix64(np.array([name, name ^ MIX1, name ^ MIX2]))
        ways = [int(c % np.uint64(settings.coordinates)) for c in chosen[: 2 if chosen[2] % np.uint64(3) else 1]]
        if any(5 * int(np.unique(signs[rows, at], return_counts=True)[1].max()) > 3 * len(rows) for at in ways):
            # children nearly as large as the node: branching would multiply its rows, so it is compared as it is, block by block
            blocks = [rows[i : i + settings.small] for i in range(0, len(rows), settings.small)]
            for i, x in enumerate(blocks):
                for y in blocks[i:]:
                    out += compare(estimates(signs[x], signs[y]), x, y)
            continue
        for at in ways:
            tokens = signs[rows, at]
            order = np.argsort(tokens, kind="stable")
            cuts = np.flatnonzero(np.diff(tokens[order])) + 1
            for part in np.split(rows[order], cuts):
                if len(part) > 1:
                    stack.append((part, mix64(np.array([name]) * MIX1 + np.uint64(at * 65536 + int(signs[part[0], at])))[0], depth + 1))
    return out


def _first_compare(least: float) -> Callable:
    def compare(est: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
        if x is y:
            return [(int(x[i]), int(x[j])) for i, j in forest(est, least)]
        best = est.argmax(0)  # each of y with its nearest of x
        good = est[best, np.arange(len(y))] >= least
        return list(zip(x[best[good]].tolist(), y[good].tolist(), strict=True))

    return compare


def _later_compare(least: float, component: np.ndarray, most: int, full: list, elsewhere: Callable | None = None) -> Callable:
    """elsewhere(i, j): for pairs of rows whether an earlier tree compares them too. full grows where a row has more than `most` partners."""

    def compare(est: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
        cross = (est >= least) & (component[x][:, None] != component[y][None])
        if not cross.any():
            return []
        if int(cross.sum(1).max()) > most:
            full.append(True)
            score = np.where(cross, est, -1)
            keep = np.zeros(cross.shape, bool)
            np.put_along_axis(keep, np.argsort(-score, 1, kind="stable")[:, :most], True, 1)
            cross &= keep
        i, j = np.nonzero(cross)
        i, j = x[i], y[j]
        if elsewhere is not None and len(i):
            here = ~elsewhere(i, j)
            i, j = i[here], j[here]
        return list(zip(i.tolist(), j.tolist(), strict=True))

    return compare


def _elsewhere(node: dict[str, np.ndarray], settings: Settings) -> Callable:
    sign, whole, tree = node["sign"], node["whole"], int(node["tree"][0])
    ways = paths(settings)[:tree]

    def found(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), bool)
        for r, (a, b) in enumerate(ways):
            out |= (whole[i] >> r & 1).astype(bool) & (sign[i, a] == sign[j, a]) & (sign[i, b] == sign[j, b])
        return out

    return found


def _by_node(batches: Iterator[pa.RecordBatch], name: str = "sign", kind="<u2") -> Iterator[dict[str, np.ndarray]]:
    """Whole nodes of rows that come sorted by node. name, kind: the column of arrays of one length, and what they hold."""
    held: list[pa.RecordBatch] = []

    def whole(table: pa.Table) -> Iterator[dict[str, np.ndarray]]:
        table = table.combine_chunks()
        node = table.column("node").to_numpy()
        signs = np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(len(node), -1)
        columns = {c: table.column(c).to_numpy() for c in table.column_names if c != name}
        cuts = np.append(np.flatnonzero(np.diff(node, prepend=node[0] - 1 if len(node) else 0)), len(node))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield {name: signs[a:b]} | {c: v[a:b] for c, v in columns.items()}

    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column("node")
        last = node[len(node) - 1]
        same = int((node.to_numpy() == last.as_py()).argmax()) if node[0] != last else 0
        if same or (held and held[-1].column("node")[held[-1].num_rows - 1] != node[0]):
            yield from whole(pa.Table.from_batches([*held, batch.slice(0, same)]))
            held = []
        held.append(batch.slice(same))
    if held:
        yield from whole(pa.Table.from_batches(held))


def propose(entries: DataFrame, settings: Settings) -> DataFrame:
    """Distinct pairs a < b of classes that may be linked: the forests of all nodes."""
    least = settings.similarity - settings.slack

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for node in _by_node(batches):
            ids = node["class"]
            for i, j in resolve(node["sign"], ids, settings, _first_compare(least), int(node["node"][0]) & 0xFFFFFFFFFFFFFFFF):
                x, y = int(ids[i]), int(ids[j])
                if x != y:
                    a.append(min(x, y))
                    b.append(max(x, y))
            if len(a) > 50_000:
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})
                a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # by an expression: Spark drops a repartition by what the rows are dealt by already, and may then cut those partitions when it re-plans
    return entries.repartition(F.xxhash64("node")).sortWithinPartitions("node").mapInArrow(pairs, EDGE).distinct()


def unsettled(entries: DataFrame, settings: Settings) -> DataFrame:
    """node, class, component of the classes that may be linked with a class of another component in that node; entries have a column `component`."""
    least = settings.similarity - settings.slack

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in _by_node(batches):
            ids, component = node["class"], node["component"]
            if (component == component[0]).all():
                continue
            hit = np.zeros(len(ids), bool)
            pairs = _later_compare(least, component, len(ids), [], _elsewhere(node, settings))

            def compare(est: np.ndarray, x: np.ndarray, y: np.ndarray, hit=hit, pairs=pairs) -> list:
                for i in range(0, len(x), 128):  # some at a time: what is wanted are the classes, not their pairs
                    some = np.array(pairs(est[i : i + 128], x[i : i + 128], y), np.int64).reshape(-1)
                    hit[some] = True
                return []

            resolve(node["sign"], ids, settings, compare, int(node["node"][0]) & 0xFFFFFFFFFFFFFFFF)
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(node["node"][hit]), pa.array(ids[hit]), pa.array(component[hit])], names=["node", "class", "component"])

    return entries.repartition(F.xxhash64("node")).sortWithinPartitions("node").mapInArrow(found, "node long, class long, component long")


def joining(sets: list[np.ndarray], component: np.ndarray, share: int) -> list[tuple[int, int]]:
    """Pairs of sets (of sorted distinct numbers) of different components with 100 * intersection >= share * union, enough of them to join all components
    that any such pair joins. Counts what each set has in common with all others along the lists of its elements."""
    n = np.array([len(x) for x in sets])
    begin = np.append(0, np.cumsum(n))
    order = np.argsort(np.concatenate(sets), kind="stable")
    values, of = np.concatenate(sets)[order], np.repeat(np.arange(len(sets)), n)[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    sizes = np.diff(starts, append=len(values))
    group = np.empty(len(values), np.int64)
    group[order] = np.repeat(np.arange(len(starts)), sizes)
    now, out = component.copy(), []
    for x in range(len(sets)):
        if (now == now[x]).all():
            break
        g = group[begin[x] : begin[x + 1]]
        each = sizes[g]
        at = np.arange(int(each.sum())) + np.repeat(starts[g] - np.append(0, np.cumsum(each)[:-1]), each)
        common = np.bincount(of[at], minlength=len(sets))
        for y in np.flatnonzero((100 * common >= share * (n[x] + n - common)) & (now != now[x])).tolist():
            if now[y] != now[x]:
                out.append((x, y))
                now[now == now[y]] = now[x]
    return out


def settle(entries: DataFrame, sets: DataFrame, settings: Settings, most: int = 2048, most_bytes: int = 32 << 20) -> DataFrame:
    """Links (a, b) that join the components of the classes in entries (node, class, component), found on full sets. A node of many classes, or large sets,
    is cut into blocks; every two blocks meet in a task."""
    share = round(100 * settings.similarity)
    full = materialise(entries.join(sets, "class"), "unsettled")
    cuts = full.groupBy("node").agg(F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum(F.length("hashes")) / most_bytes)).alias("_cuts"))
    own, other = F.pmod(F.xxhash64("class", F.lit(settings.seed)), "_cuts"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cuts") - 1))
    dealt = full.join(cuts, "node").select("node", "class", "component", "hashes", own.alias("_own"), other.alias("_other"))
    dealt = dealt.select(F.xxhash64("node", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("node"), "class", "component", "hashes")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids, component, held = None, [], [], []

        def close() -> pa.RecordBatch:
            c = np.array(ids, np.int64)
            found = joining(held, np.array(component, np.int64), share) if len(c) > 1 else []
            x, y = c[[i for i, _ in found]], c[[j for _, j in found]]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        for batch in batches:
            for node, i, c, data in zip(*(batch.column(n).to_pylist() for n in ("node", "class", "component", "hashes")), strict=True):
                if node != name:
                    yield close()
                    name, ids, component, held = node, [], [], []
                ids.append(i)
                component.append(c)
                held.append(unpack_set(data))
        yield close()

    return materialise(dealt.repartition(F.xxhash64("node")).sortWithinPartitions("node").mapInArrow(links, EDGE).distinct(), "links")


MARKS, MARK_BITS = 1024, 32_768


def marked(rows: DataFrame, wanted: DataFrame, key: str = "class") -> DataFrame:
    """The rows whose key may be wanted: all that are, and few others while the wanted keys are few beside MARKS * MARK_BITS. Spares the others a
    shuffle with their sets or signatures. What is broadcast are MARKS bitmaps of 4 KB at most, whatever the input."""
    bit = F.pmod(F.xxhash64(key), F.lit(MARKS * MARK_BITS))
    bucket, place = F.shiftright(bit, 15).alias("_bucket"), bit.bitwiseAND(F.lit(MARK_BITS - 1)).alias("_place")
    maps = wanted.select(bucket, place).groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright("_place", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftleft(1, cast(_place & 7 as int))").bitwiseAND(byte) != 0
    return rows.withColumns({"_bucket": bucket, "_place": place}).join(F.broadcast(maps), "_bucket").where(hit).select(*rows.columns)


def full_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """class, hashes: the full set of each wanted class. rows: what `features` gives; rows that can't be wanted aren't shuffled."""
    wanted = materialise(wanted, "wanted")
    own = marked(rows.select("class", "hashes"), wanted).join(wanted, "class", "left_semi")
    return materialise(own.groupBy("class").agg(F.first("hashes").alias("hashes")), "sets")


def _sized(df: DataFrame, rows: int, each: int) -> DataFrame:
    """df in as many tasks as that many rows fill, or in those it has, if fewer: a small table is not written as a file for each shuffle partition."""
    return df.coalesce(rows // each + 1)


def confirm(pairs: DataFrame, sets: DataFrame, settings: Settings, hub: int = 256) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= 100 * similarity * union. Pairs come sorted by a, so its set is read once for some
    `hub` pairs; a class with more pairs is cut into several groups."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / hub).alias("_cuts"))
    cut = pairs.join(degree, "a").withColumn("_cut", F.pmod(F.xxhash64("b"), "_cuts"))
    tasks = cut.join(sets.withColumnRenamed("class", "b"), "b").select("a", "_cut", "b", "hashes")
    groups = cut.select("a", "_cut").distinct()
    heads = groups.join(sets.withColumnRenamed("class", "a"), "a").select("a", "_cut", F.lit(None).cast("long").alias("b"), "hashes")
    share = round(100 * settings.similarity)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            a_, b_ = [], []
            for a, b, data in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "hashes")), strict=True):
                s = unpack_set(data)
                if b is None:
                    mine = s
                    continue
                small, large = (s, mine) if len(s) <= len(mine) else (mine, s)
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if 100 * common >= share * (len(s) + len(mine) - common):
                    a_.append(a)
                    b_.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_, pa.int64()), pa.array(b_, pa.int64())], names=["a", "b"])

    both = tasks.unionByName(heads).repartition(F.xxhash64("a", "_cut")).sortWithinPartitions("a", "_cut", F.col("b").asc_nulls_first())
    return materialise(_sized(both, pairs.count(), 4096).mapInArrow(test, EDGE), "links")


def components(edges: DataFrame, run: int = 500_000) -> DataFrame:
    """v, component (its smallest member) of every vertex of edges (a, b)."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        def out() -> pa.RecordBatch:
            ids = list(parent)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([root(x) for x in ids], pa.int64())], names=["v", "component"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) >= run:
                yield out()
                parent = {}
        yield out()

    n = edges.count()
    found = materialise(_sized(edges.select("a", "b"), n, run).mapInArrow(stars, "v long, component long"), "stars")
    least = materialise(_sized(found.groupBy("v").agg(F.min("component").alias("component"), F.max("component").alias("_other")), 2 * n, run), "centres")
    rest = found.join(least.where("component <> _other").select("v", F.col("component").alias("_low")), "v").where("component <> _low")
    again = materialise(_sized(rest.select(F.col("_low").alias("a"), F.col("component").alias("b")).distinct(), 2 * n, run), "rest")
    label = least.select("v", "component")
    if not again.limit(1).count():
        return label
    deeper = components(again, run).select(F.col("v").alias("component"), F.col("component").alias("_root"))
    return materialise(_sized(label.join(deeper, "component", "left").select("v", F.coalesce("_root", "component").alias("component")), 2 * n, run), "labels")


def class_components(rows: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(class, component) of the linked classes, and (class, rep) of all; rows: what `features` gives."""
    classes = materialise(rows.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("rep"), F.min("sign").alias("sign"), F.min("bits").alias("bits")), "classes")
    release_shuffles(rows.sparkSession)  # signatures and full sets are shuffled in turn; each step's files go before the next writes its own
    entries, tested, links = nodes(classes, rows, settings)
    release_shuffles(rows.sparkSession)
    pairs = materialise(propose(entries, settings).join(tested, ["a", "b"], "left_anti"), "pairs")
    tested = tested.unionByName(pairs)
    release_shuffles(rows.sparkSession)
    # a class without a pair here has none later
    sets = full_sets(rows, tested.select(F.explode(F.array("a", "b")).alias("class")).distinct())
    release_shuffles(rows.sparkSession)
    links = links.unionByName(confirm(pairs, sets, settings))
    release_shuffles(rows.sparkSession)
    label = components(links)
    named = lambda some: some.join(label.withColumnRenamed("v", "class"), "class", "left").withColumn("component", F.coalesce("component", F.col("class")))
    # a node of one component has nothing more to tell; that is found out without signatures
    slim = named(entries.select("node", "class")).groupBy("node").agg((F.min("component") != F.max("component")).alias("_mixed"))
    mixed = materialise(slim.where("_mixed").select("node"), "mixed")
    # without a join by node, which the optimiser would put first, over all signatures; tasks pass over other nodes that are let through
    found = materialise(unsettled(named(marked(entries, mixed, "node")), settings), "found")
    release_shuffles(rows.sparkSession)
    new = settle(found, sets, settings)
    if new.limit(1).count():
        label = components(links.unionByName(new))
    return label.withColumnRenamed("v", "class"), classes.select("class", "rep")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, class, component_id, kept of each row."""
    rows = features(docs, settings)
    with temporary(docs.sparkSession):
        label, classes = class_components(rows, settings)
        named = classes.join(label, "class", "left").withColumn("component", F.coalesce("component", F.col("class")))
        smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
        table = materialise(named.join(smallest, "component").select("class", "component_id"), "components", keep=True)
    out = rows.select("doc_id", "n_shingles", "class").join(table, "class", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", "class", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def near_dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """docs with one row of each group: that of the smallest doc_id (of rows that repeat it with the same set, the one with the smallest text).
    Rows without a set all stay; where no row of a group has a doc_id, one row of each distinct set stays."""
    found = near_duplicates(docs, settings).where("n_shingles > 0 and (kept or component_id is null)")
    names = docs.columns
    own, like, nth, id_ = (free_name(names, n) for n in ("_class", "_kept", "_nth", "_id"))
    kept = found.select(F.col("doc_id").alias(id_), F.col("class").alias(like)).distinct()

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([int.from_bytes(digest(shingles(t, settings.width))[:8], "big", signed=True) for t in as_bytes(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*names, own])

    tagged = docs.mapInArrow(tag, T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())]))
    blank = tagged.where(F.col(own) == 0).select(*names)
    # rows of one doc_id and one set are alike but for their texts' spaces and letter case; equal rows are merged before they are ranked
    joined = tagged.join(kept, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(like)))
    once = joined.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", own).orderBy("text"))).where(F.col(nth) == 1).select(*names)
    return once.unionByName(blank)
