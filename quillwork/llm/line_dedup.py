"""Operator 10: line dedup by a log-template tree.

Lines (cut at newlines) of at least `least_tokens` tokens, by default all but blank ones, go down a tree of fixed depth: number of tokens, then the
leading tokens (a shorter line has its last one again), where a token with a digit is a variable field. Lines of a leaf with more than `crowd` distinct
ones are also dealt to nodes by what stands in bands of their slots, one band more than a template has variable slots, so that all lines of a template
meet in a node, whichever field varies; a node founds `crowd` templates at most, and lines that fit none of them are dealt on by further bands. A leaf's lines are folded into `slots` position-wise hashes (a line with fewer tokens has
each in slots of its own) and matched one after another, in a fixed order, against the leaf's templates: where enough slots agree the line joins the
template, and slots that differ become variable fields; else it founds a template.

A template recurs, and all its lines are dropped, if it is seen in at least `recur` different classes of documents, however many copies a class has
and whatever other lines it shares. A class is a document with its copies, whole or near, transitively; two documents are near copies if they share
`alike` or more of their distinct runs of 5 words, digits being variable. Candidates agree in a band of 4 of `bins` minima of their runs' hashes; pairs
that agree in `sure` of all bins are taken, and those that agree in `maybe` are decided by their sets of runs, which are exact up to `runs` runs and
the `runs` smallest hashes beyond. So lines that only copies share stay (near-dedup drops such documents), and a line that copies share with
unrelated documents, or a block of boilerplate lines, goes.

Everything that is shuffled is a few numbers for each distinct line of a document. A template's classes are counted after (line, class) pairs are made
distinct: a line of `recur` classes decides at once, so only lines of fewer classes meet those of their template, and a line that a third of all
documents hold is no hot group. The decisions depend on the line alone, so the dropped lines are looked up where the text is read: from a table that
is broadcast while it has at most `broadcast` rows, which is checked, and beyond it by a join on the line.

Edge cases: null texts stay null, with 0 lines; blank lines are kept; a document may lose all its lines, and its text is then empty;
repeated rows are copies; a very long line counts like any other; other columns pass through, and n_lines and n_dropped replace columns so named."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MIX1, MIX2, as_bytes, distinct, free_name, hashed_words, materialise, mix64, temporary, windows
from .near_dedup import components

VARIABLE = np.uint64(0x5AFEC0DE5AFEC0DE)  # the hash of a variable field


@dataclass(frozen=True)
class Settings:
    least_tokens: int = 1
    lead: int = 3
    slots: int = 16
    similar: float = 0.75
    recur: int = 3
    crowd: int = 4096
    width: int = 5  # words of a run
    bins: int = 64
    band: int = 4
    alike: float = 0.75
    sure: float = 0.9  # of the bins: 2.8 standard deviations over `alike`
    maybe: float = 0.55  # 3.7 under it
    runs: int = 512
    broadcast: int = 1_000_000


@dataclass
class Lines:
    """The lines of some texts that are long enough, with their text's place, their number in it, leaf and slots; and the hash and text of each token."""

    text: np.ndarray
    number: np.ndarray
    leaf: np.ndarray
    slots: np.ndarray
    token: np.ndarray
    token_text: np.ndarray


def parse(texts: list[bytes], settings: Settings) -> Lines:
    """Many texts at once, by array operations."""
    joined = b"\n".join(texts)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    h, at = hashed_words(joined)
    if not len(h):
        none = np.zeros(0, np.int64)
        return Lines(none, none, np.zeros(0, np.uint64), np.zeros((0, settings.slots), np.uint32), h, none)
    b = np.frombuffer(joined, np.uint8)
    newline = np.flatnonzero(b == 10)
    line = np.searchsorted(newline, at)  # of each token
    first = np.flatnonzero(np.diff(line, prepend=-1))
    n = np.diff(first, append=len(line))
    digit = (b >= 48) & (b <= 57)
    if digit.any():
        h[np.logical_or.reduceat(digit, at)] = VARIABLE
    text_of = np.searchsorted(begin, at, "right") - 1
    token, token_text = h, text_of
    long = n >= settings.least_tokens
    text = text_of[first[long]]
    number = line[first[long]] - np.searchsorted(newline, begin)[text]
    h, n = h[np.repeat(long, n)], n[long]
    start = np.cumsum(n) - n
    leaf = mix64(n.astype(np.uint64) * MIX2)
    for k in range(settings.lead):
        leaf = mix64(leaf * MIX1 + h[start + np.minimum(k, n - 1)])
    cuts = (start[:, None] + np.arange(settings.slots) * n[:, None] // settings.slots).ravel()
    placed = mix64(h + (np.arange(len(h)) - np.repeat(start, n)).astype(np.uint64) * MIX1)
    slots = np.add.reduceat(placed, cuts).reshape(len(n), settings.slots) if len(n) else np.zeros((0, settings.slots), np.uint64)
    return Lines(text, number, leaf, (slots >> np.uint64(32)).astype(np.uint32), token, token_text)


def in_groups(texts: list[bytes | None], size: int = 1 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    """Places and texts of those that are not empty, some `size` bytes at a time."""
    places, group, held = [], [], 0
    for i, text in enumerate(texts):
        if text:
            places.append(i)
            group.append(text)
            held += len(text)
            if held >= size:
                yield places, group
                places, group, held = [], [], 0
    if group:
        yield places, group


def line_keys(leaf: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """One 64-bit key for each line's leaf and slots."""
    key = leaf.copy()
    for j in range(slots.shape[1]):
        key = key * MIX1 + slots[:, j]
        key ^= key >> np.uint64(31)
    return mix64(key)


EMPTY = 0xFFFF


def sketches(token: np.ndarray, text: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of texts given by the hashes of their tokens, in order: which texts have any; the smallest of their runs' hashes in each bin (uint16); and
    their distinct runs (uint32, the smallest `runs`, in order)."""
    edge = np.flatnonzero(np.diff(text, prepend=-1))
    n = np.diff(edge, append=len(text))
    owner, place = text[edge], np.repeat(np.arange(len(edge)), n)
    last = settings.width - 1
    if len(token) > last:
        inside = place[: len(place) - last] == place[last:]
        run, of = windows(token, settings.width)[inside], place[: len(place) - last][inside]
    else:
        run, of = np.zeros(0, np.uint64), place[:0]
    begin = np.cumsum(n) - n
    short = np.flatnonzero(n <= last)
    if len(short):
        run = np.concatenate([run, *(windows(token[begin[i] : begin[i] + n[i]], settings.width) for i in short.tolist())])
        of = np.concatenate([of, short])
    # 24 bits for the text, 40 of the hash
    both = distinct(of.astype(np.uint64) << np.uint64(40) | run >> np.uint64(24))
    of, run = (both >> np.uint64(40)).astype(np.int64), both & np.uint64((1 << 40) - 1)
    bits = settings.bins.bit_length() - 1
    cell = of * settings.bins + (run >> np.uint64(40 - bits)).astype(np.int64)
    low = np.flatnonzero(np.diff(cell, prepend=-1))
    least = np.full(len(owner) * settings.bins, EMPTY, np.uint16)
    least[cell[low]] = np.minimum(run[low] >> np.uint64(24 - bits) & np.uint64(0xFFFF), EMPTY - 1)
    begin = np.searchsorted(of, np.arange(len(owner) + 1))
    short_run = (run >> np.uint64(8)).astype("<u4")
    sets = [short_run[a : min(b, a + settings.runs)].tobytes() for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
    return owner, least.reshape(len(owner), settings.bins), sets


def class_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key for each sketch."""
    return line_keys(np.zeros(len(sketch), np.uint64), sketch)


def shared(x: np.ndarray, y: np.ndarray, settings: Settings) -> bool:
    """Whether two sets of runs agree in `alike` of their union: exactly, or by the smallest `runs` hashes of the union where a set was cut there."""
    both, n = np.unique(np.concatenate([x, y]), return_counts=True)
    if max(len(x), len(y)) >= settings.runs:
        n = n[: settings.runs]
    return 100 * int((n == 2).sum()) >= round(100 * settings.alike) * len(n)


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1] * rows.itemsize), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def near_classes(classes: DataFrame, runs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """v, component of the classes (around, sketch) that have near copies; runs: around, runs of each document. Each class of a band is compared with
    the first and the last of it."""

    def rows_of(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, settings.bins)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = rows_of(batch.column("sketch")).reshape(batch.num_rows, -1, settings.band)
            some = (parts != EMPTY).any(2)
            number = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64) + np.uint64(1), some.shape)[some]
            band = line_keys(mix64(number * MIX2), parts[some])
            at = pa.array(np.nonzero(some)[0])
            yield pa.RecordBatch.from_arrays([pa.array(band.view(np.int64)), batch.column("around").take(at)], names=["band", "around"])

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = rows_of(batch.column("x")), rows_of(batch.column("y"))
            used = ((x != EMPTY) | (y != EMPTY)).sum(1)
            share = ((x == y) & (x != EMPTY)).sum(1) / np.maximum(used, 1)
            # a sketch of few bins says little: those pairs are decided by their sets
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array((share >= settings.sure) & (4 * used >= 3 * settings.bins))], names=["a", "b", "sure"])
            yield out.filter(pa.array((share >= settings.maybe) | (2 * used < settings.bins)))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
            keep = [shared(np.frombuffer(p, "<u4"), np.frombuffer(q, "<u4"), settings) for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        side = lambda k, v: table.select(F.col("around").alias(k), F.col(column).alias(v))
        return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")

    bands = materialise(classes.select("around", "sketch").mapInArrow(cut, "band long, around long"), "bands")
    ends = materialise(bands.groupBy("band").agg(F.min("around").alias("low"), F.max("around").alias("high")).where("low < high"), "ends")
    pairs = bands.join(ends, "band").select("around", F.explode(F.array("low", "high")).alias("end")).where("around <> end")
    pairs = pairs.select(F.least("around", "end").alias("a"), F.greatest("around", "end").alias("b")).distinct()
    near = materialise(with_both(pairs, classes, "sketch").mapInArrow(estimate, "a long, b long, sure boolean"), "near")
    links = near.where("sure").select("a", "b")
    label = components(links)
    # only pairs that nothing surer has joined need their sets
    of = lambda k: label.select(F.col("v").alias(k), F.col("component").alias(f"of_{k}"))
    grey = near.where("not sure").join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    grey = materialise(grey, "grey")
    if not grey.limit(1).count():
        return label
    wanted = grey.select(F.explode(F.array("a", "b")).alias("around")).distinct()
    if wanted.count() <= settings.broadcast:
        wanted = F.broadcast(wanted)  # so that only the sets that are wanted are shuffled
    # the least of equal sketches' sets, so that a rerun decides alike; written, since both sides of the pairs read it
    sets = materialise(runs.join(wanted, "around", "left_semi").groupBy("around").agg(F.min("runs").alias("runs")), "sets")
    more = materialise(with_both(grey, sets, "runs").mapInArrow(decide, "a long, b long"), "links")
    return components(links.unionByName(more))


class Templates:
    """The templates of a node, to which its lines come one after another. At most `most` are founded; a line that fits none is then left over (-1)."""

    def __init__(self, width: int, similar: float, most: int | None):
        self.similar, self.most, self.width = similar, most, width
        self.known, self.fixed, self.kept = np.zeros((16, width), np.uint32), np.ones((16, width), bool), np.full(16, width)
        self.count = 0

    def place(self, row: np.ndarray) -> int:
        n = self.count
        if n:
            kept = self.kept[:n]
            same = ((self.known[:n] == row) & self.fixed[:n]).sum(1) / np.maximum(1, kept) * (2 * kept >= self.width)
            best = int(np.argmax(same))
            if same[best] >= self.similar:
                self.fixed[best] &= self.known[best] == row
                self.kept[best] = self.fixed[best].sum()
                return best
        if self.most is not None and n >= self.most:
            return -1
        if n == len(self.known):
            self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            self.fixed, self.kept = np.concatenate([self.fixed, np.ones_like(self.fixed)]), np.concatenate([self.kept, np.full(n, self.width)])
        self.known[n] = row
        self.count += 1
        return n


def bands(used: int, settings: Settings) -> list[list[int]]:
    """The slots that a node's lines don't share by its making, in one band more than a template has variable slots, so that all of a template's lines
    agree in one band at least; none where no band would be left."""
    rest = [j for j in range(settings.slots) if not used >> j & 1]
    variable = settings.slots - int(np.ceil(settings.similar * settings.slots))
    return [b.tolist() for b in np.array_split(np.array(rest, np.int64), variable + 1)] if len(rest) > variable else []


PLACED = "key long, node long, used int, slots binary"


def split_nodes(rows: DataFrame, settings: Settings) -> DataFrame:
    """Rows (PLACED), each in as many nodes as its node has bands: lines that agree in a band meet."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            used, node = batch.column("used").to_numpy(), batch.column("node").to_numpy().view(np.uint64)
            slots = np.frombuffer(b"".join(batch.column("slots").to_pylist()), np.uint32).reshape(-1, settings.slots)
            for mask in np.unique(used).tolist():
                at = np.flatnonzero(used == mask)
                for k, band in enumerate(bands(mask, settings)):
                    below = line_keys(mix64(node[at] * MIX2 + np.uint64(k + 1)), slots[at][:, band])
                    now = np.full(len(at), mask | sum(1 << j for j in band), np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at)), pa.array(below.view(np.int64)), pa.array(now), batch.column("slots").take(pa.array(at))], names=["key", "node", "used", "slots"])

    return rows.select("key", "node", "used", "slots").mapInArrow(split, PLACED)


def leaves(lines: DataFrame, settings: Settings) -> DataFrame:
    """lines (key, leaf, slots), distinct, as PLACED: a node is a leaf, or of a leaf of more than `crowd` lines those that agree in a band."""
    crowded = materialise(lines.groupBy("leaf").count().where(F.col("count") > settings.crowd).select("leaf"), "crowded")
    rows = lines.select("key", F.col("leaf").alias("node"), F.lit(0).alias("used"), "slots")
    crowded = crowded.withColumnRenamed("leaf", "node")
    if crowded.isEmpty():
        return rows
    return rows.join(crowded, "node", "left_anti").select(*rows.columns).unionByName(split_nodes(rows.join(crowded, "node", "left_semi"), settings))


def matched_templates(lines: DataFrame, settings: Settings) -> DataFrame:
    """key, node, template of lines (key, leaf, slots): nodes in order, each line against the templates of its node, of which a node holds `crowd` at
    most; lines that fit none of so many go to nodes of a further band, and so on until all have their templates."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, known = None, None
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int32)
            rows = np.frombuffer(b"".join(batch.column("slots").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            for i, (of, used) in enumerate(zip(batch.column("node").to_pylist(), batch.column("used").to_pylist(), strict=True)):
                if of != node:
                    node, known = of, Templates(settings.slots, settings.similar, settings.crowd if bands(used, settings) else None)
                found[i] = known.place(rows[i])
            left = pa.array(found < 0)
            slots = pa.array([s if o else None for s, o in zip(batch.column("slots").to_pylist(), left.to_pylist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("node"), batch.column("used"), slots, pa.array(found)], names=["key", "node", "used", "slots", "template"])

    placed, out = leaves(lines, settings), None
    while True:
        got = placed.repartition(F.xxhash64("node")).sortWithinPartitions("node", "key").mapInArrow(match, f"{PLACED}, template int")
        got = materialise(got, "templates")
        fit = got.where("template >= 0").select("key", "node", "template")
        out = fit if out is None else out.unionByName(fit)
        if got.where("template < 0").isEmpty():
            return out
        placed = split_nodes(got.where("template < 0"), settings)


def recurring(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """key (long) of each line that belongs to a recurring template; all other tables are removed again."""
    with temporary(docs.sparkSession):
        return materialise(_recurring(docs, settings), "recurring", keep=True)


def _recurring(docs: DataFrame, settings: Settings) -> DataFrame:

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each distinct line of each document, and one (key is null) with its sketch and runs."""
        for batch in batches:
            for _, texts in in_groups(as_bytes(batch.column("text"))):
                got = parse(texts, settings)
                if not len(got.token):
                    continue
                owner, sketch, sets = sketches(got.token, got.token_text, settings)
                around = class_keys(sketch)
                key = line_keys(got.leaf, got.slots)
                order = np.lexsort((key, got.text))
                once = order[(np.diff(key[order], prepend=~key[order[:1]]) != 0) | (np.diff(got.text[order], prepend=-1) != 0)] if len(order) else order
                m, n = len(once), len(owner)
                of = around[np.searchsorted(owner, got.text[once])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([key[once], np.zeros(n, np.uint64)]).view(np.int64), mask=np.arange(m + n) >= m),
                    pa.array(np.concatenate([got.leaf[once], np.zeros(n, np.uint64)]).view(np.int64)),
                    pa.concat_arrays([_binary(got.slots[once]), _binary(sketch)]),
                    pa.array(np.concatenate([of, around]).view(np.int64)),
                    pa.concat_arrays([pa.nulls(m, pa.binary()), pa.array(sets, pa.binary())]),
                ], names=["key", "leaf", "slots", "around", "runs"])

    seen = materialise(docs.select("text").mapInArrow(emit, "key long, leaf long, slots binary, around long, runs binary"), "lines")
    sketched = seen.where("key is null")
    classes = materialise(sketched.groupBy("around").agg(F.min("slots").alias("sketch")), "classes")
    rows = seen.where("key is not null").select("key", "leaf", "slots", "around")
    # only leaves with enough rows can hold a recurring template
    per = rows.select("leaf", "key").distinct()
    busy_leaves = rows.groupBy("leaf").count().where(F.col("count") >= settings.recur).select("leaf")
    busy = per.join(busy_leaves, "leaf", "left_semi").select("key")
    some = materialise(rows.join(busy, "key", "left_semi"), "rows")

    matched = matched_templates(materialise(some.groupBy("leaf", "key").agg(F.min("slots").alias("slots")), "distinct"), settings)
    near = near_classes(classes, sketched.select("around", "runs"), settings).withColumnRenamed("v", "around")
    pairs = some.select("key", "around").join(near, "around", "left").select("key", F.coalesce("component", "around").alias("class")).distinct()
    pairs = materialise(pairs, "pairs")
    # the number of classes of each line, then what is known of each template by its lines alone
    counted = materialise(matched.join(pairs.groupBy("key").agg(F.count("*").alias("n")), "key"), "counted")
    known = counted.groupBy("node", "template").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
    at_once = known.where(F.col("most") >= settings.recur).select("node", "template")
    open_ = known.where((F.col("most") < settings.recur) & (F.col("all") >= settings.recur)).select("node", "template")
    # each line here has fewer than `recur` classes
    classes_of = pairs.join(counted.select("key", "node", "template").join(open_, ["node", "template"]), "key").select("node", "template", "class").distinct()
    together = classes_of.groupBy("node", "template").count().where(F.col("count") >= settings.recur).select("node", "template")
    kept = at_once.unionByName(together)
    return matched.join(kept, ["node", "template"]).select("key").distinct()


def _without(text: bytes, gone: set[int]) -> bytes:
    return b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone)


def _result(docs: DataFrame) -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])


def _with_texts(batch: pa.RecordBatch, names: list[str], texts: list[bytes | None], n_gone: list[int]) -> pa.RecordBatch:
    """The batch with new texts, n_lines of the old ones and n_dropped."""
    old = batch.column("text")
    n_lines = [t.count(b"\n") + 1 if t else 0 for t in as_bytes(old)]
    new = pa.array(texts, pa.binary()).cast(old.type) if any(n_gone) else old
    columns = [new if name == "text" else batch.column(name) for name in names]
    return pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64())], names=[*names, "n_lines", "n_dropped"])


def drop_lines(docs: DataFrame, keys: DataFrame, settings: Settings = Settings()) -> DataFrame:
    docs = docs.drop("n_lines", "n_dropped")
    if keys.limit(settings.broadcast + 1).count() > settings.broadcast:
        return _drop_by_join(docs, keys, settings)
    dropped = np.sort(keys.toArrow().column("key").to_numpy().view(np.uint64))
    names = docs.columns

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            n_gone = [0] * len(texts)
            for places, group in in_groups(texts) if len(dropped) else ():
                got = parse(group, settings)
                key = line_keys(got.leaf, got.slots)
                hit = dropped[np.minimum(np.searchsorted(dropped, key), len(dropped) - 1)] == key
                of, number = got.text[hit], got.number[hit]
                for i, gone in _by(of, number):
                    texts[places[i]] = _without(group[i], gone)
                    n_gone[places[i]] = len(gone)
            yield _with_texts(batch, names, texts, n_gone)

    return docs.mapInArrow(drop, _result(docs))


def _by(of: np.ndarray, number: np.ndarray) -> Iterator[tuple[int, set[int]]]:
    """Numbers by owner; owners come in order."""
    cuts = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(of[a]), set(number[a:b].tolist())


def _drop_by_join(docs: DataFrame, keys: DataFrame, settings: Settings) -> DataFrame:
    """The same, where the dropped lines are too many for a broadcast: numbers of lines meet their keys in a join, and go back to their rows."""
    names = docs.columns
    row, gone = free_name(names, "_row"), free_name(names, "_gone")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "rows")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, group in in_groups(as_bytes(batch.column("text"))):
                got = parse(group, settings)
                owner = batch.column(row).take(pa.array(np.array(places)[got.text]))
                yield pa.RecordBatch.from_arrays([owner, pa.array(got.number), pa.array(line_keys(got.leaf, got.slots).view(np.int64))], names=["row", "line", "key"])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = as_bytes(batch.column("text")), []
            for i, lines in enumerate(batch.column(gone).to_pylist()):
                if lines:
                    texts[i] = _without(texts[i], set(lines))
                out.append(len(lines or ()))
            yield _with_texts(batch, names, texts, out)

    lines = materialise(rows.select(row, "text").mapInArrow(explode, "row long, line long, key long"), "numbers")
    hits = lines.join(keys.distinct(), "key", "left_semi").groupBy("row").agg(F.collect_list("line").alias(gone))  # at most the lines of one text
    joined = rows.join(hits, rows[row] == hits["row"], "left").select(*names, gone)
    return joined.mapInArrow(drop, _result(docs))


def dedup_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """docs with the lines of recurring templates dropped from text, and n_lines and n_dropped."""
    return drop_lines(docs, recurring(docs, settings), settings)


def dedup_texts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """docs with the lines of recurring templates dropped from text, all columns as they were, but for n_chars, the length of a text that has changed."""
    names, apart = docs.columns, {n: free_name(docs.columns, f"{n}_") for n in ("n_lines", "n_dropped") if n in docs.columns}
    out = dedup_lines(docs.withColumnsRenamed(apart), settings)
    if "n_chars" in names:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars")))
    return out.drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in apart.items()}).select(*names)
