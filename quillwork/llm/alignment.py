"""Operator 11: alignment of two tokenizers, with corpus-wide counts of the id pairs that overlap.

A is a byte-level BPE (tokenizers file), which reads a space and the text; B is a BPE with byte fallback (sentencepiece file), which adds that space.
Byte offsets where tokens of both end cut a text into groups; an A token and a B token are linked where their byte ranges overlap.

Counting: each task keeps distinct packed pairs (B id in the high 32 bits, A id in the low ones) with np.unique and writes these partial counts; a
range-partitioned sort with run-length sums makes them whole, in sorted shards of flat int64 files beside each B id's highest count; tasks then
memory-map the shards and look their pairs up by searchsorted. What grows without bound (texts, pairs) never reaches the driver: it gets one row a
shard and, for each B id of the vocabulary, one count.

Texts are cut in front of white space (and behind a lone line break), where no token of either vocabulary crosses, so that each distinct piece is
encoded and aligned once per process while it is cached; the cache is bounded. Texts with a character for which that can't be promised are aligned
whole.

Edge cases: texts that are null or empty, or that either tokenizer doesn't give back byte for byte, have no tokens: zeros and '' for groups. Repeated
rows count as often as they come. An empty table gives no shards. Other columns are ignored; doc_id may be null."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import materialise, release_memory, scratch
from .token_files import _ids, _open

FIELDS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
#: White space on which the vocabularies may disagree; texts that hold one are aligned whole.
DOUBTFUL = "".join(map(chr, [*range(0x0B, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
PIECE = re.compile(r"\n(?=[^ \t\n])|[ \t\n]*[^ \t\n]+|[ \t\n]+")
CUT = re.compile(r"(?<=[^ \t\n])[ \t\n]")
LOW = np.int64(0xFFFFFFFF)


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the others from 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, the bytes of each of their ids, and where texts may be cut."""

    def __init__(self, a: str, b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        letters, vocab = byte_of_letter(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes, behind, plain = [], set(), True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[1:-1], 16)]))
                continue
            text = piece.replace("▁", " ")
            self.b_bytes.append(text.encode())
            behind |= set(re.findall(r"(?<=\S)\s", text))
            plain &= "\n" not in text
        self.a_size, self.b_size = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        # no piece of B may reach over a cut: none has white space behind another character or holds a line break
        self.cuts = plain and " " not in behind
        self.whole = re.compile("[" + re.escape("".join(set(DOUBTFUL) | behind)) + "]")
        # what B makes of a line break at the start, which stands in front of what is to be encoded without its space
        self.head = len(self.b.encode("\n"))

    def ids_a(self, text: str) -> np.ndarray:
        return np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def ids_b(self, text: str) -> np.ndarray:
        """text begins with the space that B adds by itself (but to nothing), or with another character that stands in place of it."""
        if text[0] == " " and len(text) > 1:
            return np.array(self.b.encode(text[1:]), np.int64)
        return np.array(self.b.encode("\n" + text)[self.head :], np.int64)

    def same(self, ids: np.ndarray, table: list[bytes], text: bytes) -> bool:
        return b"".join([table[i] for i in ids.tolist()]) == text


def align(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of groups, and the packed pair and the end of each link. Each stretch between two neighbouring ends of either kind lies in one token of A and
    one of B, and each overlapping pair has one such stretch."""
    both = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    twice = both[1:] == both[:-1]
    common, both = both[1:][twice], both[np.append(True, ~twice)] if len(both) else both
    pairs = b[np.searchsorted(b_ends, both)] << np.int64(32) | a[np.searchsorted(a_ends, both)]
    return common, pairs, both


def groups_text(ids: np.ndarray, ends: np.ndarray, cuts: np.ndarray, other: np.ndarray, other_ends: np.ndarray) -> tuple[str, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3;`, and where in it each group ends."""
    names, keys = [], []
    for side, (x, at) in enumerate(((ids, ends), (other, other_ends))):
        last = np.isin(at, cuts, assume_unique=True)
        names.append(np.where(last, 2 * side + 1, 2 * side) + 4 * x)
        keys.append(2 * np.searchsorted(cuts, at) + side)
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    text = [_name(n) for n in np.concatenate(names)[order].tolist()]
    sizes = np.cumsum(np.fromiter(map(len, text), np.int64, len(text)))
    return "".join(text), sizes[np.flatnonzero(np.diff(key[order] >> 1, append=-1))]


@cache
def _name(n: int) -> str:
    """An id and what follows it: a comma within a group, a bar behind A's ids, a semicolon behind the group. At most four texts an id."""
    return str(n >> 2) + (",", "|", ",", ";")[n & 3]


class Pieces(dict):
    """Distinct pieces of texts by number; new ones wait in `new` to be learnt."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.known = 0

    def __missing__(self, piece: str) -> int:
        at = self[piece] = self.known + len(self.new)
        self.new.append(piece)
        return at


class Aligner:
    """Alignments of pieces, in one process. Past max_items everything is forgotten (`full`), so memory is bounded; pieces over max_chars are not kept.
    with_groups: texts of groups are made; else the pairs of all pieces stay."""

    def __init__(self, vocabularies: Vocabularies, max_items: int = 600_000, max_chars: int = 48, with_groups: bool = True):
        self.v, self.max_items, self.max_chars, self.with_groups = vocabularies, max_items, max_chars, with_groups
        self.forget()

    def forget(self) -> None:
        self.pieces, self.groups = Pieces(), []
        self.sizes = np.zeros((1024, 5), np.int32)  # n_a, n_b, n_groups, n_links, and whether both give the text back
        self.start = np.zeros(1024, np.int64)  # where a piece's pairs begin
        self.pairs, self.used = np.zeros(1024, np.int64), 0

    def full(self) -> bool:
        return self.pieces.known >= self.max_items

    def numbers(self, text: str) -> np.ndarray:
        """Numbers of the pieces of a text (with its space in front). learn() must follow before they are used."""
        find = self.pieces.__getitem__
        if not self.v.cuts or self.v.whole.search(text):
            return np.array([find(text)], np.int64)
        parts, at = [], 0
        while at < len(text):  # long texts by the million characters
            cut = CUT.search(text, at + 1_000_000) if len(text) - at > 2_000_000 else None
            end = cut.start() if cut else len(text)
            found = PIECE.findall(text, at, end)
            parts.append(np.fromiter(map(find, found), np.int64, len(found)))
            at = end
        return np.concatenate(parts)

    def learn(self) -> np.ndarray:
        """Aligns the new pieces; returns their numbers."""
        new, self.pieces.new = self.pieces.new, []
        first = self.pieces.known
        self.pieces.known += len(new)
        self.sizes, self.start = grown(self.sizes, self.pieces.known), grown(self.start, self.pieces.known)
        if self.with_groups:
            self.groups += [""] * len(new)
            self.used = 0
        # pieces that keep their tokens when others follow are encoded together
        many = [i for i, p in enumerate(new) if len(p) <= self.max_chars and p[-1] not in " \t\n" and "\u2581" not in p]
        alone = set(range(len(new))).difference(many)
        for at in range(0, len(many), 4096):
            some = many[at : at + 4096]
            if not self._together([new[i] for i in some], np.array(some, np.int64) + first):
                alone.update(some)
        for i in alone:
            self._together([new[i]], np.array([first + i]))
            if len(new[i]) > self.max_chars:
                del self.pieces[new[i]]
        return np.arange(first, self.pieces.known)

    def _together(self, pieces: list[str], places: np.ndarray) -> bool:
        """Aligns pieces one after another in one text, a line break between where a piece has no white space in front. False if the tokenizers don't give
        that text back."""
        spaced = [p if len(pieces) == 1 or p[0] in " \t\n" else "\n" + p for p in pieces]
        text = "".join(spaced)
        data = text.encode()
        a, b = self.v.ids_a(text), self.v.ids_b(text)
        if not (self.v.same(a, self.v.a_bytes, data) and self.v.same(b, self.v.b_bytes, data)):
            return False
        a_ends, b_ends = np.cumsum(self.v.a_size[a]), np.cumsum(self.v.b_size[b])
        sizes = np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in spaced), np.int64, len(spaced))
        stops = np.cumsum(sizes)
        starts = stops - sizes + np.fromiter((len(s) - len(p) for s, p in zip(spaced, pieces, strict=True)), np.int64, len(spaced))
        ends, found, at = align(a, a_ends, b, b_ends)
        cuts = np.append(0, ends)
        if not all((cuts[np.searchsorted(cuts, x)] == x).all() for x in (starts, stops)):
            return False
        spans = [(np.searchsorted(x, starts, "right"), np.searchsorted(x, stops, "right")) for x in (a_ends, b_ends, ends, at)]
        for k, (lo, hi) in enumerate(spans):
            self.sizes[places, k] = hi - lo
        self.sizes[places, 4] = 1
        self.pairs = grown(self.pairs, self.used + len(found))
        self.pairs[self.used : self.used + len(found)] = found
        self.start[places] = self.used + spans[3][0]
        self.used += len(found)
        if self.with_groups:
            named, until = groups_text(a, a_ends, ends, b, b_ends)
            until = np.append(0, until)
            for place, lo, hi in zip(places.tolist(), until[spans[2][0]].tolist(), until[spans[2][1]].tolist(), strict=True):
                self.groups[place] = named[lo:hi]
        return True

    def pairs_of(self, places: np.ndarray) -> np.ndarray:
        """The pairs of pieces, one piece after another; with groups, only of those learnt last."""
        n = self.sizes[places, 3].astype(np.int64)
        return self.pairs[np.repeat(self.start[places] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def text_of_groups(self, places: np.ndarray) -> str:
        return "".join([self.groups[i] for i in places.tolist()])[:-1]


def grown(x: np.ndarray, n: int) -> np.ndarray:
    """x with room for n rows."""
    if len(x) >= n:
        return x
    return np.concatenate([x, np.zeros((max(n, 3 * len(x) // 2) - len(x), *x.shape[1:]), x.dtype)])


def texts_of(batches: Iterator[pa.RecordBatch], size: int = 1_500_000) -> Iterator[tuple[list, list]]:
    """doc_ids and texts, some `size` characters at a time; null texts are empty."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            ids.append(doc_id)
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held > size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


_vocabularies: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(paths: tuple[str, str]) -> Vocabularies:
    """Loaded once per process."""
    if paths not in _vocabularies:
        _vocabularies[paths] = Vocabularies(*paths)
    return _vocabularies[paths]


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their n."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[starts], np.add.reduceat(n[order], starts) if len(starts) else n[:0]


def partial_counts(docs: DataFrame, paths: tuple[str, str], max_items: int = 600_000) -> DataFrame:
    """key (packed pair), n: distinct keys of each stretch of a partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabularies(paths), max_items, with_groups=False)
        hits = np.zeros(1024, np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            used = np.flatnonzero(hits[: aligner.pieces.known])
            keys, n = summed(aligner.pairs_of(used), np.repeat(hits[used], aligner.sizes[used, 3]))
            for at in range(0, len(keys), 500_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 500_000]), pa.array(n[at : at + 500_000])], names=["key", "n"])

        for _, texts in texts_of(batches):
            rows = [aligner.numbers(" " + t) for t in texts if t]
            aligner.learn()
            hits = grown(hits, aligner.pieces.known)
            sound = aligner.sizes[:, 4] > 0
            rows = [r for r in rows if sound[r].all()]
            if rows:
                hits[: aligner.pieces.known] += np.bincount(np.concatenate(rows), minlength=aligner.pieces.known)
            if aligner.full():
                yield from flush()
                aligner.forget()
                hits = np.zeros(1024, np.int64)
        yield from flush()
        del aligner
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(count, "key long, n long")


def write_counts(docs: DataFrame, paths: tuple[str, str] | None = None, folder: str | None = None) -> str:
    """Counts all pairs of the corpus into sorted shards; returns the folder (a URI that driver and executors share).

    part-NNNNN.key and .n hold the sorted packed pairs of a shard and their counts as little-endian int64, best.bin the highest count of each B id,
    manifest.json the first key and the size of each shard. Each attempt writes under its own name and renames."""
    spark = docs.sparkSession
    paths, folder = paths or default_vocabularies(), folder or scratch(spark, "pairs")
    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    # written first: the range sort reads its input twice
    partial = materialise(partial_counts(docs, paths), "pair-counts")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        files, base = _open(folder)
        part = f"part-{context.partitionId():05d}"
        own = f"{base}/.{part}-{context.stageId()}-{context.attemptNumber()}-{context.taskAttemptId()}"
        out, first, size, best = None, 0, 0, {}
        held_key, held_n = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the last run, which may go on

        def put(keys: np.ndarray, n: np.ndarray) -> None:
            nonlocal out, first, size
            if not len(keys):
                return
            if out is None:
                out, first = [files.open_output_stream(f"{own}.{kind}") for kind in ("key", "n")], int(keys[0])
            out[0].write(keys.astype("<i8").tobytes())
            out[1].write(n.astype("<i8").tobytes())
            size += len(keys)
            b = keys >> np.int64(32)
            starts = np.flatnonzero(np.diff(b, prepend=-1))
            for i, top in zip(b[starts].tolist(), np.maximum.reduceat(n, starts).tolist(), strict=True):
                best[i] = max(top, best.get(i, 0))

        for batch in batches:
            keys = np.concatenate([held_key, batch.column("key").to_numpy()])
            n = np.concatenate([held_n, batch.column("n").to_numpy()])
            if len(keys):
                starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
                keys, n = keys[starts], np.add.reduceat(n, starts)
                put(keys[:-1], n[:-1])
                held_key, held_n = keys[-1:], n[-1:]
        put(held_key, held_n)
        if out is None:
            return
        for f in out:
            f.close()
        for kind in ("n", "key"):
            files.move(f"{own}.{kind}", f"{base}/{part}.{kind}")
        yield pa.RecordBatch.from_pydict({"file": [part], "first": [first], "size": [size], "b": [np.array(list(best), "<i8").tobytes()], "top": [np.array(list(best.values()), "<i8").tobytes()]})

    ordered = partial.repartitionByRange("key").sortWithinPartitions("key")
    # a row a shard; a B id is in several only where its pairs fill them
    rows = ordered.mapInArrow(shard, "file string, first long, size long, b binary, top binary").collect()
    best = np.zeros(len(vocabularies(paths).b_bytes), "<i8")
    for row in rows:
        np.maximum.at(best, np.frombuffer(row["b"], "<i8"), np.frombuffer(row["top"], "<i8"))
    with system.open_output_stream(f"{root}/best.bin") as f:
        f.write(best.tobytes())
    listed = sorted(({"file": r["file"], "first": r["first"], "size": r["size"]} for r in rows), key=lambda r: r["first"])
    with system.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps({"shards": listed}).encode())
    return folder


class Counts:
    """The counts in a folder of shards, memory-mapped as they are asked for."""

    def __init__(self, folder: str):
        self.files, self.base = _open(folder)
        with self.files.open_input_file(f"{self.base}/manifest.json") as f:
            self.shards = json.loads(f.read())["shards"]
        self.firsts = np.array([s["first"] for s in self.shards], np.int64)
        self.best = _ids(self.files, f"{self.base}/best.bin", "<i8")
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of packed pairs, 0 for such as are in no shard."""
        out = np.zeros(len(pairs), np.int64)
        if not len(self.shards) or not len(pairs):
            return out
        distinct, at = np.unique(pairs, return_inverse=True)
        found = np.zeros(len(distinct), np.int64)
        of = np.searchsorted(self.firsts, distinct, "right") - 1
        for a, b in pairwise([*np.flatnonzero(np.diff(of, prepend=-2)).tolist(), len(of)]):
            s = int(of[a])
            if s < 0:
                continue
            if s not in self.open:
                self.open[s] = tuple(_ids(self.files, f"{self.base}/{self.shards[s]['file']}.{kind}", "<i8") for kind in ("key", "n"))
            keys, n = self.open[s]
            place = np.minimum(np.searchsorted(keys, distinct[a:b]), len(keys) - 1)
            found[a:b] = np.where(keys[place] == distinct[a:b], n[place], 0)
        return found[at]


def read_alignments(docs: DataFrame, folder: str, paths: tuple[str, str] | None = None, max_items: int = 600_000) -> DataFrame:
    """doc_id and FIELDS of each row, by the counts in folder."""
    paths = paths or default_vocabularies()
    names = ["doc_id", *[f.split()[0] for f in FIELDS.split(", ")]]
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in names[1:-1]], (names[-1], pa.string())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, counts = Aligner(vocabularies(paths), max_items), Counts(folder)
        by_piece = np.zeros((1024, 2), np.int64)  # links of the highest count, sum of counts
        for ids, texts in texts_of(batches):
            rows = [aligner.numbers(" " + t) if t else None for t in texts]
            new = aligner.learn()
            pairs, size = aligner.pairs_of(new), aligner.sizes[new, 3]
            n, of = counts.find(pairs), np.repeat(np.arange(len(new)), size)
            by_piece = grown(by_piece, aligner.pieces.known)
            by_piece[new, 0] = np.bincount(of[n == counts.best[pairs >> np.int64(32)]], minlength=len(new))
            np.add.at(by_piece[:, 1], new[of], n)
            out: dict[str, list] = {name: [] for name in names}
            for doc_id, row in zip(ids, rows, strict=True):
                sound = row is not None and bool(aligner.sizes[row, 4].all())
                values = [*aligner.sizes[row, :4].sum(0, np.int64).tolist(), *by_piece[row].sum(0).tolist()] if sound else [0] * 6
                digest = hashlib.sha256(aligner.text_of_groups(row).encode()).hexdigest() if sound else ""
                for name, value in zip(names, (doc_id, *values, digest), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)
            if aligner.full():
                aligner.forget()
                by_piece = np.zeros((1024, 2), np.int64)
        del aligner, counts
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(look, f"doc_id long, {FIELDS}")


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """The alignment of each row of docs (doc_id, text), with counts over all of them."""
    return read_alignments(docs, write_counts(docs, paths), paths)


def pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    """a_id, b_id, n: the shards as a table."""
    system, root = _open(folder)
    with system.open_input_file(f"{root}/manifest.json") as f:
        shards = json.loads(f.read())["shards"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                keys, n = (_ids(files, f"{base}/{name}.{kind}", "<i8") for kind in ("key", "n"))
                for at in range(0, len(keys), 500_000):
                    k = keys[at : at + 500_000]
                    yield pa.RecordBatch.from_arrays([pa.array(k & LOW), pa.array(k >> np.int64(32)), pa.array(np.asarray(n[at : at + 500_000]))], names=["a_id", "b_id", "n"])

    listed = spark.createDataFrame([(s["file"],) for s in shards], "file string").repartition(max(1, len(shards)), "file")
    return listed.mapInArrow(read, "a_id long, b_id long, n long")
