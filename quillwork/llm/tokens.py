"""Exact tokenization by cached pieces.

The tokenizer drops white space, never joins text across it, lower-cases, and cuts where letters meet other characters. So the ids of a text are those of
its runs of letters and of other characters, one after another. Texts of ASCII and Latin-1 letters are cut into such runs by array operations, many
texts at a time; each distinct run is encoded once per process, new runs of letters many at a time, and ids are put together by array operations.
Texts with anything that this would cut wrongly (an apostrophe before a letter, a special token's mark, other scripts) go chunk by chunk, where a
chunk is what lies between white space. A test compares both with encoding whole texts."""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np

from .common import LOWER_BYTES, WHITE, hashed_runs

END_ID = 2
MARKS = string.punctuation.encode()
#: What sends a text the slower way: bytes outside ASCII and the letters of Latin-1, an apostrophe before a letter, the start of a special token.
#: By first byte: 1 always; 2 to 4 if the second byte is one of its row.
_FIRST = np.zeros(256, np.uint8)
_FIRST[0xC2:] = 1
_FIRST[[0xC3, ord("'"), ord("<")]] = (2, 3, 4)
_SECOND = np.zeros((5, 256), bool)
_SECOND[1] = True
_SECOND[2, [0x97, 0xB7]] = True
_SECOND[3, list(string.ascii_letters.encode()) + [0xC3]] = True
_SECOND[4, ord("|")] = True
_KIND = np.full(256, 2, np.uint8)  # 0 white space, 1 letter, 2 other
_KIND[list(WHITE)] = 0
_KIND[list(b"abcdefghijklmnopqrstuvwxyz") + list(range(0x80, 0x100))] = 1


def slower_places(text: bytes) -> np.ndarray:
    """Where text has something that the array operations would cut wrongly."""
    b = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(_FIRST[b])
    after = b[np.minimum(at + 1, len(b) - 1)] * (at + 1 < len(b)) if len(at) else at
    return at[_SECOND[_FIRST[b[at]], after]]


class RunTable:
    """Ids of runs by their hashes, in sorted arrays. Past max_items only what was used since the last such turn stays, so memory is bounded."""

    def __init__(self, dtype: np.dtype, max_items: int):
        self.dtype, self.max_items = dtype, max_items
        self._set(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, dtype))

    def _set(self, keys: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """flat holds the ids in the order of keys; those that come later lie behind, so that new keys move no ids."""
        self.keys, self.size, self.flat, self.used, self.place = keys, size, flat, np.zeros(len(keys), bool), np.cumsum(size) - size

    def _gather(self, at: np.ndarray) -> np.ndarray:
        n = self.size[at]
        return self.flat[np.repeat(self.place[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys: their places, and which of them are known."""
        at = np.searchsorted(self.keys, keys)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        self.used[at[known]] = True
        return at, known

    def add(self, keys: np.ndarray, values: list[bytes]) -> None:
        """New keys, sorted, with their ids."""
        size = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        if len(self.keys) > self.max_items:
            old = np.flatnonzero(self.used)
            old = old if len(old) <= self.max_items // 2 else old[:0]
            self._set(self.keys[old], self.size[old], self._gather(old))
        at = np.searchsorted(self.keys, keys)
        merged = np.ones(len(self.keys) + len(keys), bool)
        merged[at + np.arange(len(keys))] = False  # where new ones come

        def merge(old: np.ndarray, new: np.ndarray | bool) -> np.ndarray:
            both = np.empty(len(merged), old.dtype)
            both[merged], both[~merged] = old, new
            return both

        self.keys, self.size, self.used = merge(self.keys, keys), merge(self.size, size), merge(self.used, True)
        self.place = merge(self.place, len(self.flat) + np.cumsum(size) - size)
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(values), self.dtype)])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of a text as little-endian bytes: 16 bits an id where the vocabulary allows it, else 32."""

    def __init__(self, path: str, max_items: int = 200_000, max_bytes: int = 48):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a run of letters
        self.closes[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.max_items, self.max_bytes = max_items, max_bytes
        # what was used since the last turn, and before: a full table becomes the old one, so what is frequent stays and memory is bounded
        self.chunks: dict[bytes, bytes] = {}
        self.old_chunks: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {b"": b""}
        self.old_pieces: dict[bytes, bytes] = {}
        self.runs = RunTable(self.dtype, 5 * max_items)  # some 40 bytes each

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _core(self, chunk: bytes) -> tuple[bytes, bytes] | None:
        """The chunk in lower case, and its letters; None if the chunk has another form than marks, letters, marks."""
        if chunk.isascii():
            low = chunk.lower()
            core = low.strip(MARKS)
            return (low, core) if core.isalpha() else None
        text = chunk.decode()
        if max(text) > "\xff":
            return None
        text = text.lower()
        core = text.strip(string.punctuation)
        return (text.encode(), core.encode()) if core.isalpha() else None

    def _learn(self, missing: set[bytes]) -> None:
        chunks, old, pieces, new = self.chunks, self.old_chunks, self.pieces, []
        if len(pieces) > self.max_items:
            self.old_pieces, self.pieces = pieces, {b"": b""}
            pieces = self.pieces
        for chunk in missing:
            if chunk in old:
                chunks[chunk] = old[chunk]
                continue
            cut = self._core(chunk) if len(chunk) <= self.max_bytes else None
            if cut is None:
                chunks[chunk] = self._ids(chunk.decode()).tobytes()
                continue
            low, core = cut
            if len(low) == len(core):
                before = after = b""
            else:
                at = low.index(core)
                before, after = low[:at], low[at + len(core) :]
                if b"'" in before or b"<|" in before:
                    chunks[chunk] = self._ids(chunk.decode()).tobytes()
                    continue
                for mark in (before, after):
                    if mark not in pieces:
                        pieces[mark] = self._ids(mark.decode()).tobytes()
            if core in pieces:
                chunks[chunk] = pieces[before] + pieces[core] + pieces[after]
            elif core in self.old_pieces:
                pieces[core] = self.old_pieces[core]
                chunks[chunk] = pieces[before] + pieces[core] + pieces[after]
            else:
                new.append((chunk, before, core, after))
        if new:
            self._encode(list({core for _, _, core, _ in new}))
            for chunk, before, core, after in new:
                chunks[chunk] = pieces[before] + pieces[core] + pieces[after]

    def _encode(self, cores: list[bytes]) -> None:
        self.pieces |= zip(cores, self._each(cores), strict=True)

    def _each(self, cores: list[bytes]) -> list[bytes]:
        """Ids of runs of letters; each run's last id is one that closes a run."""
        ids = self._ids(b" ".join(cores).decode())
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(cores):
            return [self._ids(core.decode()).tobytes() for core in cores]
        data, cuts = ids.tobytes(), (ends * self.dtype.itemsize).tolist()
        return [data[i:j] for i, j in zip([0, *cuts[:-1]], cuts, strict=True)]

    def batch(self, texts: list[bytes | None], end_id: int = END_ID, group: int = 1_500_000) -> Iterator[bytes]:
        """Ids of each text, in order; some `group` bytes are worked on at a time."""
        waiting: list[bytes] = []
        held = 0
        for text in texts:
            waiting.append(text or b"")
            held += len(waiting[-1])
            if held >= group:
                yield from self._group(waiting, end_id, group)
                waiting, held = [], 0
        yield from self._group(waiting, end_id, group)

    def _group(self, texts: list[bytes], end_id: int, group: int) -> list[bytes]:
        end, out = self.dtype.type(end_id).tobytes(), [b""] * len(texts)
        plain = []
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        slower = set((np.searchsorted(begin, slower_places(b"\n".join(texts)), "right") - 1).tolist())
        for i, text in enumerate(texts):
            if i in slower:
                out[i] = b"".join(data for part in _parts(text, group) for data in self._flush([part.split()])) + end
            elif len(text) > 2 * group:
                out[i] = b"".join(self._plain([part])[0] for part in _parts(text, group)) + end
            else:
                plain.append(i)
        if plain:
            for i, data in zip(plain, self._plain([texts[i] for i in plain]), strict=True):
                out[i] = data + end
        return out

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        joined = b"\n".join(texts).translate(LOWER_BYTES)
        hashes, starts, ends, kinds = hashed_runs(joined, _KIND)
        if not len(hashes):
            return [b""] * len(texts)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at, known = self.runs.find(distinct)
        if not known.all():
            new = np.flatnonzero(~known)
            i = first[new]
            values, letters = [], []
            for a, b, kind in zip(starts[i].tolist(), ends[i].tolist(), kinds[i].tolist(), strict=True):
                run = joined[a:b]
                if kind == 2:
                    values.append(self._ids(run.decode()).tobytes())
                else:
                    letters.append(run if run.isascii() else run.decode().lower().encode())
                    values.append(None)
            encoded = iter(self._each(letters) if letters else ())
            values = [next(encoded) if v is None else v for v in values]
            # what the table gives up to make room may be among the known ones: their ids are read first
            held = self.runs._gather(at[known]), self.runs.size[at[known]]
            self.runs.add(distinct[new], values)
            size = np.zeros(len(distinct), np.int64)
            size[known], size[new] = held[1], [len(v) // self.dtype.itemsize for v in values]
            flat = np.concatenate([held[0], np.frombuffer(b"".join(values), self.dtype)])
            place = np.zeros(len(distinct), np.int64)
            place[known] = np.cumsum(held[1]) - held[1]
            place[new] = len(held[0]) + np.cumsum(size[new]) - size[new]
        else:
            flat, place, size = self.runs.flat, self.runs.place[at], self.runs.size[at]
        n = size[inverse]
        ids = flat[np.repeat(place[inverse] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        cuts = np.append(0, np.cumsum(n))[np.searchsorted(starts, begin)].tolist()
        return [ids[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def _flush(self, waiting: list[list[bytes]]) -> Iterator[bytes]:
        if len(self.chunks) > self.max_items:
            self.old_chunks, self.chunks = self.chunks, {}
        missing = set().union(*waiting).difference(self.chunks)
        if missing:
            self._learn(missing)
        find = self.chunks.__getitem__
        for words in waiting:
            yield b"".join(map(find, words))
        for chunk in missing:
            if len(chunk) > self.max_bytes:
                del self.chunks[chunk]

    def text(self, text: bytes | None, end_id: int = END_ID) -> bytes:
        return next(self.batch([text], end_id))


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts of about `size` bytes, cut at white space."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and text[end] not in WHITE:
            end += 1
        yield text[at:end]
        at = end


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def crc_u32(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
