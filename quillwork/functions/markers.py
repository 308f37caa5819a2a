"""Many markers at once (RSH6, STR22-STR24): an Aho-Corasick automaton over Arrow batches finds all of them in one pass of a text, whatever their number."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = re.compile(r"[ \t\n\x0b\f\r]")


@lru_cache(16)
def automaton(markers: tuple[str, ...]):
    """Numbers of the markers (those of equal text together) by their texts."""
    import ahocorasick

    a = ahocorasick.Automaton()
    of: dict[str, list[int]] = {}
    for i, m in enumerate(markers):
        if m:
            of.setdefault(m, []).append(i)
    for m, numbers in of.items():
        a.add_word(m, (len(m), numbers))
    if of:
        a.make_automaton()
    return a


def first_places(text: str, markers: tuple[str, ...]) -> dict[int, int]:
    """Where each marker that occurs begins first, in code points from 0, by its number."""
    a, out = automaton(markers), {}
    if len(a):
        for end, (size, numbers) in a.iter(text):
            for i in numbers:
                out.setdefault(i, end - size + 1)
    return out


def mended(text: str, words: tuple[str, ...]) -> str:
    """text where each word that one white space may break between any two letters is whole, as if word after word were replaced."""
    plain = automaton(tuple(_SPACE.sub("", w) for w in words))
    if not len(plain) or not text:
        return text
    at = [i for i, ch in enumerate(text) if not _SPACE.match(ch)]
    if len(at) == len(text):
        return text
    found: dict[int, list[int]] = {}
    for end, (size, numbers) in plain.iter("".join([text[i] for i in at])):
        # only where a letter follows another behind a gap is there anything to mend
        if at[end] - at[end - size + 1] >= size:
            for i in numbers:
                found.setdefault(i, []).append(end - size + 1)
    gone: set[int] = set()
    for i in sorted(found):
        size, free = len(words[i]), 0
        for begin in found[i]:
            if begin < free:
                continue
            places = at[begin : begin + size]
            gaps = [[k for k in range(p + 1, q) if k not in gone] for p, q in zip(places[:-1], places[1:], strict=True)]
            if all(len(g) <= 1 for g in gaps):
                gone.update(k for g in gaps for k in g)
                free = begin + size
    return "".join([ch for i, ch in enumerate(text) if i not in gone]) if gone else text


def repair(c: Column, words: list[str]) -> Column:
    """STR23: as `text.repair`, in one pass for any number of words (which hold no white space)."""
    given = tuple(words)
    if any(_SPACE.search(w) for w in given):
        raise ValueError("words hold no white space")

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: mended(t, given), na_action="ignore")

    return run(c)


def sections(df: DataFrame, key: str, text: str, markers: list[str]) -> DataFrame:
    """RSH6: as `reshape.sections`, in one pass for any number of markers: key, marker, section, from each marker that occurs to the next one of the
    list that occurs, the last to the end; empty where the next one stands before it."""
    given = tuple(markers)

    @F.pandas_udf("array<struct<marker: string, section: string>>")
    def cut(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[dict]:
            places = sorted(first_places(t or "", given).items())
            ends = [*[at for _, at in places], len(t or "")][1:]
            return [{"marker": given[i], "section": t[at : max(at, end)]} for (i, at), end in zip(places, ends, strict=True)]

        return texts.map(one, na_action=None)

    return df.select(key, F.inline(cut(F.col(text))))
