"""STR12: Latin letters and common marks to ASCII in the JVM, by tables that the Unicode data give."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters and marks without a decomposition, as they are usually written (fixed values).
WRITTEN = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "ẞ": "SS", "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d", "Đ": "D", "đ": "d", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l",
    "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "k", "Ŋ": "NG", "ŋ": "ng", "Ŧ": "T", "ŧ": "t", "ƒ": "f", "Ə": "A", "ə": "a", "°": "deg", "‘": "'", "’": "'", "“": '"', "”": '"',
    "„": '"', "«": "<<", "»": ">>", "–": "-", "—": "--", "¡": "!", "¿": "?", "€": "EUR", "£": "PS", "×": "x", "÷": "/", "·": "*", "•": "*",
}


@cache
def tables() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that become one ASCII character, and those that become several: WRITTEN, and what the compatibility decomposition of a Latin letter,
    number form or space leaves of it without combining marks."""
    one, several = {}, {}
    for code in (c for block in (range(0xA0, 0x250), range(0x1E00, 0x1F00), range(0x2000, 0x2070), range(0x2070, 0x20A0), range(0x2100, 0x2190), range(0xFB00, 0xFB07), range(0xFF01, 0xFF5F)) for c in block):
        ch = chr(code)
        plain = "".join(WRITTEN.get(x, x) for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x)).replace("⁄", "/")
        if ch in WRITTEN:
            plain = WRITTEN[ch]
        if plain and plain != ch and plain.isascii():
            (one if len(plain) == 1 else several)[ch] = plain
    return one, several


def latin_to_ascii(c: Column) -> Column:
    """Letters with marks, ligatures and common signs become ASCII; combining marks go; other scripts stay."""
    one, several = tables()
    c = F.regexp_replace(c, r"\p{M}+", "")
    c = F.translate(c, "".join(one), "".join(one.values()))
    long = c
    for ch, plain in several.items():
        long = F.replace(long, F.lit(ch), F.lit(plain))
    return F.when(c.rlike("[" + "".join(several) + "]"), long).otherwise(c)
