"""Scalar text functions as Column expressions (STR1-STR24)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PUNCTUATION = "\",.:;'()"
ACCENTS = ("ÁÉÍÓÚáéíóúÜüÑñ", "AEIOUaeiouUuNn")


def strip(c: Column) -> Column:
    """STR2: trims all Unicode white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """STR4: the group of the first match, null where there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def words(c: Column) -> Column:
    """STR8: white-space split without empty pieces."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def rsplit(c: Column, n: int) -> Column:
    """STR8: split at single spaces from the right, n times at most."""
    parts = F.split(c, " ")
    head = F.greatest(F.size(parts) - n, F.lit(1))
    return F.concat(F.array(F.array_join(F.slice(parts, F.lit(1), head), " ")), F.slice(parts, head + 1, F.greatest(F.size(parts) - head, F.lit(0))))


def without_punctuation(c: Column) -> Column:
    """STR11: removes `" , . : ; ' ( )`; hyphens stay."""
    return F.translate(c, PUNCTUATION, "")


def ascii_letters(c: Column) -> Column:
    """STR12: Spanish letters to ASCII, and the degree sign to `deg`; `latin.latin_to_ascii` does all Latin letters."""
    return F.replace(F.translate(c, *ACCENTS), F.lit("°"), F.lit("deg"))


def after(c: Column, marker: str) -> Column:
    """STR10: what follows the first marker; null without one."""
    at = F.locate(marker, c)
    return F.when(at > 0, F.substring(c, at + len(marker), F.length(c)))


def between(c: Column, start: str, end: str) -> Column:
    """STR10: what lies between the first start and the first end behind it."""
    rest = after(c, start)
    at = F.locate(end, rest)
    return F.when(at > 0, F.substring(rest, F.lit(1), at - 1))


def leading_int(c: Column) -> Column:
    """STR13: the int in the first 3, else 2, else 1 characters."""
    tries = [F.left(c, F.lit(k)).try_cast("int") for k in (3, 2, 1)]
    return F.coalesce(*tries)


def spaced_number(c: Column) -> Column:
    """STR14: the first number with white space on either side; null without one."""
    return extract(c, r"(?<=\s)(\d+)(?=\s)").try_cast("long")


#: STR16: canonical conflict types, in the order in which they are tried (fixed values).
CONFLICT_TYPES = (
    (r"^por asuntos? de gobierno local|^asuntos? de gobierno local", "Asuntos de gobierno local"),
    (r"^por asuntos? de gobierno regional|^asuntos? de gobiern(os)? regional|^asuntos? de gobiernos regional|^asuntos? de gobierno regional", "Asuntos de gobierno regional"),
    (r"^asuntos? de gobierno nacional", "Asuntos de gobierno nacional"),
    (r"^cultivo ilegal de hoja de coca", "Cultivo ilegal de hoja de coca"),
    (r"^demarcación territorial", "Demarcación territorial"),
    (r"^socioambiental", "Socioambiental"),
)
#: STR22: type names of report records, in the order in which they are tried (fixed values).
RECORD_TYPES = (
    "Socioambiental", "Asuntos de gobierno nacional", "Asuntos de gobierno regional", "Asuntos de gobierno local", "Asunto de gobierno nacional",
    "Asunto de gobierno regional", "Asunto de gobierno local", "Comunal", "Otros asuntos", "Laboral", "Demarcacion territorial",
    "Cultivo ilegal de hoja de coca", "Asuntos de Gobiernos Regional", "Asuntos de Gobierno Local", "Asuntos de Gobiernos Nacional",
    "Tipo otros asuntos", "Demarcacion Territorial", "Por asuntos de gobierno local", "Por asuntos de gobierno nacional", "Por asuntos de gobierno regional",
)


def conflict_type(c: Column) -> Column:
    """STR16: the label of the first pattern that fits, else the text itself; lower case."""
    out = None
    for pattern, label in CONFLICT_TYPES:
        hit = c.rlike("(?iu)" + pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lower(out.otherwise(c))


#: STR19: words behind whose dot a sentence goes on, beside single letters and numbers.
ABBREVIATIONS = ("dr", "dra", "sr", "sra", "srta", "ing", "lic", "prof", "gral", "art", "av", "aprox", "dpto", "prov", "dist", "núm", "nro", "pág", "ej", "mr", "mrs", "ms", "st", "vs", "etc", "no", "vol", "fig")
_CLOSE = r"[\"'\])}>»”’]"


def token_rules(abbreviations: tuple[str, ...] = ABBREVIATIONS) -> list[tuple[str, str]]:
    """STR19: the rewrites that put white space between tokens, in order: patterns without look-around, and replacements in which {n} is a group. They
    follow the well-known treebank conventions: a dot is a token of its own only where a sentence ends, commas and colons stay within numbers, opening
    and closing double quotes become `` and '', contractions are cut. Texts have a space at both ends."""
    words_ = "|".join(map(re.escape, abbreviations))
    held = (rf"(?i)(\s[(\"']?(?:{words_}|\pL|\d+))\.(\s+[^\s])", "{1}\x02{2}")
    return [
        (r"[\x01\x02]", " "),
        held,  # twice, since neighbours share a character
        held,
        (rf"([^\s.])\.({_CLOSE}*)(\s)", "{1} . {2}{3}"),
        ("\x02", "."),
        (r"([«“‘„]|`+)", " {1} "),
        (r"([\s(\[{<])(?:\"|'')", "{1} `` "),
        (r"(?i)(\s)'([a-ce-lo-ru-z0-9_])(\s)", "{1}' {2}{3}"),
        (r"([:,])([^\d])", " {1} {2}"),
        (r"(\.\.+)", " {1} "),
        (r"([;@#$%&?!*\[\](){}<>])", " {1} "),
        (r"([^'])'(\s)", "{1} '{2}"),
        (r"(--)", " {1} "),
        (r"([»”’])", " {1} "),
        (r"(?:''|\")", " '' "),
        (r"(?i)([^'\s])('s|'m|'d|'ll|'re|'ve|n't)(\s)", "{1} {2}{3}"),
        (r"(?i)\b(can)(not)\b", " {1} {2} "),
        (r"(?i)\b(d)('ye)\b", " {1} {2} "),
        (r"(?i)\b(gim|lem)(me)\b", " {1} {2} "),
        (r"(?i)\b(gon|wan)(na)\b", " {1} {2} "),
        (r"(?i)\b(got)(ta)\b", " {1} {2} "),
        (r"(?i)\b(more)('n)\b", " {1} {2} "),
        (r"(?i)(\s)('t)(is|was)\b", "{1}{2} {3}"),
    ]


def tokens(c: Column, abbreviations: tuple[str, ...] = ABBREVIATIONS) -> Column:
    """STR19: the words and marks of a text, by `token_rules` in the JVM; null for null."""
    c = F.concat(F.lit(" "), c, F.lit(" "))
    for pattern, by in token_rules(abbreviations):
        c = F.regexp_replace(c, pattern, re.sub(r"\{(\d)\}", r"$\1", by))
    return words(c)


def tokens_without(c: Column, stop: list[str]) -> Column:
    """STR19: tokens of the text in lower case, stop words left out."""
    found = tokens(F.lower(c))
    return F.filter(found, lambda t: ~t.isin(*stop)) if stop else found


def clean_text(c: Column, stop: list[str]) -> Column:
    return F.array_join(tokens_without(c, stop), " ")


def clean_tokens(c: Column, stop: list[str]) -> Column:
    """STR20: punctuation out, split, lower case, stop words out; repeats stay."""
    found = F.transform(words(without_punctuation(c)), F.lower)
    return F.filter(found, lambda t: ~t.isin(*stop)) if stop else found


def loose(word: str) -> str:
    """STR22, STR23: a pattern for a word that may be broken by white space between any two letters; linear time."""
    return r"\s?".join(re.escape(ch) for ch in word)


def scattered(word: str) -> str:
    """STR22: a pattern for a line that holds the letters of word in order, whatever lies between them. Each step goes to the next such letter and
    never back, so it takes linear time."""
    return "(?dm)^" + "".join(f"[^{re.escape(ch)}\\n]*+{re.escape(ch)}" for ch in word) + "[^\\n]*+"


def record_type(c: Column, types: tuple[str, ...] = RECORD_TYPES) -> Column:
    """STR22: each line that holds the letters of a type in order becomes that type, type after type."""
    for t in types:
        c = F.regexp_replace(c, scattered(t), t)
    return c


def repair(c: Column, words_: list[str]) -> Column:
    """STR23: words broken by an inserted space become whole."""
    for w in words_:
        c = F.regexp_replace(c, loose(w), w)
    return c


def section(c: Column, start: str, end: str) -> Column:
    """STR24: the shortest text between two markers, which may be broken by white space; null without both."""
    return extract(c, f"(?s){loose(start)}(.*?){loose(end)}")


def format_text(template: str, **columns: Column) -> Column:
    """STR7: a template with {name} places; null if any part is null."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[columns[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p])


def not_prefixed(c: Column, prefixes: list[str]) -> Column:
    """FLT10: true where c begins with none of the prefixes."""
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | c.startswith(p)
    return ~hit
