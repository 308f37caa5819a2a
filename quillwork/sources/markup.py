"""Values from chosen places of HTML pages (SRC10, SRC12): a matcher of element paths over the events of a parser, which reads a page once and keeps
only the open elements.

A path is made of steps between which ` ` stands for any depth and `>` for a child: `section#search-page a`, `.card-body > a:nth-child(1)`. A step is a
tag or `*`, then any of `#id`, `.class`, `[attribute]`, `[attribute=value]`, `:nth-child(n)`. An element without a content (`br`, `img`) is a child, too;
`p`, `li`, `td`, `th`, `tr`, `dt`, `dd` and `option` end an open one of their kind beside them, and an end tag ends what is open inside."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ALONE = {"p", "li", "td", "th", "tr", "dt", "dd", "option"}
_STEP = re.compile(r"(?P<tag>[A-Za-z][\w-]*|\*)|#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?:=\"?(?P<value>[^\]\"]*)\"?)?\]|:nth-child\((?P<nth>\d+)\)")


@dataclass
class Step:
    child: bool  # of the step before; else at any depth below it
    tag: str = "*"
    nth: int | None = None
    attributes: list[tuple[str, str | None]] = field(default_factory=list)
    classes: list[str] = field(default_factory=list)

    def fits(self, e: Element) -> bool:
        if self.tag not in ("*", e.tag) or self.nth not in (None, e.nth):
            return False
        if any(a not in e.attributes or (v is not None and e.attributes[a] != v) for a, v in self.attributes):
            return False
        return not self.classes or set(self.classes) <= set((e.attributes.get("class") or "").split())


@dataclass
class Element:
    tag: str
    attributes: dict[str, str | None]
    nth: int
    children: int = 0


def path(text: str) -> list[Step]:
    """The steps of a path; an empty one has none."""
    steps: list[Step] = []
    child = False
    for part in re.findall(r">|[^\s>]+", text):
        if part == ">":
            child = True
            continue
        step, at = Step(child), 0
        while at < len(part):
            m = _STEP.match(part, at)
            if not m:
                raise ValueError(f"no step of a path: {part}")
            at = m.end()
            if m["tag"]:
                step.tag = m["tag"].lower()
            elif m["id"]:
                step.attributes.append(("id", m["id"]))
            elif m["cls"]:
                step.classes.append(m["cls"])
            elif m["attr"]:
                step.attributes.append((m["attr"].lower(), m["value"]))
            else:
                step.nth = int(m["nth"])
        steps.append(step)
        child = False
    return steps


def matches(steps: list[Step], elements: list[Element]) -> bool:
    """Whether the last of nested elements ends the path; the first step may be any depth below the first element, or it if it is to be a child."""
    if not steps:
        return not elements
    if not elements or not steps[-1].fits(elements[-1]):
        return False
    if len(steps) == 1:
        return len(elements) == 1 or not steps[0].child
    if steps[-1].child:
        return matches(steps[:-1], elements[:-1])
    return any(matches(steps[:-1], elements[:k]) for k in range(len(elements) - 1, 0, -1))


class _Matcher(HTMLParser):
    def __init__(self, scope: list[Step], fields: dict[str, tuple[list[Step], str]], first: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.scope, self.fields, self.first = scope, fields, first
        self.open: list[Element] = []
        self.top = Element("", {}, 0)
        self.found: list[dict] = []
        self.scopes: list[tuple[int, dict]] = []  # depth and values of each open scope
        self.texts: list[tuple[int, dict, str, bool]] = []  # depth, values, name, and whether only what leads is wanted

    def handle_starttag(self, tag, attrs):
        if tag in ALONE and self.open and self.open[-1].tag == tag:
            self._close()
        parent = self.open[-1] if self.open else self.top
        parent.children += 1
        e = Element(tag, {k: v for k, v in reversed(attrs)}, parent.children)
        self.texts = [t for t in self.texts if not t[3]]
        self.open.append(e)
        if (not self.first or not self.found) and matches(self.scope, self.open):
            values: dict = {}
            self.found.append(values)
            self.scopes.append((len(self.open), values))
        for depth, values in self.scopes:
            inside = self.open[depth:]
            for name, (steps, what) in self.fields.items():
                if name not in values and matches(steps, inside):
                    if what.startswith("@"):
                        values[name] = e.attributes.get(what[1:])
                    else:
                        values[name] = ""
                        self.texts.append((len(self.open), values, name, what == "lead"))
        if tag in VOID:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close()

    def _close(self) -> None:
        depth = len(self.open)
        self.open.pop()
        self.scopes = [s for s in self.scopes if s[0] < depth]
        self.texts = [t for t in self.texts if t[0] < depth]

    def handle_endtag(self, tag):
        if any(e.tag == tag for e in self.open):
            while self.open[-1].tag != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        for _, values, name, _ in self.texts:
            values[name] += data


def find_all(html: str | None, scope: str, fields: dict[str, tuple[str, str]], first: bool = False) -> list[dict]:
    """The values of fields for each element that scope leads to, in order of their starts (with first, of the first one alone).

    fields: name -> (path below the element, or '' for itself; what: 'text', 'lead' for the text before any child, or '@attribute'), of the first
    element that fits; None where none does. White space in texts is single and not at the ends."""
    m = _Matcher(path(scope), {n: (path(p), what) for n, (p, what) in fields.items()}, first)
    m.feed(html or "")
    m.close()
    is_text = {n: not what.startswith("@") for n, (_, what) in fields.items()}
    return [{n: " ".join(v[n].split()) if is_text[n] and v.get(n) is not None else v.get(n) for n in fields} for v in m.found]


def elements(html: Column, scope: str, fields: dict[str, tuple[str, str]], first: bool = False) -> Column:
    """`find_all` on a column: an array of structs of fields; empty for null."""
    for p in [scope, *(p for p, _ in fields.values())]:
        path(p)
    kind = ", ".join(f"{n}: string" for n in fields)

    @F.pandas_udf(f"array<struct<{kind}>>")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda html: find_all(html, scope, fields, first), na_action=None)

    return read(html)
