"""Element paths over pages."""

import pytest

from quillwork.sources import readers
from quillwork.sources.markup import find_all, path

PAGE = """<html><body><section id="other"><a href="/no">no</a></section>
<section id="search-page" class="wide main"><span class="text"><a href="/1">one &amp; <b>two</b></a></span><br><ul><li><a href='/2'>three</a><li><a>no href</a></ul><img src="x"/></section>
<div class="card-body"><a href="/r1"><h5> Reporte de conflictos 12 de <i>2 </i></h5>tail</a><p>a<p>b</div><div class="card-body extra"><a href="/r2"><h5>Reporte de conflictos 13</h5></a></div>
<div class="card-body"><p>no link</p></div><div class="card-body"></div></body></html>"""


def hrefs(scope, **more):
    return [r["href"] for r in find_all(PAGE, scope, {"href": ("", "@href")}, **more)]


def test_scopes():
    assert hrefs("section#search-page a") == ["/1", "/2", None] and hrefs("section#search-page a[href]") == ["/1", "/2"]
    assert hrefs("section a", first=True) == ["/no"] and hrefs("section.main.wide > span > a") == ["/1"] and hrefs("section > a") == ["/no"]
    assert hrefs("[class=card-body] > a:nth-child(1)") == ["/r1"] and hrefs(".card-body > a") == ["/r1", "/r2"] and hrefs("body section li a[href]") == ["/2"]
    assert hrefs("nothing") == [] and find_all(None, "a", {"href": ("", "@href")}) == []


def test_fields():
    got = find_all(PAGE, ".card-body", {"lead": ("> :nth-child(1) > :nth-child(1)", "lead"), "all": ("> *", "text"), "href": ("> a", "@href"), "second": ("p:nth-child(3)", "text")})
    assert got[0] == {"lead": "Reporte de conflictos 12 de", "all": "Reporte de conflictos 12 de 2 tail", "href": "/r1", "second": "b"}
    assert got[1]["lead"] == "Reporte de conflictos 13" and got[2] == {"lead": None, "all": "no link", "href": None, "second": None} and set(got[3].values()) == {None}
    nested = "<div class='x'>a<div class='x'>b</div>c</div>"
    assert [r["t"] for r in find_all(nested, ".x", {"t": ("", "text")})] == ["abc", "b"]


def test_unclosed_and_stray_tags():
    assert [r["t"] for r in find_all("<p>a<p>b</i></p>c<td>d<td>e", "p", {"t": ("", "text")})] == ["a", "b"]
    assert [r["t"] for r in find_all("<div><b><i>x</div>y", "div", {"t": ("", "text")})] == ["x"]


def test_wrong_paths():
    for wrong in ("a:first", "a..b", "#"):
        with pytest.raises(ValueError, match="no step"):
            path(wrong)


def test_cards_and_sections(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "id int, html string")
    assert [tuple(r) for r in readers.report_links(pages, "id", "html").collect()] == [(1, 12, "Reporte de conflictos 12 de", "/r1")]
    assert [tuple(r) for r in readers.section_links(pages, "id", "html").collect()] == [(1, 0, "one & two", "/1"), (1, 1, "three", "/2")]
