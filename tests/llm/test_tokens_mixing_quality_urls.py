import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quillwork.llm import mixing, quality, token_files, url_filter
from quillwork.llm.common import ordered_positions
from quillwork.llm.tokens import Encoder, default_tokenizer

from .helpers import awkward, documents, labels


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_chunked_encoding_equals_whole_text(spark, sf):
    whole, chunked = Tokenizer.from_file(default_tokenizer()), Encoder(default_tokenizer())
    texts = [r.text for r in read(spark, sf, "documents").select("text").collect()]
    texts += ["", " ", "it's  I'LL\tx'sy", "a\u00a0b\u2003c\x1cd\x85e", "e\u0301 \u0301x", "<|endoftext|> a<|startoftext|>b", "ΑΣ ας ΟΔΟΣ", "日本語 12٣4 ½", "İstanbul ẞ ﬁ", "x" * 5000, "HELLO, World! (don't) 'still' Él'an ÑANDÚ... «ça» ªº² µß h\u0331 H\u0331 <|x|> <|endoftext|>, A.B. ...a... ''s \u017f K\u212a"]
    for t in texts:
        assert np.frombuffer(chunked.text(t.encode()), chunked.dtype).tolist() == [*whole.encode(t, add_special_tokens=False).ids, 2]


def brute_tokens(rows):
    tok, at, out = Tokenizer.from_file(default_tokenizer()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("which", ["table", "awkward", "empty"])
def test_token_files_round_trip(spark, sf, which):
    docs = {"table": lambda: read(spark, sf, "documents"), "awkward": lambda: awkward(spark), "empty": lambda: documents(spark, [])}[which]()
    got = [tuple(r) for r in token_files.read_tokens(spark, token_files.write_tokens(docs)).collect()]
    key = lambda r: (r[1], r[0] or 0)
    assert sorted(got, key=key) == sorted(brute_tokens([(r.doc_id, r.text) for r in docs.collect()]), key=key)


def targets(sizes, most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.CYCLE[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = [s for s in order if s not in capped]
        share = (total - sum(most * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in left))
        over = {s for s in left if share * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else share * weight[s] for s in order}
        capped |= over


def check_mix(docs):
    sizes, per = {}, {}
    rows = docs.collect()
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        per.setdefault((r.doc_id, n), []).append(r.source)
    want = targets(sizes)
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(rows)
    taken, largest = {}, {}
    for r in got:
        sources = per[r.doc_id, r["size"]]
        assert any(r.source_size == sizes[s] and r.target == pytest.approx(want[s]) for s in sources)
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r["size"] * r.copies
        s = next(s for s in sources if r.source_size == sizes[s])
        taken[s], largest[s] = taken.get(s, 0) + r.taken, max(largest.get(s, 0), r["size"])
    if len({v for v in sizes.values()}) == len(sizes):
        for s in taken:
            assert abs(taken[s] - want[s]) <= largest[s]
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_report(docs.repartition(3)).collect()))
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)


def test_mixing(spark, sf):
    check_mix(read(spark, sf, "documents"))


def test_mixing_awkward(spark):
    check_mix(awkward(spark))
    assert mixing.mix_report(documents(spark, [])).count() == 0


def test_mixing_caps_and_tree(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 7), "big" if i % 10 else f"s{i % 3}") for i in range(2000)] + [(5000 + i, "tiny words", "a") for i in range(3)])
    check_mix(docs)
    report = mixing.mix_report(docs, block=4).where("source_size = 6").collect()
    assert all(r.taken == 6 for r in report)


def test_ordered_positions(spark):
    df = spark.createDataFrame([(i * 7919 % 1000,) for i in range(1000)], "x long")
    assert all(r.x == r.position for r in ordered_positions(df, "x").collect())


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams, covered = {}, set()
    for i in range(len(words) - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    for at in grams.values():
        if len(at) > 1:
            covered.update(j for i in at for j in range(i, i + 5))
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


@pytest.mark.parametrize("which", ["table", "awkward", "empty"])
def test_quality_counts(spark, sf, which):
    docs = {"table": lambda: read(spark, sf, "documents"), "awkward": lambda: awkward(spark), "empty": lambda: documents(spark, [])}[which]()
    got = quality.quality_rules(docs, read(spark, sf, "labels")).collect()
    want = sorted(str((r.doc_id, *brute_quality(r.text))) for r in docs.collect())
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got) == want
    assert all(r.kept == (not r.base_failed and r.quality_score >= quality.Settings().threshold) for r in got)


def test_quality_learns(spark):
    good, bad = "the river runs over old stones and under a bridge near town number", "BUY!! NOW!! CHEAP!! PILLS!! ONLINE!! CLICK!! HERE!! DEAL!! FREE!! WIN!!"
    docs = documents(spark, [(i, f"{(good, bad)[i % 2]} w{i}") for i in range(400)])
    marks = labels(spark, [(i, 1 - i % 2, 0) for i in range(0, 400, 1) if i % 3])
    got = {r.doc_id: r.kept for r in quality.quality_rules(docs, marks).collect()}
    assert all(got[i] == (i % 2 == 0) for i in range(400))
    assert quality.quality_rules(docs, labels(spark, [])).where("not kept").count() == 0


def brute_url(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h) + len(p) > best[0]):
            best = (len(h) + len(p), h + p, v)
    return host, path, best and best[1], best[2] if best else "allow"


def test_url_filter(spark, sf):
    rules = url_filter.RULES
    deep = [("com", "/", "block"), ("com", "/en/", "allow"), ("com", "/en/7", "block"), ("x.com", "/en/", "block"), ("a.x.com", "", "allow"), ("com", "/en/", "block")]
    urls = [None, "", "no scheme", "http://", "http://COM/en/", "https://A.x.com/en/7?q#f", "ftp://x.com#/en/", "http://xcom/en/", "a://b://com/en/", "http://ex.com/en/\n7", "http://É.example.com/en/7", "//example.com/en/7", "http://example.com/en/7" + "y" * 5000, "http://example.com"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, "http://com/en/")] * 300
    pages = spark.createDataFrame(rows, "page_id long, url string").unionByName(read(spark, sf, "pages").select("page_id", "url"))
    for given in (rules, deep, []):
        got = url_filter.filter_urls(pages, given, sample=64).select("page_id", "host", "path", "rule", "verdict").collect()
        once = list({(h, p): (h, p, v) for h, p, v in sorted(given, reverse=True)}.values())
        want = [(r.page_id, *brute_url(r.url, once)) for r in pages.collect()]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert url_filter.filter_urls(pages.where("false")).count() == 0


def test_new_runs_move_no_ids():
    """What is added lies behind, so learning costs by what is new; before, all ids were put in order again each time."""
    from quillwork.llm.tokens import RunTable

    rng, table, want = np.random.default_rng(6), RunTable(np.dtype("<u2"), 300), {}
    for turn in range(30):
        new = np.setdiff1d(np.unique(rng.integers(0, 1 << 64, 40, dtype=np.uint64)), table.keys)
        values = [rng.integers(0, 60000, rng.integers(0, 5)).astype("<u2").tobytes() for _ in new]
        before, full = table.flat, len(table.keys) > 300
        table.add(new, values)
        want |= zip(new.tolist(), values, strict=True)
        assert full or (table.flat[: len(before)] == before).all()
        assert (np.diff(table.keys.astype(object)) > 0).all() and set(new.tolist()) <= set(table.keys.tolist())
        at, known = table.find(table.keys[turn % 3 :: 3])
        assert known.all()
        assert [table._gather(at[i : i + 1]).tobytes() for i in range(len(at))] == [want[k] for k in table.keys[at].tolist()]
    assert len(table.keys) < 400
