"""Operators 11 to 13 against brute force and on held-out rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillwork.llm import alignment, language, queries, variants
from quillwork.llm.common import UPPER

from .helpers import awkward, documents, with_clashes


# --- 11
def brute_alignment(texts):
    """Whole texts, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = alignment.default_vocabularies()
    ta, tb = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    ta.encode_special_tokens = True
    letters, inverse = alignment.byte_of_letter(), {i: t for t, i in ta.get_vocab(with_added_tokens=True).items()}
    rows = []
    for text in texts:
        if not text:
            rows.append(None)
            continue
        a, b = ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)
        a_bytes = [bytes(letters[c] for c in inverse[i]) for i in a]
        b_bytes = [bytes([int(tb.id_to_piece(i)[1:-1], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            rows.append(None)
            continue
        ends_a, ends_b = list(itertools.accumulate(map(len, a_bytes))), list(itertools.accumulate(map(len, b_bytes)))
        links, i, j = [], 0, 0
        groups, ga, gb = [], [], []
        for k, (x, e) in enumerate(zip(a, ends_a, strict=True)):
            start = e - len(a_bytes[k])
            links += [(x, y) for y, f, d in zip(b, ends_b, b_bytes, strict=True) if f - len(d) < e and start < f]
        cuts = sorted(set(ends_a) & set(ends_b))
        for c in cuts:
            while i < len(a) and ends_a[i] <= c:
                ga.append(a[i])
                i += 1
            while j < len(b) and ends_b[j] <= c:
                gb.append(b[j])
                j += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            ga, gb = [], []
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    count = Counter(p for r in rows if r for p in r[3])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(n, best.get(y, 0))
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n = [count[p] for p in r[3]]
            out.append((*r[:3], len(n), sum(c == best[p[1]] for c, p in zip(n, r[3], strict=True)), sum(n), hashlib.sha256(r[4].encode()).hexdigest()))
    return out, count


ODD = [
    "a\nb", "a\n\nb  c\n", "  two in front", "tab\tand\r\nreturn", "no\xa0break 　 wide", "x<s>y <0x0A> <|endoftext|> </s> <unk>", "low▁line", "don't 'tis I'll",
    "\xe9 é ﬁ ① 漢字 \U0001f600", " ", "\n", "\t", "end \n ", "a\x1c b", "{\r\n}", "1234567 12,5", "\u0000 nul", "x" * 3000, "ab " * 700,
    "\n\n\nlines\n \n", "zero​width ﻿", "᠎ m", "\x85 next",
]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_is_that_of_whole_texts(spark, sf):
    given_ = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").orderBy(F.length("text")).limit(60).collect()]
    texts = [None, "", *ODD, *given_, *given_[:5]]
    expected, count = brute_alignment(texts)
    docs = with_clashes(documents(spark, list(enumerate(texts)))).repartition(5)
    folder = alignment.write_counts(docs)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.read_alignments(docs, folder).collect()}
    for i, text in enumerate(texts):
        assert got[i] == expected[i], text
    table = {(r["a_id"], r["b_id"]): r["n"] for r in alignment.pair_counts(spark, folder).collect()}
    assert table == dict(count)


def test_alignment_does_not_depend_on_the_cache(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    paths = alignment.default_vocabularies()
    counted = [alignment.partial_counts(docs, paths, n).groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").toPandas() for n in (300, 300_000)]
    assert counted[0].equals(counted[1])
    folder = alignment.write_counts(docs, paths)
    a, b = (alignment.read_alignments(docs, folder, paths, n).orderBy("doc_id").toPandas() for n in (300, 300_000))
    assert a.equals(b)


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(" \n\tab'é \r.1▁{漢"), max_size=30))
def test_pieces_give_the_tokens_of_the_text(text):
    v = alignment.vocabularies(alignment.default_vocabularies())
    aligner = alignment.Aligner(v)
    whole = " " + text
    numbers = aligner.numbers(whole)
    aligner.learn()
    a, b = v.ids_a(whole), v.ids_b(whole)
    sound = v.same(a, v.a_bytes, whole.encode()) and v.same(b, v.b_bytes, whole.encode())
    assert bool(aligner.sizes[numbers, 4].all()) == sound
    if sound:
        alone = alignment.Aligner(v)
        alone.pieces[whole]
        alone.learn()
        assert aligner.text_of_groups(numbers) == alone.text_of_groups(np.array([0]))


def test_alignment_of_awkward_rows(spark):
    got = alignment.alignments(awkward(spark)).collect()
    assert len(got) == awkward(spark).count()
    assert {r["n_a"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert alignment.alignments(documents(spark, [])).count() == 0
    assert alignment.alignments(documents(spark, [(1, None), (2, "")])).where("n_links > 0 or groups_sha256 <> ''").count() == 0


# --- 12
def brute_words(rows):
    """word -> n of (doc_id, text) rows."""
    count = Counter()
    low = str.maketrans(UPPER, UPPER.lower())
    for doc_id, text in rows:
        for run in re.findall("[a-z\xc0-\xff]+", (text or "").translate(low)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def variant_rows(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def crowd(seed):
    """Words in dense families: every letter of one place, chains of counts, equal letters, endings and beginnings, some very long."""
    rng = np.random.default_rng(seed)
    letters = list("abcdeñéÿ")
    words = {"aaaaa", "aaaaaa", "aaaaaaa", "abababab", "babababa", "ababababa", "x" * 5000, "x" * 4999 + "y", "x" * 5001, "ÀÀÀÀÀ".lower(), "ÀÀÀÀÀ"}
    words |= {"kolmer" + c for c in "abcdefghijklmnop"} | {c + "kolmer" for c in "abcdefghijklmnop"}
    words |= {"".join(rng.choice(letters, n)) for n in rng.integers(5, 8, 500)}
    return [(w, int(rng.integers(3, 60))) for w in sorted(words)] + [("chaina", 3), ("chainb", 7), ("chainbc", 20), ("chainbcd", 50), ("chainbcde", 200)]


@pytest.mark.parametrize("most", [3, 256])
def test_variants_of_crowded_words(spark, most):
    given_ = dict(crowd(5))
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(given_.items())] + [(None, "nullid nullid nullid"), (-1, None), (-2, "")]
    words = brute_words(rows)
    docs = with_clashes(documents(spark, rows)).repartition(4)
    assert {r["word"]: r["n"] for r in variants.word_counts(docs).collect()} == words
    assert variant_rows(variants.variants(docs, most)) == brute_variants(words)


def test_variants_of_hot_grams(spark, monkeypatch):
    given_ = {w: n for w, n in crowd(6) if len(w) < 100}
    words = spark.createDataFrame(list(given_.items()), "word string, n long").repartition(5)
    expected = {w: [v for v in given_ if one_edit(w, v)] for w in given_}
    expected = {(w, len(vs), *min((-given_[v], v) for v in vs)) for w, vs in expected.items() if vs}
    monkeypatch.setattr(variants, "HOT_LEAST", 5)
    got = variants.nearest(words, 8, share=1e-9).collect()
    assert {(r["word"], r["n_near"], -r["best_n"], r["best"]) for r in got} == expected


def test_variants_are_those_of_the_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert variant_rows(queries.op12_variants(spark, sf)) == set(con.execute(queries.OP12).fetchall())


def test_variants_of_awkward_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    assert variant_rows(variants.variants(awkward(spark))) == brute_variants(brute_words(rows))
    assert variants.variants(documents(spark, [])).count() == 0


# --- 13
def test_languages_of_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet")
    got = queries.op13_language(spark, f"{sf}/../sf0.01").toPandas().set_index("doc_id")
    true = docs.select("doc_id", "text", "lang").toPandas().set_index("doc_id")
    assert len(got) == len(true) and got["score"].between(0, 1).all()
    for doc_id, held in got["held_out"].items():
        assert held == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
    held = got[got["held_out"] & (got["lang_pred"] != "und")]
    assert (held["lang_pred"] == true["lang"][held.index]).mean() > 0.98
    no_letter = true["text"].map(lambda t: not any(map(str.isalpha, t or "")))
    assert ((got["lang_pred"] == "und") == no_letter[got.index]).all()


def test_held_out_rows_are_not_learnt_from(spark, sf):
    """Another lang or text in held-out rows changes no prediction of the others."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    changed = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (language.languages(d).orderBy("doc_id").toPandas() for d in (docs, changed))
    assert a.equals(b)


@settings(max_examples=40, deadline=None)
@given(st.text(st.sampled_from("abÉé \n1.-ñ漢İß"), max_size=40), st.sampled_from([1, 2, 3, 7, 500_000]))
def test_counts_of_n_grams(text, block):
    """Against a plain way, whatever the blocks of long texts."""
    low = re.sub(r"[^a-zéñ漢ßi\u0307]+", " ", "".join(c if c.isalpha() else " " for c in text.lower()))
    low = " " + low.strip() + " "
    grams = Counter(low[i : i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1))
    before, language.BLOCK = language.BLOCK, block
    found = language.counts(text, 16)
    language.BLOCK = before
    if not low.strip():
        assert found is None
        return
    expected = Counter()
    for g, n in grams.items():
        codes = np.array([ord(c) for c in g], np.uint32)
        expected[int(language._columns(codes, 16)[-1])] += n
    assert dict(zip(found[0].tolist(), found[1].tolist(), strict=True)) == dict(expected)


def test_follow_the_leader_against_a_plain_way():
    """Row by row and coordinate by coordinate, as the method is published."""
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(3)), np.sort(rng.choice(12, 4, replace=False)), rng.random(4).astype(np.float32)) for _ in range(60)]
    s = language.Settings(passes=2, l1=0.6, l2=0.1)
    got, bias = language.follow_leader(rows, 3, 12, s)
    z, n = np.zeros((13, 3)), np.zeros((13, 3))

    def weight(i, k):
        l1, l2 = (s.l1, s.l2) if i < 12 else (0, 0)
        return 0.0 if abs(z[i, k]) <= l1 else -(z[i, k] - np.sign(z[i, k]) * l1) / ((s.beta + n[i, k] ** 0.5) / s.alpha + l2)

    for _ in range(2):
        for y, columns, x in rows:
            values = [*zip(columns.tolist(), x.tolist(), strict=True), (12, 1.0)]
            scores = np.array([sum(v * weight(i, k) for i, v in values) for k in range(3)])
            p = np.exp(scores) / np.exp(scores).sum()
            w = {(i, k): weight(i, k) for i, _ in values for k in range(3)}
            for i, v in values:
                for k in range(3):
                    g = (p[k] - (y == k)) * v
                    z[i, k] += g - ((n[i, k] + g * g) ** 0.5 - n[i, k] ** 0.5) / s.alpha * w[i, k]
                    n[i, k] += g * g
    expected = np.array([[weight(i, k) for k in range(3)] for i in range(13)])
    assert np.allclose(got, expected[:-1], atol=1e-5) and np.allclose(bias, expected[-1])
    assert (got == 0).any() and (got != 0).any()


def test_temperature_calibrates():
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 3000)
    z = rng.normal(size=(3000, 3)) + 1.5 * np.eye(3)[y]
    t = language.fit_temperature(8 * z, y)
    p = language.softmax(8 * z / t)
    assert abs(p.max(1).mean() - (p.argmax(1) == y).mean()) < 0.03 and language.fit_temperature(z[:5], y[:5]) == 1.0


def test_the_sample_is_bounded(spark):
    """A repeated row, or a doc_id of many rows, brings no more rows than the parameter says."""
    one, other = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    rows = [(one, "the same text again and again")] * 3000 + [(other, f"word{'abcdefghij'[i % 10]} number {'xyz'[i % 3] * (i % 40)} of one id") for i in range(3000)]
    docs = documents(spark, rows)
    names, drawn = language.sample(docs.select("doc_id", "text", "lang"), language.Settings(per_language=20))
    assert names == ["en"] and 0 < len(drawn) <= 20


def test_languages_of_awkward_rows(spark):
    got = language.languages(with_clashes(awkward(spark))).collect()
    assert len(got) == awkward(spark).count() and {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 10)} == {"und"}
    assert {r["lang_pred"] for r in got} <= {"und", "en"}
    assert language.languages(documents(spark, [])).count() == 0
    nothing = documents(spark, [(1, "letters here"), (None, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in language.languages(nothing).collect()} == {("und", 0.0)}
