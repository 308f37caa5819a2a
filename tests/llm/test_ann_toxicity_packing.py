import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillwork.llm import ann, packing, toxicity
from quillwork.llm.tokens import default_tokenizer

from .helpers import awkward, documents, labels


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def truth(rows, every, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def check_ann(got, want, least):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert by.keys() == {q for q, n in want.items() if n}
    hits = total = 0
    for q, near in want.items():
        mine = sorted(by.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(near)
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        hits += len({m[1] for m in mine} & {n[0] for n in near})
        total += len(near)
    assert hits >= least * total


def test_ann_recall(spark, sf):
    vectors = read(spark, sf, "embeddings")
    check_ann(ann.nearest(vectors).collect(), truth([(r.vec_id, r.embedding) for r in vectors.collect()], 20, 20), 0.9)


def test_ann_awkward(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(size=6).tolist()) for i in range(40)] + [(100 + i, [1.0] * 6) for i in range(60)]
    bad = [(1000, None), (1020, [0.0] * 6), (1040, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1060, [float("nan")] * 6), (1080, [float("inf")] + [1.0] * 5), (1100, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>").withColumn("list", F.lit("clash"))
    as_float = [(i, np.array(v, "f4").astype(float).tolist()) for i, v in good]
    small = ann.Settings(k=20, block=16)
    check_ann(ann.nearest(df, settings=small).collect(), truth(as_float, 20, 20), 0.9)
    assert ann.nearest(df.where("false")).count() == 0
    assert ann.nearest(df.where("vec_id = 1000")).count() == 0


def test_ann_norms_and_copies(spark):
    """Vectors of very different norms, most of them copies: every query has its 20 neighbours, and finds most of the true ones."""
    rng = np.random.default_rng(5)
    seeds = rng.normal(size=(40, 8)) * rng.lognormal(0, 1, (40, 1))
    rows = [(i, (seeds[i % 40] if i % 10 else rng.normal(size=8) * rng.lognormal(0, 1)).astype("f4").tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check_ann(ann.nearest(df).collect(), truth([(i, np.array(v, "f4").astype(float).tolist()) for i, v in rows], 20, 20), 0.9)
    few = ann.probes(np.ones((1, 2)), ann.Index(np.eye(2), np.zeros((1, 1, 1)), 1), np.array([3, 50]), np.array([20]))
    assert few[0].tolist() == [0, 1]


def test_ann_queries_unlike_other_rows(spark):
    """Queries that lie apart from the rows that the number of probes is learnt from, and outliers: every true neighbour is found."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(50, 24)) * 4
    x = centres[rng.integers(0, 50, 2000)] + rng.normal(size=(2000, 24)) * 0.2
    x[::20] = rng.normal(size=(100, 24))
    x[7::100] *= 30
    rows = [(i, v.astype("f4").tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check_ann(ann.nearest(df).collect(), truth([(i, np.array(v, "f4").astype(float).tolist()) for i, v in rows], 20, 20), 1.0)


def test_toxicity_held_out(spark, sf):
    docs, marks = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    got = toxicity.toxicity(docs.select("doc_id", "text"), marks).withColumn("held", toxicity.held_out(F.col("doc_id")))
    rows = got.join(marks, "doc_id").where("held").collect()
    assert np.mean([(r.toxicity >= 0.5) == (r.toxic == 1) for r in rows]) > 0.9
    assert got.count() == docs.count()


def test_toxicity_reads_hidden_words(spark):
    words = ["river", "stone", "bridge", "window", "garden", "market", "winter", "summer", "paper", "letter"]
    text = lambda i: " ".join(words[(i * 7 + j * j) % 10] for j in range(12))
    rows = [(i, text(i) + (" moron" if i % 3 == 0 else "")) for i in range(600)]
    hidden = [(9000, text(1) + " m0r0n"), (9001, text(2) + " m o r o n"), (9002, text(3) + " moooron"), (9003, text(4) + " m.o.r.o.n"), (9004, text(5))]
    docs = documents(spark, rows + hidden + [(9005, None), (9006, ""), (9006, "")])
    got = toxicity.toxicity(docs.withColumn("toxicity", F.lit("clash")), labels(spark, [(i, 1, int(i % 3 == 0)) for i in range(600)])).collect()
    score = {r.doc_id: r.toxicity for r in got}
    assert len(got) == 608 and all(0 <= r.toxicity <= 1 for r in got)
    assert all(score[i] > 0.5 for i in range(9000, 9004)) and score[9004] < 0.5 and score[9005] < 0.5 and score[9006] == score[9005]


OBFUSCATED = [
    "m o r o n", "m o r o n.", "(m o r o n)", "m  o  r  o  n", "m\to\tr\to\tn", "s t u p i d m o r o n", "m0r0n,you", "m0 r0n", "m\u00f6r0n", "m*ron", "m.o.r.o.n", "mooorooon", "m-0-r-0-n",
    "mo" + "r" * 45 + "on", "y o u a r e s u c h a w o r t h l e s s m o r o n t o d a y f r i e n d", "m\u00f2ron", "MORON!!", "moorronn", "m0r0n", "m|0|r|0|n",
]


def test_hidden_spellings_are_read(spark):
    """A model of the words of some texts restores a word in each of these spellings."""
    rng = np.random.default_rng(2)
    known = "river stone bridge window garden market winter summer paper letter you are such a worthless today friend stupid moron and the people here".split()
    text = " ".join(rng.choice(known, 4000))
    trigrams = toxicity.letter_trigrams(documents(spark, [(1, text), (2, text)]))
    reader = toxicity.Reader(trigrams, toxicity.Settings())
    want = b"wmoron"
    assert [x for x in OBFUSCATED if want not in reader.features(("river " + x + " stone").encode())] == []
    assert all(want not in reader.features(x.encode()) for x in ("river stone", "2019 12.5", "a b c", "", "more on", "m"))
    assert b"wstupid" in reader.features(b"st*pid") and b"wstupid" in reader.features(b"s t u p i d m o r o n")


@pytest.mark.parametrize("seen", ["m0r0n", "a b", "s*n", "aab", "1.d", "m0 r0", "$-a$", "??", "x!!y"])
def test_viterbi_equals_brute_force(spark, seen):
    import itertools

    trigrams = np.random.default_rng(3).integers(0, 50, (27, 27, 27)).astype(float)
    channel = toxicity.Channel(trigrams)
    best = None
    for way in itertools.product(*channel.columns(seen)):
        cost, state, out = 0.0, 0, ""
        for letter, price in way:
            cost += price
            if letter > 0:
                cost, state, out = cost + channel.cost[state * 27 + letter], state % 27 * 27 + letter, out + chr(letter + 96)
            elif letter < 0 and state:
                cost, state, out = cost + channel.cost[state * 27], 0, out + " "
        cost += channel.cost[state * 27] if state else 0.0
        if best is None or cost < best[0] - 1e-12:
            best = (cost, out.split())
    assert channel.decode(seen) == best[1]


def test_toxicity_labels_of_held_out_rows_are_not_used(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    marks = read(spark, sf, "labels")
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, m).select("doc_id", "toxicity").collect())) for m in (marks, flipped))
    assert a == b


@pytest.mark.parametrize("marks", [[], [(1, 1, 1), (2, 1, None), (None, 1, 1)]])
def test_toxicity_awkward(spark, marks):
    got = toxicity.toxicity(awkward(spark), labels(spark, marks)).collect()
    assert len(got) == 12 and all(0 <= r.toxicity <= 1 for r in got)
    assert toxicity.toxicity(documents(spark, []), labels(spark, marks)).count() == 0


def check_pack(docs, settings=packing.Settings()):
    tok = Tokenizer.from_file(default_tokenizer())
    want = sorted((str(r.doc_id), tuple(tok.encode(r.text or "", add_special_tokens=False).ids) + (2,)) for r in docs.collect())
    got = packing.pack(docs, settings=settings).collect()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == settings.window or at & (at - 1) == 0 and at < settings.window
    by = {}
    for r in got:
        by.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for (doc_id, n), pieces in by.items():
        same = [ids for d, ids in want if d == doc_id and len(ids) == n]
        assert same and sum(p[1] for p in pieces) == n * len(same)
        if len(set(same)) == 1:
            for start, length, crc in pieces:
                assert crc == zlib.crc32(np.array(same[0][start : start + length], "<u4").tobytes())
    assert sum(r.length for r in got) == sum(len(ids) for _, ids in want)


def test_packing(spark, sf):
    check_pack(read(spark, sf, "documents"))
    check_pack(read(spark, sf, "documents").repartition(3), packing.Settings(shard_docs=7))
    check_pack(read(spark, sf, "documents"), packing.Settings(shard_bytes=5000, window=64))


def test_packing_awkward(spark):
    check_pack(awkward(spark))
    assert packing.pack(documents(spark, [])).count() == 0


def brute_bm25(words, corpus, settings, seed):
    """Documents by falling score; words: list of lists of hashes."""
    scores = []
    for d, mine in enumerate(words):
        score = 0.0
        for t in set(words[seed]) & set(mine):
            df = int(corpus.frequency[t >> (64 - 18)])
            tf = mine.count(t)
            score += np.log(1 + (corpus.docs - df + 0.5) / (df + 0.5)) * tf * (settings.k1 + 1) / (tf + settings.k1 * (1 - settings.b + settings.b * len(mine) / corpus.mean))
        scores.append(score)
    return scores


def test_bm25_order_equals_brute_force():
    settings, rng = packing.Settings(), np.random.default_rng(4)
    vocabulary = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    words = [vocabulary[np.minimum(299, rng.geometric(0.02, rng.integers(0, 120)))] for _ in range(60)]
    frequency = np.zeros(1 << 18, np.int32)
    for w in words:
        frequency[np.unique(w >> np.uint64(64 - 18)).astype(int)] += 1
    corpus = packing.Corpus(60, sum(map(len, words)) / 60, frequency)
    index = packing.Shard(words, corpus, settings)
    lists = [[int(x) for x in w] for w in words]
    for seed in range(60):
        want = brute_bm25(lists, corpus, settings, seed)
        got = index.neighbours(seed).tolist()
        assert {d for d in range(60) if want[d] > 0} - {seed} == set(got) - {seed}
        assert all(want[a] >= want[b] - 1e-9 for a, b in zip(got, got[1:], strict=False))


def test_related_documents_meet_from_everywhere(spark):
    """Pairs of documents with words of their own lie far apart in the input; they are packed next to each other."""
    rng = np.random.default_rng(1)
    common = [f"c{i}" for i in range(50)]
    rows = [(i, " ".join([*rng.choice(common, 30), *[f"topic{i % 200}word"] * 6])) for i in range(400)]
    got = packing.pack(documents(spark, rows).repartition(6), settings=packing.Settings(window=256)).collect()
    window = {}
    for r in got:
        window.setdefault(r.doc_id % 200, set()).add(r.sequence_id)
    together = sum(any(a.sequence_id == b.sequence_id for a in by[0] for b in by[1]) for by in ([[r for r in got if r.doc_id == t + 200 * k] for k in (0, 1)] for t in range(200)))
    assert together > 100  # by chance it would be two


@pytest.mark.parametrize("texts", [1, 2, 40])
def test_heaviest_word_of_each_text(texts):
    """Words are counted in one sort; before, by two sorts of two and three columns, most of dealing's time."""
    settings, rng = packing.Settings(), np.random.default_rng(texts)
    vocabulary = rng.integers(0, 1 << 64, 200, dtype=np.uint64)
    words = [vocabulary[np.minimum(199, rng.geometric(0.03, rng.integers(0, 60)))] if i % 7 else vocabulary[:0] for i in range(texts)]
    words[-1] = np.append(vocabulary[5:9], np.uint64(2**64 - 1))
    frequency = np.zeros(1 << 18, np.int32)
    for w in words:
        frequency[np.unique(w >> np.uint64(64 - 18)).astype(int)] += 1
    corpus = packing.Corpus(texts, 30.0, frequency)
    key, last = packing.heaviest_words(np.concatenate(words), np.cumsum([0, *map(len, words)]), corpus, settings)
    for w, k, some in zip(words, key.tolist(), last.tolist(), strict=True):
        weigh = []
        for t in set(w.tolist()):
            df, tf = int(frequency[t >> (64 - 18)]), int((w == t).sum())
            weigh.append((tf / (tf + settings.k1) * float(np.log1p((texts - df + 0.5) / (df + 0.5))) if df > 1 else 0.0, t))
        assert some == bool(weigh) and k == (max(weigh)[1] if weigh else 0)
