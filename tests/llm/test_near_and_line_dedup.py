import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.llm import line_dedup, near_dedup

from .helpers import awkward, documents


def brute_sets(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    """rows: (doc_id, text) -> sorted (doc_id, n, component, kept)."""
    sets = [brute_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        if not sets[i]:
            least = doc_id
        else:
            least = min((rows[j][0] for j in range(len(rows)) if sets[j] and root(j) == root(i) and rows[j][0] is not None), default=None)
        out.append((doc_id, len(sets[i]), least, doc_id is not None and doc_id == least))
    return sorted(map(str, out))


def answer(docs, **settings):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in near_dedup.near_duplicates(docs, near_dedup.Settings(**settings)).collect())


def mutated(seed, n=12, copies=9):
    rng = random.Random(seed)
    rows = []
    for g in range(n):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(60 + 20 * g)]
        for c in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append((g * 100 + c, " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("settings", [{}, {"small": 6}, {"small": 4, "large": 12}])
def test_components_equal_brute_force(spark, settings):
    rows = mutated(4) + [(5000, "Aa bB c"), (5001, "aa BB C"), (5002, "one two three four FIVE"), (5003, "one two three four five")]
    assert answer(documents(spark, rows), **settings) == brute_components(rows)


def test_table_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert answer(docs) == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward(spark):
    docs = awkward(spark).unionByName(documents(spark, [(None, "null id text here with seven words"), (77, "tie"), (None, "alone with null id")]))
    assert answer(docs) == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    kept = near_dedup.near_dedup(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("tie") == 1 and texts.count("alone with null id") == 1 and texts.count("one two three") == 1 and texts.count(None) == 2
    assert answer(documents(spark, [])) == []


def test_near_dedup_keeps_one_of_each_group(spark):
    rows = mutated(9)
    docs = documents(spark, rows)
    want = {s.split(",")[0][1:] for s in brute_components(rows) if s.endswith("True)")}
    assert {str(r.doc_id) for r in near_dedup.near_dedup(docs).collect()} == want


def test_marked_rows_hold_all_that_are_wanted(spark):
    rows = spark.range(-4000, 4000).selectExpr("xxhash64(id) as class", "id")
    wanted = rows.where("id % 5 = 0").select("class")
    got = {r.id for r in near_dedup.marked(rows, wanted).collect()}
    assert got >= set(range(-4000, 4000, 5)) and len(got) < 1650
    assert near_dedup.marked(rows, wanted.limit(0)).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000 + i, 1001 + i) for i in range(0, 40, 2)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.v: r.component for r in near_dedup.components(df, run=5).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 + i - i % 2 for i in range(40))


def test_classes_linked_with_one_member_of_a_family(spark):
    """Texts that are linked with a single member each of a family that fills a large node."""
    base = [f"w{i}" for i in range(200)]

    def changed(*places):
        return " ".join(f"x{p}" if p in places else w for p, w in enumerate(base))

    members = [(1 + i, changed(3 * i + 5)) for i in range(60)]
    apart = [(100 + i, changed(3 * i + 5, *[(3 * i + 5 + 33 * k) % 190 + 4 for k in range(1, 6)])) for i in range(0, 60, 3)]
    rows = [(0, " ".join(base)), *members, *apart]
    want = brute_components(rows)
    assert answer(documents(spark, rows), small=4, large=12) == want
    assert answer(documents(spark, rows), small=16, large=40) == want


def test_settle_gives_links_and_no_pairs(spark):
    """A node of many classes just under the threshold, and a few links among them: found in blocks of any size, and no more rows than components."""
    rng = np.random.default_rng(4)
    sets = [np.sort(np.append(np.arange(600), rng.choice(np.arange(1000, 10**6), 140 if i % 20 else 60, replace=False))).astype(np.uint64) for i in range(200)]
    linked = {(i, j) for i in range(200) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    joined = near_dedup.joining(sets, np.arange(200), 75)
    assert linked and all((max(p), min(p)) in linked for p in joined) and len(joined) < 200
    entries = spark.createDataFrame([(7, i, i) for i in range(200)], "node long, class long, component long")
    full = spark.createDataFrame([(i, bytearray(near_dedup.pack_set(x << np.uint64(16)))) for i, x in enumerate(sets)], "class long, hashes binary")
    want = {(r.v, r.component) for r in near_dedup.components(spark.createDataFrame([(min(p), max(p)) for p in linked], near_dedup.EDGE)).collect()}
    for most in (2048, 30):
        new = near_dedup.settle(entries, full, near_dedup.Settings(), most)
        assert {(r.v, r.component) for r in near_dedup.components(new).collect()} == want
    assert near_dedup.settle(entries, full, near_dedup.Settings()).count() == len(joined)


def test_resolve_misses_nothing_in_an_alike_node():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 60000, 512).astype("<u2")
    signs = np.stack([np.where(rng.random(512) < p, rng.integers(0, 60000, 512), base) for p in [0.02] * 300 + [0.3] * 20]).astype("<u2")
    ids = rng.integers(1, 1 << 62, len(signs))
    settings = near_dedup.Settings(small=32)
    found = {frozenset(p) for p in near_dedup.resolve(signs, ids, settings, near_dedup._later_compare(0.68, ids, len(ids), []))}
    est = near_dedup.estimates(signs, signs)
    linked = {i for p in found for i in p}
    assert all(i in linked for i in range(len(ids)) if (est[i] >= 0.7).sum() > 1)


def boiler(n=30):
    rng = random.Random(3)
    line = lambda k: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}x" .replace("1", "y") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    own = lambda: "\n".join(" ".join(word() for _ in range(9)) for _ in range(4))
    rows = [(i, own() + f"\nCopyright notice number {i} all rights reserved here\n" + own()) for i in range(n)]
    copied = own() + "\n" + own()
    rows += [(100 + i, copied) for i in range(20)]
    changed = copied.split("\n")
    for i in range(20):
        lines = list(changed)
        words = lines[i % 8].split()
        words[5] = word()
        lines[i % 8] = " ".join(words)
        rows.append((200 + i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("settings", [{}, {"broadcast": 0}])
def test_boilerplate_goes_and_copies_stay(spark, settings):
    rows = boiler()
    got = {r.doc_id: r for r in line_dedup.dedup_lines(documents(spark, rows), line_dedup.Settings(**settings)).collect()}
    for doc_id, text in rows:
        if doc_id < 100:
            assert got[doc_id].n_dropped == 1 and got[doc_id].text == "\n".join(x for x in text.split("\n") if "Copyright" not in x)
        else:
            assert got[doc_id].n_dropped == 0 and got[doc_id].text == text
        assert got[doc_id].n_lines == text.count("\n") + 1


def test_boilerplate_goes_beside_copies_and_in_blocks(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    lines = lambda n: [" ".join(word() for _ in range(9)) for _ in range(n)]
    licence, block = "this text may be copied freely", lines(6)
    own = {i: lines(5) for i in range(30)}
    rows = [(i, "\n".join([licence, *own[i]])) for i in range(12)]
    copied = lines(6)
    rows += [(100 + i, "\n".join([licence, *copied])) for i in range(40)]  # a hot group of exact copies
    near = lines(9)
    for i in range(40):  # and of near copies, whose changes reach the leaves
        changed = list(near)
        changed[i % 9] = f"{word()} {changed[i % 9]}"
        rows.append((200 + i, "\n".join([licence, *changed])))
    rows += [(i, "\n".join([*block[:3], *own[i], *block[3:]])) for i in range(12, 30)]  # a block of boilerplate
    rng.shuffle(rows)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    for doc_id, text in rows:
        assert got[doc_id] == "\n".join(x for x in text.split("\n") if x != licence and x not in block)


def test_boilerplate_blocks_of_many_shapes_go(spark):
    """Documents of one block of boilerplate and own lines, in proportions up to five to one; those that agree in 0.75 or more are copies."""
    rows, want = [], {}
    for group, (block_lines, own) in enumerate([(1, 1), (2, 1), (5, 2), (10, 2), (10, 5), (20, 1)]):
        rng = random.Random(group)
        line = lambda: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(9))  # noqa: B023, E731
        block = [line() for _ in range(block_lines)]
        for i in range(20):
            mine = [line() for _ in range(own)]
            text = "\n".join([*block[: block_lines // 2], *mine, *block[block_lines // 2 :]])
            rows.append((100 * group + i, text))
            want[100 * group + i] = text if own * 10 < block_lines else "\n".join(mine)
    got = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert {r.doc_id: r.text for r in got} == want


def test_crowded_leaves_branch_on(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    common = [f"see also the {word()} {word()} {word()}" for _ in range(3)]
    rows = [(i, "\n".join([f"see also the {word()} {word()} {word()}" for _ in range(4)] + [common[i % 3]])) for i in range(30)]
    a, b = ({r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows), line_dedup.Settings(crowd=n)).collect()} for n in (4096, 5))
    assert a == b == {i: "\n".join(t.split("\n")[:4]) for i, t in rows}


def with_field(i, place, n_words=12):
    """A line of n_words whose word at a place is of its own, one that numbers don't make variable."""
    name = "".join("abcdefghij"[int(d)] for d in str(i))
    words = ["see", "also", "the", *(f"w{'abcdefghijkl'[k]}" for k in range(n_words - 3))]
    words[place] = "x" + name
    return " ".join(words)


@pytest.mark.parametrize("crowd", [20, 4096])
def test_a_template_of_a_crowded_leaf_goes_wherever_its_field_is(spark, crowd):
    """Nine templates, each with another variable field, and lines of one document alone among them, all in one leaf."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows = [(i, "\n".join([with_field(i, 3 + i % 9), "see also the " + " ".join(word() for _ in range(9))])) for i in range(270)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows), line_dedup.Settings(crowd=crowd)).collect()}
    assert got == {i: t.split("\n")[1] for i, t in rows}


def test_a_template_of_many_lines_at_production_settings(spark):
    names = lambda i: "".join("abcdefghij"[int(d)] for d in f"{i:05}")
    rows = [(i, f"posted on this site by {names(i)} under the usual terms of use") for i in range(5000)]
    got = line_dedup.dedup_lines(documents(spark, rows)).agg(F.sum("n_dropped").alias("n"), F.max(F.length("text")).alias("left")).first()
    assert (got["n"], got["left"]) == (5000, 0)


def test_left_over_lines_are_dealt_on_until_all_have_templates(spark):
    """Against templates of whole leaves: the same lines stand together in threes or more."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 32, (40, 16), dtype=np.uint32)
    rows = []
    for k in range(400):
        row = base[k % 40].copy()
        at = (k % 40) % 4 * 4
        row[at : at + k // 40 % 4] = rng.integers(0, 1 << 32, k // 40 % 4, dtype=np.uint32)
        rows.append((k, 7, bytearray(row.tobytes())))
    lines = spark.createDataFrame(rows, "key long, leaf long, slots binary")
    for crowd in (3, 1000):
        got = line_dedup.matched_templates(lines, line_dedup.Settings(crowd=crowd)).toPandas()
        assert set(got["key"]) == set(range(400))
        best = got.groupby(["node", "template"])["key"].agg(set)
        together = {k: max((s for s in best if k in s), key=len) for k in range(400)}
        assert all(together[k] == {x for x in range(400) if x % 40 == k % 40} for k in range(400))


def brute_runs(text):
    out, words = set(), [("#" if re.search(rb"[0-9]", w) else w) for w in text.encode().split()]
    for i in range(max(1, len(words) - 4)):
        out.add(tuple(words[i : i + 5]))
    return out


def test_copies_are_decided_by_their_sets(spark):
    """Lines stay exactly where fewer than three classes of documents hold them; classes by brute force, at 0.75 of the runs."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows = []
    for g in range(8):
        base = [" ".join(word() for _ in range(8)) for _ in range(8)]
        for c in range(10):
            lines = [" ".join(word() if rng.random() < 0.02 * (g % 4) else w for w in line.split()) for line in base]
            rows.append((g * 10 + c, "\n".join(lines)))
    sets = [brute_runs(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    holders = {}
    for i, (_, text) in enumerate(rows):
        for line in text.split("\n"):
            holders.setdefault(line, set()).add(root(i))
    # templates join lines that differ in a quarter of their words at most; here a line's changed forms belong with it
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    for i, (doc_id, text) in enumerate(rows):
        for line in text.split("\n"):
            if len(holders[line]) >= 3:
                assert line not in got[doc_id]
    one_class = [i for i in range(len(rows)) if len({root(j) for j in range(i // 10 * 10, i // 10 * 10 + 10)}) == 1]
    assert one_class and all("\n".join(got[rows[i][0]]) == rows[i][1] for i in one_class)


@pytest.mark.parametrize("settings", [{}, {"broadcast": 0}])
def test_short_boilerplate_goes(spark, settings):
    names = "alpha beta gamma delta kappa omega".split()
    rows = [(i, f"Menu\nown {a} words\n\nRead more\nAll rights reserved.\n{a} has much else beside that\n{a}") for i, a in enumerate(names)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(documents(spark, rows), line_dedup.Settings(**settings)).collect()}
    for doc_id, text in rows:
        assert got[doc_id].text == "\n".join(x for x in text.split("\n") if x not in ("Menu", "Read more", "All rights reserved."))
        assert got[doc_id].n_dropped == 3 and got[doc_id].n_lines == 7


@pytest.mark.parametrize("settings", [{}, {"broadcast": 0}])
def test_line_dedup_awkward(spark, settings):
    rows = [(1, None), (2, ""), (3, " \n\n "), (4, "x " * 50_000), (4, "x " * 50_000), (None, "a b c d e\nf")] + [(10 + i, f"only boilerplate line {i}\nown words of document {'abcdefghij'[i]}{'klmnopqrst'[i]} here") for i in range(10)]
    docs = documents(spark, rows)
    got = line_dedup.dedup_lines(docs, line_dedup.Settings(**settings))
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    out = {str(r.doc_id): r for r in got.collect()}
    assert got.count() == len(rows) and out["1"].text is None and out["1"].n_lines == 0 and out["2"].text == "" and out["3"].text == " \n\n "
    assert line_dedup.dedup_lines(documents(spark, []), line_dedup.Settings(**settings)).count() == 0


def test_both_ways_of_dropping_agree(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a, b = (sorted(map(str, line_dedup.dedup_lines(docs, line_dedup.Settings(broadcast=n)).collect())) for n in (10**6, 0))
    assert a == b


def test_templates_generalise():
    rows = [np.arange(16, dtype=np.uint32), np.arange(16, dtype=np.uint32), np.arange(16, dtype=np.uint32) + 100]
    rows[1] = rows[1].copy()
    rows[1][[3, 7]] = 999
    known = line_dedup.Templates(16, 0.75, None)
    assert [known.place(r) for r in rows] == [0, 0, 1]
    few = line_dedup.Templates(16, 0.75, 1)
    assert [few.place(r) for r in rows] == [0, 0, -1]
