import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from quillwork.llm import mixing, near_dedup, toxicity, url_filter
from quillwork.llm.tokens import default_tokenizer

from .helpers import awkward, labels, same_clashes, with_clashes


def test_stages_take_awkward_rows_and_clashing_names(spark, tmp_path):
    """Nulls, empty and long texts, repeats and empty tables; columns of any name come back as they were."""
    labels(spark, [(1, 1, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    docs = with_clashes(awkward(spark))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns and same_clashes(got), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.where("start = 0").count() == docs.count()
    assert corpus_pipeline.STAGES[2][1](spark, docs.where("false"), str(tmp_path)).count() == 0


def test_urls_with_clashing_names(spark):
    pages = with_clashes(spark.createDataFrame([(1, "http://a.com/en/x"), (2, None)], "page_id long, url string"))
    got = url_filter.filter_urls(pages)
    assert same_clashes(got) and {r.page_id: r.verdict for r in got.collect()} == {1: "block", 2: "allow"}


def test_stages_and_run(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/stage-{i}"
        stage(spark, docs, sf).write.mode("overwrite").parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept.append(docs.count())
        if i == 0:
            model = toxicity.train(before, spark.read.parquet(f"{sf}/labels.parquet"))
            reader = toxicity.Reader(model.trigrams, toxicity.Settings(), model.weights)
            z = {r.doc_id: model.slope * (model.bias + sum(model.weights[f] for f in reader.features(r.text.encode()))) + model.shift for r in before.collect()}
            assert {r.doc_id for r in docs.collect()} == {d for d, x in z.items() if x < 0}
        if i == 1:
            assert docs.count() == before.count()
        if i == 2:
            found = near_dedup.near_duplicates(before).collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in found if r.kept)
        if i == 3:
            want = {r.doc_id: r.copies for r in mixing.mix_report(before).collect()}
            got = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
            assert got == {d: n for d, n in want.items() if n}
        if i == 4:
            tok = Tokenizer.from_file(default_tokenizer())
            ids = {r.doc_id: [*tok.encode(r.text or "", add_special_tokens=False).ids, 2] for r in before.collect()}
            for r in docs.collect():
                assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        else:
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, sf).count() == kept[-1]


def test_two_operators_at_once_in_one_session(spark, sf):
    """Scopes of scratch tables belong to a thread: one query doesn't remove the other's tables."""
    from concurrent.futures import ThreadPoolExecutor

    from quillwork.llm import line_dedup, near_dedup

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    jobs = [lambda: near_dedup.near_duplicates(docs).count(), lambda: line_dedup.dedup_lines(docs).count(), lambda: near_dedup.near_duplicates(docs).count()]
    with ThreadPoolExecutor(3) as pool:
        assert [f.result() for f in [pool.submit(j) for j in jobs]] == [120] * 3


def test_a_doc_id_of_many_rows_is_learnt_from_once(spark):
    from quillwork.llm.common import one_text_each

    rows = spark.createDataFrame([(1, f"text {i}", 0) for i in range(5000)] + [(2, "same", 1)] * 3000 + [(3, None, 1)], "doc_id long, text string, y int").repartition(5)
    got = one_text_each(rows).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3} and len(got) == 3
    assert sorted(map(str, got)) == sorted(map(str, one_text_each(rows.repartition(2)).collect()))
