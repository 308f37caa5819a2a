"""Epochs: stop, choice, steps; and prompts that are asked once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.operators import responses, review, training


def rows(spark, n=120, noise=0):
    texts = [(i, f"{'agua mina' if i % 3 else 'mesa acta'} w{i % 7} w{i % 11}", "b" if i % 3 else "a") for i in range(n)]
    return spark.createDataFrame([*texts, (n, None, "a"), (n + 1, "no label", None)], "id long, t string, y string")


def test_training_stops_and_keeps_the_best(spark):
    given = [0.1, 0.5, 0.4, 0.45, 0.9]
    seen = []

    def evaluate(model, epoch):
        seen.append(model.weights.copy())
        return given[epoch - 1]

    model, split = training.train_epochs(rows(spark), "t", "y", "id", training.Settings(features=256), evaluate)
    assert [h["epoch"] for h in model.history] == [1, 2, 3, 4] and model.best_epoch == 2
    assert (model.weights == seen[1]).all() and not (model.weights == seen[3]).all()
    assert {r["split"] for r in split.select("split").distinct().collect()} == {"train", "validation", "test"}


def test_training_learns_and_repeats(spark):
    settings = training.Settings(features=512, max_epochs=6)
    model, split = training.train_epochs(rows(spark), "t", "y", "id", settings)
    again, _ = training.train_epochs(rows(spark).repartition(7), "t", "y", "id", settings)
    assert np.allclose(model.weights, again.weights) and model.labels == ["a", "b"]
    assert model.history[0]["loss"] > model.history[-1]["loss"] or len(model.history) < 2
    found = training.predict(split.where("split = 'test' and t is not null"), model, "t")
    assert found.where("prediction <> y").count() == 0 and found.where("score < 0.5 or score > 1").count() == 0
    assert training.macro_f1(found, "y", "prediction") == 1.0


def test_steps_follow_the_gradient_of_the_weighted_loss():
    rng = np.random.default_rng(1)
    s = training.Settings(features=6, batch=100, l2=0.0)
    some = [(int(rng.integers(2)), float(rng.random() + 0.5), np.array([0, 3, 6]), rng.random(3)) for _ in range(5)]
    w = rng.normal(size=(7, 2))

    def loss(w):
        total = sum(share * -np.log(training.softmax(x @ w[c])[y]) for y, share, c, x in some)
        return total / sum(share for _, share, _, _ in some)

    moved, _ = training.local_steps(w, some, 1e-3, s, 1)
    for i in (0, 3, 6, 1):
        for k in (0, 1):
            up, down = w.copy(), w.copy()
            up[i, k] += 1e-5
            down[i, k] -= 1e-5
            assert np.isclose((w - moved)[i, k] / 1e-3, (loss(up) - loss(down)) / 2e-5, atol=1e-5)


def test_training_without_rows_or_with_one_class(spark):
    empty = rows(spark).where("false")
    model, split = training.train_epochs(empty, "t", "y", "id")
    assert model.labels == [] and model.history == [] and split.count() == 0 and training.predict(empty, model, "t").count() == 0
    one, _ = training.train_epochs(rows(spark).where("y = 'a'"), "t", "y", "id", training.Settings(features=64, max_epochs=3))
    assert one.labels == ["a"] and {r["prediction"] for r in training.predict(rows(spark), one, "t").collect()} == {"a"}


def counting(folder, fail_once=False):
    """A provider that leaves a mark for each call; with fail_once, the task breaks down once behind some calls."""

    def provider(system, user):
        import os
        import uuid

        with open(f"{folder}/call-{uuid.uuid4().hex}", "w") as f:
            f.write(user)
        if fail_once and "3" in user and not os.path.exists(f"{folder}/failed"):
            open(f"{folder}/failed", "w").close()
            raise RuntimeError("lost")
        return "HAY_DIALOGO", f"id-{len(user)}"

    return provider


def calls(folder):
    return sorted(p.read_text() for p in folder.glob("call-*"))


def test_equal_prompts_are_asked_once(spark, tmp_path):
    df = spark.createDataFrame([(i, f"case {i % 5}" if i % 7 else None) for i in range(60)], "id int, text string").repartition(6)
    asked = review.prompts(df, "text", ["zero_shot_simple", "structured_json"])
    got = responses.stored_answers(asked, counting(tmp_path), f"file://{tmp_path}/store", "model-1")
    for _ in range(2):  # a plan that runs again doesn't ask again
        made = got.collect()
    assert len(made) == 120 and len(calls(tmp_path)) == 10 == len(set(calls(tmp_path)))
    assert all((r["response_id"], r["model_name"]) == ((f"id-{len(r['user_prompt'])}", "model-1") if r["user_prompt"] else (None, None)) for r in made)
    responses.stored_answers(asked, counting(tmp_path), f"file://{tmp_path}/store", "model-1").collect()
    assert len(calls(tmp_path)) == 10
    responses.stored_answers(asked, counting(tmp_path), f"file://{tmp_path}/store", "model-2").collect()
    assert len(calls(tmp_path)) == 20


def test_a_failed_task_does_not_ask_again(tmp_path):
    """In a session that repeats failed tasks: the task breaks down behind its second call or so; what was answered before is not asked again."""
    import subprocess
    import sys

    code = f"""
import sys; sys.path.insert(0, {str(tmp_path.parents[0])!r}); sys.path.insert(0, '.')
from quillwork.session import build_session
from quillwork.operators import responses
from tests.test_training_responses import counting
spark = build_session("t", "local[2,3]", spark_sql_shuffle_partitions="1")
df = spark.createDataFrame([(i, f"case {{i % 6}}") for i in range(24)], "id int, user_prompt string")
df = df.selectExpr("id", "'' as system_prompt", "user_prompt")
got = responses.stored_answers(df, counting({str(tmp_path)!r}, True), "file://{tmp_path}/store", "m", tasks=1).collect()
assert len(got) == 24 and all(r["raw_response_text"] == "HAY_DIALOGO" for r in got)
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=240, capture_output=True)
    made = calls(tmp_path)
    # the call that broke down is the only one that was made twice
    assert (tmp_path / "failed").exists() and len(set(made)) == 6 and len(made) == 7 and made.count("case 3") == 2


ODD = ["", None, " ", "Agua  agua\tMINA\n", "a\x1cb c\x1d d", "x\x85y\xa0z w　v u", "᠎a b​c ﻿d", "ÁRBOL árbol ΣΑΣ Σ ß ﬁ İ", "w" * 63 + " " + "w" * 64 + " " + "W" * 65 + " " + "é" * 40, "\x00 \x00a", "𝔘 𐐀"]


def test_columns_of_texts_equal_those_of_their_words(spark):
    """Words by the white space of `text.words`, each with its crc32; a text at a time or many, whatever is counted at a time."""
    import zlib

    from quillwork.functions.text import words

    many = [*ODD, *(" ".join(f"W{i * j % 97}" for j in range(i)) for i in range(40))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(many)], "id int, t string")
    cut = {r["id"]: r["w"] for r in df.select("id", F.transform(words(F.coalesce("t", F.lit(""))), F.lower).alias("w")).collect()}
    for settings in (training.Settings(features=512), training.Settings(features=50, max_words=7)):
        want = []
        for i in range(len(many)):
            at, n = np.unique(np.array([zlib.crc32(w.encode()) % settings.features for w in cut[i][: settings.max_words]], np.int64), return_counts=True)
            want.append(([*at.tolist(), settings.features], [*n.tolist(), 1]))
        for group in (1, 100, 1 << 22):
            columns, counts, starts = training.counted(many, settings, group)
            assert [(columns[a:b].tolist(), counts[a:b].tolist()) for a, b in zip(starts[:-1], starts[1:], strict=True)] == want
    assert [len(x) for x in training.counted([], settings)] == [0, 0, 1]


def test_texts_are_cut_into_words_once(spark, sf, monkeypatch):
    """What epochs and their validation read holds no words any more, and the query's rows are predicted in one pass, written once (before: every epoch
    hashed all words anew, and each split's metrics predicted all rows again)."""
    from quillwork.plans import evaluation

    written = {}
    keep = training.materialise
    monkeypatch.setattr(training, "materialise", lambda df, name: keep(written.setdefault(name, df), name))
    training.train_epochs(rows(spark), "t", "y", "id", training.Settings(features=64, max_epochs=1))
    assert dict(written["train-rows"].dtypes) == {"_y": "int", "_weight": "double", "_columns": "array<int>", "_counts": "array<int>"}
    assert dict(written["validation"].dtypes) == {"_true": "string", "_columns": "array<int>", "_counts": "array<int>"}
    monkeypatch.setattr(training, "train_epochs", lambda df, *_: (training.Classifier(["a", "b"], np.zeros((65, 2)), training.Settings(features=64), [{"value": 0.0}], 1), df.withColumn("split", F.lit("train"))))
    assert "MapInArrow" not in evaluation.mlt1_training(spark, sf)._jdf.queryExecution().toString()


def test_steps_in_stretches(spark):
    """A task that holds a few rows at a time takes steps over all of them, and as many rows count."""
    settings = training.Settings(features=128)
    df = rows(spark).where("y is not null").selectExpr("cast(y = 'b' as int) as _y", "1.0D as _weight", "t")
    coded = training.coded(df, "t", settings).coalesce(1)
    whole, loss = training._epoch(coded, training.Classifier(["a", "b"], np.zeros((129, 2)), settings), 0.1, 1)
    parts, other = training._epoch(coded, training.Classifier(["a", "b"], np.zeros((129, 2)), settings), 0.1, 1, stretch=20)
    assert np.allclose(whole, parts, atol=0.2) and (whole != parts).any() and 0 < other < 0.7 and 0 < loss < 0.7
    steep = training.Settings(features=6, batch=1, l2=0.3)  # weights decay to a tenth in each step
    some = [(i % 2, 1.0, np.array([i % 5, 6]), np.array([1.0, 0.2])) for i in range(40)]
    w, order = np.ones((7, 2)), np.random.default_rng([steep.seed, 1]).permutation(40)
    for i in order:
        y, _, c, x = some[i]
        p = training.softmax(x @ w[c])
        p[y] -= 1
        w *= 1 - 3.0 * 0.3
        w[c] -= 3.0 * x[:, None] * p
    assert np.allclose(training.local_steps(np.ones((7, 2)), some, 3.0, steep, 1)[0], w)
