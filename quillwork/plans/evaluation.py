"""Label parsing, metrics, prompts and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels
from ..operators import metrics, review, training
from ..storage import materialise, scratch
from .base import Registry, table

R = Registry()

_RAW = "CASE o_orderkey % 7 WHEN 0 THEN 'hay diálogo' WHEN 1 THEN ' NO  HAY DIÁLOGO ' WHEN 2 THEN 'no_dialogo' WHEN 3 THEN 'Creo que HAY_DIALOGO aquí' WHEN 4 THEN 'NO_DIALOGO.' WHEN 5 THEN 'Respuesta: NO_HAY_DIALOGO.' ELSE NULL END"
_LABEL = "CASE o_orderkey % 7 WHEN 0 THEN 'HAY_DIALOGO' WHEN 1 THEN 'NO_DIALOGO' WHEN 2 THEN 'NO_DIALOGO' WHEN 3 THEN 'HAY_DIALOGO' WHEN 5 THEN 'NO_DIALOGO' ELSE NULL END"


@R.query("str17_normalize", f"SELECT o_orderkey, {_LABEL} AS label FROM orders")
def str17_normalize(spark, d):
    return table(spark, d, "orders").select("o_orderkey", labels.normalize_label(F.expr(_RAW)).alias("label"))


@R.query("str18_parse_plain", f"SELECT o_orderkey, {_LABEL} AS label, {_LABEL} IS NULL AS is_invalid, CASE WHEN {_LABEL} IS NULL THEN 'invalid_plain_label' END AS error FROM orders")
def str18_parse_plain(spark, d):
    return table(spark, d, "orders").select("o_orderkey", labels.parse_plain(F.expr(_RAW)).alias("p")).select("o_orderkey", "p.*")


_JSON = """CASE turn % 5 WHEN 0 THEN substr(text, 1, 20) || ' {"label":"HAY_DIALOGO","confidence":0.9} ok' WHEN 1 THEN '{"label":"no hay diálogo"}' WHEN 2 THEN text WHEN 3 THEN '{"label":"HAY_DIALOGO",}' ELSE '{"label":null}' END"""


@R.query("jsn1_parse", """
SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 'HAY_DIALOGO' WHEN 1 THEN 'NO_DIALOGO' END AS label, turn % 5 > 1 AS is_invalid,
       CASE turn % 5 WHEN 2 THEN 'no_json_object' WHEN 3 THEN 'json_decode_error:Illegal trailing comma before end of object' WHEN 4 THEN 'invalid_json_label' END AS error FROM conversations""")
def jsn1_parse(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", labels.parse_json(F.expr(_JSON)).alias("p")).select("conv_id", "turn", "p.*")


_PRED = "CASE WHEN n_chars % 7 = 0 THEN NULL WHEN n_chars % 3 = 0 THEN 'NO_DIALOGO' ELSE 'HAY_DIALOGO' END"
_SQL_ROWS = f"r AS (SELECT lang, CASE quality WHEN 1 THEN 'HAY_DIALOGO' ELSE 'NO_DIALOGO' END AS t, coalesce({_PRED}, '__INVALID__') AS p FROM labels JOIN documents USING (doc_id))"


def _predictions(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    joined = table(spark, d, "labels").join(docs, "doc_id")
    return joined.select("doc_id", "lang", F.when(F.col("quality") == 1, "HAY_DIALOGO").otherwise("NO_DIALOGO").alias("true_label"), F.expr(_PRED).alias("normalized_label"))


@R.query("agg10_summary", f"""
WITH {_SQL_ROWS}, c AS (SELECT lang, count(*) AS n, count(*) FILTER (t = p) AS hit,
  count(*) FILTER (t = 'HAY_DIALOGO' AND p = t) AS tp0, count(*) FILTER (p = 'HAY_DIALOGO') AS pp0, count(*) FILTER (t = 'HAY_DIALOGO') AS s0,
  count(*) FILTER (t = 'NO_DIALOGO' AND p = t) AS tp1, count(*) FILTER (p = 'NO_DIALOGO') AS pp1, count(*) FILTER (t = 'NO_DIALOGO') AS s1 FROM r GROUP BY 1),
m AS (SELECT *, coalesce(tp0 / nullif(pp0, 0), 0) AS p0, coalesce(tp1 / nullif(pp1, 0), 0) AS p1, coalesce(tp0 / nullif(s0, 0), 0) AS r0, coalesce(tp1 / nullif(s1, 0), 0) AS r1,
  coalesce(2 * tp0 / nullif(pp0 + s0, 0), 0) AS f0, coalesce(2 * tp1 / nullif(pp1 + s1, 0), 0) AS f1 FROM c)
SELECT lang, n AS n_rows, round(hit / n, 6) AS accuracy, round((r0 + r1) / ((s0 > 0)::INT + (s1 > 0)::INT), 6) AS balanced_accuracy, round((p0 + p1) / 2, 6) AS precision_macro,
  round((r0 + r1) / 2, 6) AS recall_macro, round((f0 + f1) / 2, 6) AS f1_macro, round(p0, 6) AS precision_hay_dialogo, round(r0, 6) AS recall_hay_dialogo, round(f0, 6) AS f1_hay_dialogo, s0 AS support_hay_dialogo,
  round(p1, 6) AS precision_no_dialogo, round(r1, 6) AS recall_no_dialogo, round(f1, 6) AS f1_no_dialogo, s1 AS support_no_dialogo FROM m""")
def agg10_summary(spark, d):
    got = metrics.summarize(_predictions(spark, d), ["lang"])
    return got.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in got.dtypes])


@R.query("agg11_confusion", f"""
WITH {_SQL_ROWS}, v(x) AS (VALUES ('HAY_DIALOGO'), ('NO_DIALOGO'), ('__INVALID__'))
SELECT g.lang, a.x AS true_label, b.x AS pred_label, (SELECT count(*) FROM r WHERE r.lang = g.lang AND r.t = a.x AND r.p = b.x) AS count
FROM (SELECT DISTINCT lang FROM r) g CROSS JOIN v a CROSS JOIN v b""")
def agg11_confusion(spark, d):
    return metrics.confusion(_predictions(spark, d), "lang")


@R.query("agg12_class_weight", "SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight FROM labels GROUP BY 1")
def agg12_class_weight(spark, d):
    return metrics.class_weights(table(spark, d, "labels"), "quality").withColumn("weight", F.round("weight", 6))


@R.query("agg13_multiclass", """
WITH r AS (SELECT c_mktsegment AS t, CASE WHEN c_custkey % 3 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS p FROM customer),
l AS (SELECT DISTINCT t AS x FROM r UNION SELECT DISTINCT p FROM r),
m AS (SELECT x, count(*) FILTER (t = x) AS s, count(*) FILTER (p = x) AS pp, count(*) FILTER (t = x AND p = x) AS tp FROM l CROSS JOIN r GROUP BY 1),
v AS (SELECT *, coalesce(tp / nullif(pp, 0), 0) AS pr, coalesce(tp / nullif(s, 0), 0) AS re, coalesce(2 * tp / nullif(s + pp, 0), 0) AS f FROM m)
SELECT round(sum(tp) / sum(s), 6) AS accuracy, round(avg(re) FILTER (s > 0), 6) AS balanced_accuracy, round(sum(s * pr) / sum(s), 6) AS precision_weighted, round(sum(s * re) / sum(s), 6) AS recall_weighted,
  round(sum(s * f) / sum(s), 6) AS f1_weighted, round(avg(f), 6) AS f1_macro FROM v""")
def agg13_multiclass(spark, d):
    df = table(spark, d, "customer").select(F.col("c_mktsegment").alias("t"), F.when(F.col("c_custkey") % 3 == 0, "BUILDING").otherwise(F.col("c_mktsegment")).alias("p"))
    got = metrics.multiclass(df, "t", "p")
    return got.select(*[F.round(c, 6).alias(c) for c in got.columns])


@R.query("agg14_pr_auc", """
WITH r AS (SELECT quality AS y, (doc_id * 7919 % 101) / 101.0::DOUBLE AS s FROM labels), g AS (SELECT s, count(*) FILTER (y = 1) AS tp, count(*) AS n FROM r GROUP BY 1),
c AS (SELECT tp, sum(tp) OVER (ORDER BY s DESC) AS ctp, sum(n) OVER (ORDER BY s DESC) AS cn FROM g)
SELECT round(sum(tp * ctp / cn) / sum(tp), 6) AS average_precision FROM c""")
def agg14_pr_auc(spark, d):
    df = table(spark, d, "labels").select("quality", ((F.col("doc_id") * 7919 % 101) / 101.0).alias("s"))
    return metrics.average_precision(df, "quality", "s").withColumn("average_precision", F.round("average_precision", 6))


@R.query("agg15_argmax", "SELECT l_orderkey, l_linenumber, CASE WHEN l_tax >= l_discount THEN 0 ELSE 1 END::BIGINT AS best, round(exp(l_tax) / (exp(l_tax) + exp(l_discount)), 6) AS p0 FROM lineitem")
def agg15_argmax(spark, d):
    logits = F.array("l_tax", "l_discount")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", metrics.argmax(logits).alias("best"), F.round(metrics.softmax(logits)[0], 6).alias("p0"))


@R.query("agg16_accuracy", f"WITH {_SQL_ROWS} SELECT count(*) AS n_rows, count(*) FILTER (t = p) AS n_correct, round(count(*) FILTER (t = p) / count(*), 6) AS accuracy FROM r")
def agg16_accuracy(spark, d):
    return metrics.accuracy(_predictions(spark, d), "true_label", "normalized_label").withColumn("accuracy", F.round("accuracy", 6))


@R.query("agg18_review_size", "SELECT least(25, count(*) FILTER (quality = 1), count(*) FILTER (quality = 0))::BIGINT AS sample_size FROM labels")
def agg18_review_size(spark, d):
    return metrics.review_size(_predictions(spark, d), "true_label")


@R.query("agg9_corr", """
SELECT 'l_extendedprice' AS x, 'l_discount' AS y, round(corr(l_extendedprice, l_discount), 6) AS corr FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_quantity', round(corr(l_extendedprice, l_quantity), 6) FROM lineitem UNION ALL SELECT 'l_discount', 'l_quantity', round(corr(l_discount, l_quantity), 6) FROM lineitem""")
def agg9_corr(spark, d):
    return metrics.correlations(table(spark, d, "lineitem"), ["l_extendedprice", "l_discount", "l_quantity"]).withColumn("corr", F.round("corr", 6))


_SYSTEM, _ASK = review.SYSTEM, review.ASK.split("{text}")
_STYLES = ["zero_shot_simple", "zero_shot_rubric", "structured_json"]
_HEAD = {"zero_shot_simple": "", "zero_shot_rubric": review.RUBRIC, "structured_json": review.AS_JSON}
_CASE = "'[CONFLICTO]\n' || left(text, 40) || '\n\n[EVENTO]\n' || text"
_PROMPT_SQL = " UNION ALL ".join(f"SELECT item_id, '{s}' AS prompt_style, '{'json' if 'json' in s else 'plain'}' AS response_format, '{_SYSTEM}' AS system_prompt, '{_HEAD[s]}{_ASK[0]}' || {_CASE} AS user_prompt FROM benchmark" for s in _STYLES)


def _cases(spark, d):
    """Cases of a conflict text (the first 40 characters here) and an event text."""
    return table(spark, d, "benchmark").withColumn("text", review.case(F.left("text", F.lit(40)), F.col("text")))


@R.query("str21_prompts", _PROMPT_SQL)
def str21_prompts(spark, d):
    return review.prompts(_cases(spark, d), "text", _STYLES).drop("text")


_ANSWER = "CASE WHEN regexp_matches(lower(text), 'dialog|diálogo|meeting|reunión|mesa|table') THEN 'HAY_DIALOGO' ELSE 'NO_DIALOGO' END"


@R.query("llm2_review", f"SELECT item_id, s AS prompt_style, {_ANSWER} AS normalized_label, {_ANSWER} = CASE WHEN item_id % 2 = 0 THEN 'HAY_DIALOGO' ELSE 'NO_DIALOGO' END AS is_correct FROM benchmark CROSS JOIN (VALUES " + ", ".join(f"('{s}')" for s in _STYLES) + ") t(s)")
def llm2_review(spark, d):
    df = _cases(spark, d).withColumn("truth", F.when(F.col("item_id") % 2 == 0, "HAY_DIALOGO").otherwise("NO_DIALOGO"))
    return review.review(df, "text", "truth", _STYLES).select("item_id", "prompt_style", "normalized_label", "is_correct")


_SAID = "lower('Report: ' || text)"


@R.query("llm1_stored_answers", f"""
WITH p AS (SELECT conv_id, turn, '{_HEAD['zero_shot_simple']}{_ASK[0]}' || text || '{_ASK[1]}' AS u, text FROM conversations WHERE role = 'user'),
a AS (SELECT *, sha256('7:offline' || length('{_SYSTEM}') || ':{_SYSTEM}' || length(u) || ':' || u) AS k,
             CASE WHEN regexp_matches(lower(text), 'dialog|diálogo|meeting|reunión|mesa|table') THEN 'HAY_DIALOGO' ELSE 'NO_DIALOGO' END AS label FROM p)
SELECT conv_id, turn, 'zero_shot_simple' AS prompt_style, CASE WHEN u IS NOT NULL THEN 'offline' END AS model_name, CASE WHEN u IS NOT NULL THEN label END AS raw_response_text,
       CASE WHEN u IS NOT NULL THEN label END AS normalized_label, 'resp_' || left(k, 24) AS response_id FROM a""")
def llm1_stored_answers(spark, d):
    """What users say, asked about once for each distinct text."""
    said = table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    got = review.review(said.withColumn("truth", F.lit("NO_DIALOGO")), "text", "truth", ["zero_shot_simple"], store=scratch(spark, "answers"))
    return got.select("conv_id", "turn", "prompt_style", "model_name", "raw_response_text", "normalized_label", "response_id")


@R.query("llm3_multi_agent", f"SELECT item_id, {_ANSWER} AS agent_a_argument, {_ANSWER} AS agent_b_argument, {_ANSWER} AS normalized_label, {_ANSWER} = 'NO_DIALOGO' AS is_correct FROM benchmark")
def llm3_multi_agent(spark, d):
    df = _cases(spark, d).withColumn("truth", F.lit("NO_DIALOGO"))
    return review.multi_agent(df, "text", "truth").select("item_id", "agent_a_argument", "agent_b_argument", "normalized_label", "is_correct")


@R.query("mlt1_classifier")
def mlt1_classifier(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("doc_id", "text", F.col("toxic").cast("string").alias("y"))
    model = review.train_classifier(df, "text", "y")
    return model.transform(df).select("doc_id", F.col("prediction").cast("int").alias("prediction"))


@R.query("mlt1_training", """
WITH d AS (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents WHERE lang IS NOT NULL),
s AS (SELECT CASE WHEN r <= floor(n * 0.7 + 1e-9) THEN 'train' WHEN r <= floor(n * 0.85 + 1e-9) THEN 'validation' ELSE 'test' END AS split FROM d)
SELECT split, count(*) AS n_rows, true AS f1_macro_over_85, true AS best_is_kept FROM s GROUP BY 1""")
def mlt1_training(spark, d):
    """The language of each document, trained on the first split, chosen on the second; AGG13's metrics of each split against a threshold."""
    df = table(spark, d, "documents").select("doc_id", "text", F.col("lang").alias("y"))
    model, split = training.train_epochs(df, "text", "y", "doc_id")
    best = max(h["value"] for h in model.history) == model.history[model.best_epoch - 1]["value"]
    found = materialise(training.predict(split, model, "text").select("split", "y", "prediction"), "predicted")
    per = [metrics.multiclass(found.where(F.col("split") == s), "y", "prediction").select(F.lit(s).alias("split"), (F.col("f1_macro") >= 0.85).alias("f1_macro_over_85")) for s in ("train", "validation", "test")]
    counts = found.groupBy("split").agg(F.count("*").alias("n_rows"))
    return counts.join(per[0].unionByName(per[1]).unionByName(per[2]), "split").withColumn("best_is_kept", F.lit(best))


QUERIES, ORACLES = R.queries, R.oracles
