"""The queries of this subpackage, with production parameters over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, language, line_dedup, mixing, near_dedup, packing, pii, quality, token_files, toxicity, url_filter, variants


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_tokens(spark, token_files.write_tokens(_table(spark, sf_dir, "documents")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(_table(spark, sf_dir, "documents"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(_table(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "op1_ann": op1_ann,
        "op2_mixing": op2_mixing,
        "op3_near_dedup": op3_near_dedup,
        "op4_pii": op4_pii,
        "op5_toxicity": op5_toxicity,
        "op6_packing": op6_packing,
        "op7_quality": op7_quality,
        "op8_url_filter": op8_url_filter,
        "op9_token_files": op9_token_files,
        "op10_line_dedup": op10_line_dedup,
        "op11_alignment": op11_alignment,
        "op12_variants": op12_variants,
        "op13_language": op13_language,
    }


OP8 = r"""
WITH cut AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rhost, rpath, verdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
fits AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
  FROM cut JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM cut LEFT JOIN fits USING (page_id)
"""


OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                           WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(d, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT both_ways.y, r.c FROM r JOIN both_ways ON r.d = both_ways.x),
m AS (SELECT d, min(c) AS c FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept FROM documents JOIN m ON doc_id = d LEFT JOIN n USING (doc_id)
"""


# crc32 by its table; distances over one-byte letters, since DuckDB's levenshtein counts bytes
OP12 = r"""
WITH RECURSIVE tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents),
each AS (SELECT w, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS keyed, count(*) AS n FROM runs WHERE length(w) >= 5 GROUP BY 1, 2),
bytes AS (SELECT w, n, hex(encode(keyed)) AS x FROM each),
hashed AS (
  SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x), 2), lambda i: (instr('0123456789ABCDEF', x[i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 2]) - 1)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM bytes, tab),
damaged AS (SELECT CASE WHEN h % 97 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
flat AS (SELECT *, length(word) AS l, translate(word, 'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ', '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&()*+,-./:;<=>?@[]^_{|}~') AS f FROM words),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM flat a JOIN flat b ON (b.l = a.l OR b.l = a.l + 1 OR b.l = a.l - 1) AND a.word <> b.word AND levenshtein(a.f, b.f) = 1),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS form, max(m) AS form_n FROM near GROUP BY 1),
rows_ AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS last, 0 AS step FROM rows_ UNION ALL SELECT chain.word, rows_.form, step + 1 FROM chain JOIN rows_ ON rows_.word = chain.last WHERE rows_.form IS NOT NULL),
ends AS (SELECT word, max_by(last, step) AS root FROM chain GROUP BY 1)
SELECT word, form, root, n, n_near, form_n FROM rows_ JOIN ends USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_near_dedup": OP3, "op8_url_filter": OP8, "op12_variants": OP12}
