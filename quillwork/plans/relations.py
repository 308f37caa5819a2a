"""Filters, sets, counts, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, relational
from ..streaming import counts
from ..storage import scratch
from .base import Registry, table

R = Registry()


@R.query("flt1_isin", "SELECT event_id, event_type FROM events WHERE event_type IN ('purchase', 'signup')")
def flt1_isin(spark, d):
    return table(spark, d, "events").where(F.col("event_type").isin("purchase", "signup")).select("event_id", "event_type")


@R.query("flt2_min_history", """
SELECT event_id, user_id, n_key FROM (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS n_key FROM events WHERE event_type IN ('purchase', 'signup')) WHERE n_key > 5""")
def flt2_min_history(spark, d):
    kept = table(spark, d, "events").where(F.col("event_type").isin("purchase", "signup")).select("event_id", "user_id")
    return relational.min_history(kept, "user_id", 5).select("event_id", "user_id", "n_key")


@R.query("flt3_three_valued", "SELECT o_orderkey FROM (SELECT *, nullif(o_orderstatus, 'P') AS s FROM orders) WHERE s <> 'F' AND o_orderpriority <> '5-LOW'")
def flt3_three_valued(spark, d):
    s = F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, d, "orders").where((s != "F") & (F.col("o_orderpriority") != "5-LOW")).select("o_orderkey")


@R.query("flt4_drop_nulls", "SELECT p_partkey FROM part WHERE nullif(p_size, 1) IS NOT NULL AND nullif(p_brand, 'Brand#11') IS NOT NULL")
def flt4_drop_nulls(spark, d):
    df = table(spark, d, "part").select("p_partkey", F.nullif(F.col("p_size"), F.lit(1)).alias("s"), F.nullif("p_brand", F.lit("Brand#11")).alias("b"))
    return df.dropna(how="any", subset=["s", "b"]).select("p_partkey")


@R.query("flt8_min_support", """
SELECT doc_id, lang FROM documents WHERE lang || source IN (SELECT lang || source FROM documents GROUP BY lang, source HAVING count(*) >= 8)""")
def flt8_min_support(spark, d):
    return relational.min_support(table(spark, d, "documents").withColumn("g", F.concat("lang", "source")), "g", 8).select("doc_id", "lang")


@R.query("flt10_url_filter", "SELECT page_id FROM pages WHERE NOT (starts_with(url, 'http://www.') OR starts_with(url, 'https://www.') OR starts_with(url, 'https://blog.'))")
def flt10_url_filter(spark, d):
    from ..functions.text import not_prefixed

    return table(spark, d, "pages").where(not_prefixed(F.col("url"), ["http://www.", "https://www.", "https://blog."])).select("page_id")


@R.query("flt11_regex_flag", "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '2\\d*0') AND NOT contains(lower(source), '9')")
def flt11_regex_flag(spark, d):
    return table(spark, d, "documents").where(~F.col("text").rlike(r"2\d*0") & ~F.contains(F.lower("source"), F.lit("9"))).select("doc_id")


@R.query("flt13_without_last", "SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier ORDER BY s_suppkey DESC LIMIT 3)")
def flt13_without_last(spark, d):
    return relational.without_last(table(spark, d, "supplier"), 3, F.col("s_suppkey")).select("s_suppkey")


@R.query("prj8_row_index", "SELECT s_suppkey, row_number() OVER (ORDER BY s_name, s_suppkey) - 1 AS row_id FROM supplier")
def prj8_row_index(spark, d):
    return relational.row_number0(table(spark, d, "supplier").select("s_suppkey", "s_name"), "row_id", F.col("s_name"), F.col("s_suppkey")).select("s_suppkey", "row_id")


@R.query("prj4_prefix_columns", "SELECT p_partkey, p_name FROM part")
def prj4_prefix_columns(spark, d):
    return relational.first_columns(relational.columns_by_prefix(table(spark, d, "part"), "p_"), 2)


@R.query("prj10_label_from_flag", "SELECT doc_id, CASE WHEN toxic = 1 THEN 'HAY_DIALOGO' ELSE 'NO_DIALOGO' END AS label FROM labels")
def prj10_label_from_flag(spark, d):
    return table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "HAY_DIALOGO").otherwise("NO_DIALOGO").alias("label"))


@R.query("jon4_cross_styles", "SELECT item_id, style FROM benchmark CROSS JOIN (VALUES ('a'), ('b'), ('c'), ('d'), ('e')) s(style)")
def jon4_cross_styles(spark, d):
    styles = spark.createDataFrame([(x,) for x in "abcde"], "style string")
    return relational.cross_small(table(spark, d, "benchmark").select("item_id"), styles)


@R.query("jon5_lookup", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'final' ELSE o_orderstatus END AS status FROM orders")
def jon5_lookup(spark, d):
    return table(spark, d, "orders").select("o_orderkey", relational.lookup(F.col("o_orderstatus"), {"O": "open", "F": "final"}).alias("status"))


@R.query("set1_union_all", "SELECT s_nationkey AS k FROM supplier UNION ALL SELECT c_nationkey FROM customer")
def set1_union_all(spark, d):
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).unionByName(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")))


@R.query("set2_diagonal", "SELECT CAST(s_suppkey AS DOUBLE) AS id, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_acctbal, c_name, c_mktsegment FROM customer")
def set2_diagonal(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    b = table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("id"), F.col("c_name").alias("name"))
    return relational.union_diagonal(a.withColumn("id", F.col("id").cast("double")), b).select("id", "name", "segment")


@R.query("set3_keep_first", "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def set3_keep_first(spark, d):
    # the text is hashed before the shuffle, so rows of the window stay small
    df = table(spark, d, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("h"))
    return relational.keep_first(df, ["h"], F.col("doc_id")).select("doc_id", "lang")


@R.query("set4_distinct", "SELECT DISTINCT lang, source FROM documents")
def set4_distinct(spark, d):
    return table(spark, d, "documents").select("lang", "source").distinct()


@R.query("agg1_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def agg1_value_counts(spark, d):
    return relational.value_counts(table(spark, d, "events"), "event_type")


@R.query("agg2_class_balance", """
SELECT count(*) AS n_total, count(*) FILTER (toxic = 1) AS n_pos, count(*) FILTER (toxic = 0) AS n_neg,
       round(count(*) FILTER (toxic = 1) / count(*), 6) AS share_pos, round(count(*) FILTER (toxic = 0) / count(*), 6) AS share_neg FROM labels""")
def agg2_class_balance(spark, d):
    return metrics.class_balance(table(spark, d, "labels"), "toxic").withColumns({c: F.round(c, 6) for c in ("share_pos", "share_neg")})


@R.query("agg3_min_max", "SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS first_date, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date, count(*) AS n FROM orders GROUP BY 1")
def agg3_min_max(spark, d):
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return table(spark, d, "orders").groupBy("o_custkey").agg(day(F.min("o_orderdate")).alias("first_date"), day(F.max("o_orderdate")).alias("last_date"), F.count("*").alias("n"))


@R.query("agg6_label_mapping", "SELECT event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS label_id FROM (SELECT DISTINCT event_type FROM events)")
def agg6_label_mapping(spark, d):
    return relational.label_mapping(table(spark, d, "events"), "event_type")


@R.query("srt2_rank", "SELECT lang, source, n FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2) ORDER BY n DESC NULLS FIRST, lang DESC NULLS FIRST, source DESC NULLS FIRST")
def srt2_rank(spark, d):
    g = table(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return g.orderBy(*[F.desc_nulls_first(c) for c in ("n", "lang", "source")])


@R.query("lim1_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def lim1_head(spark, d):
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5).select("o_orderkey", "o_totalprice")


@R.query("lim2_first_ids", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey LIMIT 15)")
def lim2_first_ids(spark, d):
    return relational.first_ids(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


@R.query("smp1_per_label", "SELECT doc_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || doc_id), doc_id) AS r FROM labels) WHERE r <= 25")
def smp1_per_label(spark, d):
    return relational.sample_per_label(table(spark, d, "labels"), "quality", "doc_id", 25).select("doc_id", "quality")


@R.query("smp3_shuffle", "SELECT item_id FROM benchmark ORDER BY md5('42|' || item_id), item_id")
def smp3_shuffle(spark, d):
    return relational.shuffled(table(spark, d, "benchmark").select("item_id"), "item_id")


_CUT = "CASE WHEN r <= floor(n * 0.70 + 1e-9) THEN 'train' WHEN r <= floor(n * 0.85 + 1e-9) THEN 'validation' ELSE 'test' END"


@R.query("spl1_stratified", f"""
SELECT doc_id, quality, {_CUT} AS split FROM (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels)""")
def spl1_stratified(spark, d):
    return relational.stratified_split(table(spark, d, "labels").select("doc_id", "quality"), "quality", "doc_id")


_GROUPS = f"(SELECT user_id, {_CUT} AS split FROM (SELECT user_id, row_number() OVER (ORDER BY md5('42|' || user_id), user_id) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT user_id FROM events)))"


@R.query("spl2_group", f"SELECT event_id, user_id, split FROM events JOIN {_GROUPS} USING (user_id)")
def spl2_group(spark, d):
    return relational.group_split(table(spark, d, "events").select("event_id", "user_id"), "user_id").select("event_id", "user_id", "split")


@R.query("lkg1_report", f"SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_keys, round(avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0 END), 6) AS share_pos FROM events JOIN {_GROUPS} USING (user_id) GROUP BY 1")
def lkg1_report(spark, d):
    split = relational.group_split(table(spark, d, "events").select("user_id", (F.col("event_type") == "purchase").cast("int").alias("y")), "user_id")
    return relational.split_report(split, "user_id", "y").withColumn("share_pos", F.round("share_pos", 6))


@R.query("lkg1_leaked", "SELECT user_id, count(DISTINCT CASE WHEN md5('42|' || event_id) < 'b' THEN 'train' ELSE 'test' END) AS n_splits FROM events GROUP BY 1 HAVING n_splits > 1")
def lkg1_leaked(spark, d):
    """Users whose events a split by event, not by user, puts on both sides."""
    drawn = table(spark, d, "events").select("user_id", F.when(relational.draw(42, F.col("event_id")) < "b", "train").otherwise("test").alias("split"))
    return relational.leaked_keys(drawn, "user_id")


@R.query("lkg1_none_leaked", f"SELECT user_id, count(DISTINCT split) AS n_splits FROM events JOIN {_GROUPS} USING (user_id) GROUP BY 1 HAVING n_splits > 1")
def lkg1_none_leaked(spark, d):
    return relational.leaked_keys(relational.group_split(table(spark, d, "events").select("user_id"), "user_id"), "user_id")


@R.query("str_stream_counts", """
WITH e AS (SELECT * FROM events WHERE event_type IN ('purchase', 'view')), m AS (SELECT max(ts) - INTERVAL 2 DAY AS mark FROM e)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, event_type, count(*) AS n, round(sum(value), 3) AS value FROM e, m GROUP BY date_trunc('day', ts), event_type, mark HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= mark""")
def str_stream_counts(spark, d):
    """The streaming extension, drained once into a table in the shared folder."""
    out = scratch(spark, "stream")
    stream = counts.windowed_counts(counts.read_events(spark, d), ["purchase", "view"])
    stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("start timestamp, event_type string, n long, value double").parquet(f"{out}/rows").withColumns({"start": F.date_format("start", "yyyy-MM-dd"), "value": F.round("value", 3)})


QUERIES, ORACLES = R.queries, R.oracles
