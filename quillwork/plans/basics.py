"""One short query for each elementary operator that the other catalogues show only as a part of something."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import relational, reshape, scans
from .base import Registry, table

R = Registry()
day = lambda c: F.date_format(c, "yyyy-MM-dd")


@R.query("prj1_rename_all", "SELECT r_regionkey AS k, r_name AS name FROM region")
def prj1(spark, d):
    return relational.rename_all(table(spark, d, "region"), ["k", "name"])


@R.query("prj2_select", "SELECT n_name, n_regionkey FROM nation")
def prj2(spark, d):
    return table(spark, d, "nation").select("n_name", "n_regionkey")


@R.query("prj3_first_columns", "SELECT c_custkey, c_name FROM customer")
def prj3(spark, d):
    return relational.first_columns(table(spark, d, "customer"), 2)


@R.query("prj5_derive_drop_literal", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net, 'x' AS tag FROM lineitem")
def prj5_prj6_prj7(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return df.withColumns({"net": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4), "tag": F.lit("x")}).drop("l_extendedprice", "l_discount")


@R.query("prj9_casts", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS s, try_cast(right(p_brand, 1) AS INT) AS digit, CAST(p_size AS TINYINT) AS small FROM part")
def prj9(spark, d):
    return table(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("s"), F.right("p_brand", F.lit(1)).try_cast("int").alias("digit"), F.col("p_size").cast("byte").alias("small"))


@R.query("flt5_both_present", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL AND nullif(o_orderpriority, '5-LOW') IS NOT NULL")
def flt5_flt6(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("a"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("b"))
    return df.dropna(subset=["a", "b"]).select("o_orderkey")


@R.query("flt7_equality", "SELECT doc_id FROM labels WHERE toxic = 1")
def flt7(spark, d):
    return table(spark, d, "labels").where("toxic = 1").select("doc_id")


@R.query("flt9_group_transform", "SELECT o_orderkey, n FROM (SELECT o_orderkey, count(o_custkey) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n > 10")
def flt9_agg4_win1(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey").where("o_custkey is not null")
    return relational.min_history(df, "o_custkey", 10).select("o_orderkey", F.col("n_key").alias("n"))


@R.query("flt12_range", "SELECT p_partkey FROM part WHERE p_partkey > 126")
def flt12(spark, d):
    return table(spark, d, "part").where("p_partkey > 126").select("p_partkey")


@R.query("flt14_contains", "SELECT page_id FROM pages WHERE contains(url, 'example.com')")
def flt14_str15(spark, d):
    return table(spark, d, "pages").where(F.contains("url", F.lit("example.com"))).select("page_id")


@R.query("flt15_membership", "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P') IN ('O'), false) AS active FROM orders")
def flt15(spark, d):
    return table(spark, d, "orders").select("o_orderkey", relational.is_active(F.nullif("o_orderstatus", F.lit("P")), ("O",)).alias("active"))


@R.query("flt16_record_size", "SELECT item_id FROM benchmark WHERE len(string_split(text, ' ')) >= 20")
def flt16(spark, d):
    return table(spark, d, "benchmark").where(F.size(F.split("text", " ")) >= 20).select("item_id")


@R.query("jon2_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def jon2(spark, d):
    keys = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(keys, "c_custkey", "left_semi")


@R.query("jon6_gather", "SELECT item_id FROM (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS i FROM benchmark) WHERE i IN (3, 5, 7)")
def jon6(spark, d):
    return relational.row_number0(table(spark, d, "benchmark").select("item_id"), "i", F.col("item_id")).where(F.col("i").isin(3, 5, 7)).select("item_id")


@R.query("agg5_n_unique", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1")
def agg5(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("n_customers"))


@R.query("agg7_term_freq_per_document", "SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS term FROM benchmark) GROUP BY 1, 2")
def agg7(spark, d):
    from ..operators.sentiment import term_counts_by

    return term_counts_by(table(spark, d, "benchmark"), "item_id", F.filter(F.split(F.lower("text"), " "), lambda w: w != ""))


@R.query("agg17_row_counts", "SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n_final")
def agg17(spark, d):
    return table(spark, d, "orders").agg(F.count("*").alias("n_orders"), F.count_if(F.col("o_orderstatus") == "F").alias("n_final"))


@R.query("win4_running_sum", "SELECT o_orderkey, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n FROM orders")
def win4(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", (F.col("o_orderstatus") == "O").cast("int").alias("one"))
    return scans.running_sum(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "one", "n").select("o_orderkey", "n")


@R.query("win5_lead_fill", "SELECT o_orderkey, strftime(coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), TIMESTAMP '2022-07-01'), '%Y-%m-%d') AS until FROM orders")
def win5_win6(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    got = scans.neighbours(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], after={"next": "o_orderdate"})
    return got.select("o_orderkey", day(F.coalesce("next", F.to_timestamp(F.lit("2022-07-01")))).alias("until"))


@R.query("win8_first_order", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def win8(spark, d):
    return relational.keep_first(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey")).select("o_orderkey")


@R.query("srt1_multi_sort", "SELECT user_id, event_id FROM events ORDER BY user_id, ts, event_id")
def srt1(spark, d):
    return table(spark, d, "events").orderBy("user_id", "ts", "event_id").select("user_id", "event_id")


@R.query("srt3_fields_in_order", "SELECT p_partkey, array_to_string(list_sort([p_name, p_brand, p_type]), '|') AS f FROM part")
def srt3(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(F.array("p_name", "p_brand", "p_type")), "|").alias("f"))


@R.query("set5_distinct_list", "SELECT DISTINCT source FROM documents ORDER BY source")
def set5(spark, d):
    return table(spark, d, "documents").select("source").distinct().orderBy("source")


@R.query("rsh8_repair", "SELECT p_partkey, p_name AS caso, CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'no date' END AS ingreso FROM part")
def rsh8(spark, d):
    raw = F.expr("'Caso: ' || p_name || CASE WHEN p_size % 2 = 0 THEN ' Ingreso: ' || p_type ELSE '' END")
    m = reshape.repaired(reshape.fields(raw, ["Caso", "Ingreso"]), {"Ingreso": "no date"})
    return table(spark, d, "part").select("p_partkey", m.alias("m")).select("p_partkey", F.col("m")["Caso"].alias("caso"), F.col("m")["Ingreso"].alias("ingreso"))


@R.query("nul1_coalesce", "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS a, coalesce(nullif(o_orderpriority, '5-LOW'), '__INVALID__') AS b FROM orders")
def nul1_nul2_nul3(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority").alias("a"), F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("__INVALID__")).alias("b"))


@R.query("cnd1_value_map", "SELECT doc_id, CASE WHEN quality = 1 THEN 'active' ELSE 'non_active' END AS status FROM labels")
def cnd1(spark, d):
    return table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "active").otherwise("non_active").alias("status"))


@R.query("mth1_ratio", "SELECT o_custkey, round(count(*) FILTER (o_orderstatus = 'F') / nullif(count(*) FILTER (o_orderstatus = 'P'), 0), 6) AS r FROM orders GROUP BY 1")
def mth1(spark, d):
    final, pending = F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") == "P")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.round(F.try_divide(final, pending), 6).alias("r"))


@R.query("arr1_slices", "SELECT s_suppkey, array_to_string(list_concat(['a', s_name, 'c'][2:3], ['d']), '|') AS a FROM supplier")
def arr1(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", F.array_join(F.flatten(F.array(F.slice(F.array(F.lit("a"), "s_name", F.lit("c")), 2, 2), F.array(F.lit("d")))), "|").alias("a"))


@R.query("str3_matches", "SELECT p_partkey, regexp_matches(lower(p_type), '^(small|large)') AS m FROM part")
def str3(spark, d):
    return table(spark, d, "part").select("p_partkey", F.col("p_type").rlike("(?iu)^(small|large)").alias("m"))


@R.query("str5_replace", "SELECT item_id, replace(regexp_replace(text, '[aeiou]+', '_', 'g'), '_t', 'T') AS t FROM benchmark")
def str5_str6(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.replace(F.regexp_replace("text", "[aeiou]+", "_"), F.lit("_t"), F.lit("T")).alias("t"))


@R.query("str22_loose_pattern", "SELECT p_partkey, regexp_matches(p_name, 'a ?l ?u') OR contains(p_type, 'TIN') AS hit FROM part")
def str22(spark, d):
    broken = F.concat(F.regexp_replace("p_name", "alu", "a lu"), F.lit("|"), F.regexp_replace("p_type", "TIN", "T I N"))
    return table(spark, d, "part").select("p_partkey", (broken.rlike(text.loose("alu")) | broken.rlike(text.loose("TIN"))).alias("hit"))


_KINDS = ("Socioambiental", "Comunal", "Laboral", "SMAL", "PRO STE", "PROM")


def _typed(x: str) -> str:
    for k in _KINDS:
        x = f"CASE WHEN ({x}) LIKE '%{'%'.join(k)}%' THEN '{k}' ELSE ({x}) END"
    return x


@R.query("str22_record_type", f"SELECT p_partkey, {_typed('v')} AS t FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'x So cio ambien tal ' || p_name WHEN 1 THEN p_type ELSE 'Co mun l' || p_name END AS v FROM part)")
def str22_types(spark, d):
    v = F.expr("CASE p_partkey % 3 WHEN 0 THEN 'x So cio ambien tal ' || p_name WHEN 1 THEN p_type ELSE 'Co mun l' || p_name END")
    return table(spark, d, "part").select("p_partkey", text.record_type(v, _KINDS).alias("t"))


@R.query("dat3_timestamps", "SELECT o_orderkey, strftime(CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP), '%Y-%m-%d') AS d FROM orders")
def dat3(spark, d):
    return table(spark, d, "orders").select("o_orderkey", day(F.to_timestamp_ntz(day("o_orderdate"), F.lit("yyyy-MM-dd"))).alias("d"))


@R.query("smp2_per_class", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY toxic ORDER BY md5('7|' || doc_id), doc_id) AS r FROM labels) WHERE r <= 5")
def smp2(spark, d):
    return relational.sample_per_label(table(spark, d, "labels"), "toxic", "doc_id", 5, seed=7).select("doc_id")


QUERIES, ORACLES = R.queries, R.oracles
