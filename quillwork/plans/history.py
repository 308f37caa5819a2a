"""Spells, melts and other shapes over orders, lineitem, part and supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markers
from ..operators import relational, reshape, scans, spells
from .base import Registry, table

R = Registry()


@R.query("win7_spells", """
WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus IN ('O','P') AS act FROM orders),
c AS (SELECT *, CASE WHEN lag(act) OVER w IS DISTINCT FROM act THEN 1 ELSE 0 END AS ch FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
s AS (SELECT *, sum(ch) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS sp FROM c),
g AS (SELECT o_custkey, sp, min(o_orderdate) AS st, bool_and(act) AS act FROM s GROUP BY 1, 2)
SELECT o_custkey AS id, CASE WHEN act THEN 'active' ELSE 'non_active' END AS status, strftime(st, '%Y-%m-%d') AS start_date,
       strftime(coalesce(lead(st) OVER (PARTITION BY o_custkey ORDER BY sp), TIMESTAMP '2022-07-01'), '%Y-%m-%d') AS end_date FROM g""")
def win7_spells(spark, d):
    got = spells.spells(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderstatus", "o_orderkey", active=("O", "P"))
    return got.select(F.col("o_custkey").alias("id"), "status", F.date_format("start_date", "yyyy-MM-dd").alias("start_date"), F.date_format("end_date", "yyyy-MM-dd").alias("end_date"))


@R.query("win2_lag_change", """
SELECT o_orderkey, lag(o_orderstatus) OVER w AS prev_status, CAST(o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER w AS INT) AS changed,
       strftime(lead(o_orderdate) OVER w, '%Y-%m-%d') AS next_date
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def win2_lag_change(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    got = scans.neighbours(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], before={"prev_status": "o_orderstatus"}, after={"next": "o_orderdate"})
    changed = (~F.col("prev_status").eqNullSafe(F.col("o_orderstatus"))).cast("int")
    return got.select("o_orderkey", "prev_status", changed.alias("changed"), F.date_format("next", "yyyy-MM-dd").alias("next_date"))


@R.query("win7_hot_key", """
WITH o AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS k, o_orderdate, o_orderkey, o_orderstatus = 'O' AS act FROM orders),
c AS (SELECT *, CASE WHEN lag(act) OVER w IS DISTINCT FROM act THEN 1 ELSE 0 END AS ch FROM o WINDOW w AS (PARTITION BY k ORDER BY o_orderdate, o_orderkey)),
s AS (SELECT k, o_orderdate, o_orderkey, act FROM c WHERE ch = 1)
SELECT k AS id, CASE WHEN act THEN 'active' ELSE 'non_active' END AS status, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
       strftime(coalesce(lead(o_orderdate) OVER (PARTITION BY k ORDER BY o_orderdate, o_orderkey), TIMESTAMP '2022-07-01'), '%Y-%m-%d') AS end_date FROM s""")
def win7_hot_key(spark, d):
    """Spells where one key holds a third of all rows, which fill several tasks."""
    orders = table(spark, d, "orders").withColumn("k", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey")))
    got = spells.spells(orders, "k", "o_orderdate", "o_orderstatus", "o_orderkey", active=("O",))
    return got.select(F.col("k").alias("id"), "status", F.date_format("start_date", "yyyy-MM-dd").alias("start_date"), F.date_format("end_date", "yyyy-MM-dd").alias("end_date"))


@R.query("rsh1_melt", """
SELECT l_orderkey, l_linenumber, 'l_discount' AS measure, nullif(l_discount, 0) AS value FROM lineitem WHERE nullif(l_discount, 0) IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', nullif(l_tax, 0) FROM lineitem WHERE nullif(l_tax, 0) IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, 'l_quantity', l_quantity FROM lineitem""")
def rsh1_melt(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in ("l_discount", "l_tax")], "l_quantity")
    return reshape.melt(df, ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax", "l_quantity"], ("measure", "value"))


_PAIRS = """
SELECT p_partkey, 0 AS k, p_name AS a, nullif(p_brand, 'Brand#11') AS b FROM part UNION ALL SELECT p_partkey, 1, p_type, CAST(nullif(p_size, 1) AS VARCHAR) FROM part"""


@R.query("rsh2_paired_melt", f"SELECT p_partkey, a, b FROM ({_PAIRS}) WHERE a IS NOT NULL AND b IS NOT NULL")
def rsh2_paired_melt(spark, d):
    df = table(spark, d, "part").select("p_partkey", "p_name", "p_type", F.nullif("p_brand", F.lit("Brand#11")).alias("b0"), F.nullif(F.col("p_size"), F.lit(1)).cast("string").alias("b1"))
    return reshape.paired_melt(df, ["p_partkey"], ["p_name", "p_type"], ["b0", "b1"], ("a", "b"))


@R.query("jon1_index_join", f"SELECT x.p_partkey AS id, CAST(x.k AS INT) AS index, x.a, y.b FROM ({_PAIRS}) x JOIN ({_PAIRS}) y ON x.p_partkey = y.p_partkey AND x.k = y.k WHERE x.a IS NOT NULL AND y.b IS NOT NULL")
def jon1_index_join(spark, d):
    p = table(spark, d, "part")
    left = p.select(F.col("p_partkey").alias("id"), F.posexplode(F.array("p_name", "p_type")).alias("index", "a")).where("a is not null")
    right = p.select(F.col("p_partkey").alias("id"), F.posexplode(F.array(F.nullif("p_brand", F.lit("Brand#11")), F.nullif(F.col("p_size"), F.lit(1)).cast("string"))).alias("index", "b")).where("b is not null")
    return relational.inner_on_index(left, right).select("id", "index", "a", "b")


_STATUS = "CASE l_linenumber % 6 WHEN 0 THEN 'd_TCNuevo' WHEN 1 THEN 'd_TCLatente' || l_linenumber WHEN 2 THEN 'd_TCReactivado' || l_linenumber WHEN 3 THEN 'd_TCResuelto' WHEN 4 THEN 'd_TCRetirado' || l_linenumber ELSE 'd_TCNuevo2' END"


@R.query("rsh3_status_names", f"""
SELECT l_orderkey, l_linenumber, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_STATUS}, 'd_TCNuevo', 'nuevo'), 'd_TCLatente\\d*', 'latente'),
  'd_TCReactivado\\d*', 'reactivado'), 'd_TCResuelto', 'resuelto'), 'd_TCRetirado\\d*', 'retirado') AS status FROM lineitem""")
def rsh3_status_names(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", reshape.status_name(F.expr(_STATUS)).alias("status"))


@R.query("rsh4_triples", """
SELECT s_suppkey, unnest(['a', 'x']) AS a, unnest([s_name, CAST(s_nationkey AS VARCHAR)]) AS b, unnest(['c', 'z']) AS c FROM supplier""")
def rsh4_triples(spark, d):
    items = F.array(F.lit("a"), F.col("s_name"), F.lit("c"), F.lit("x"), F.col("s_nationkey").cast("string"), F.lit("z"), F.lit("left over"))
    return table(spark, d, "supplier").select("s_suppkey", F.inline(reshape.triples(items)))


_RECORD = "'Tipo: ' || p_type || ' Caso: ' || p_name || CASE WHEN p_size % 2 = 0 THEN ' Lugar: L' || p_size ELSE '' END"


@R.query("rsh5_records", "SELECT p_partkey, p_type AS tipo, p_name AS caso, CASE WHEN p_size % 2 = 0 THEN 'L' || p_size ELSE 'none' END AS lugar FROM part")
def rsh5_records(spark, d):
    found = reshape.repaired(reshape.fields(F.expr(_RECORD), ["Caso", "Lugar", "Tipo"]), {"Lugar": "none"})
    return table(spark, d, "part").select("p_partkey", found.alias("m")).select("p_partkey", *[F.col("m")[k].alias(k.lower()) for k in ("Tipo", "Caso", "Lugar")])


@R.query("rsh6_sections", """
WITH t AS (SELECT p_partkey, 'head ALFA one ' || p_name || CASE WHEN p_size % 3 = 0 THEN '' ELSE ' BETA two' END || ' GAMA three' AS txt, p_size FROM part)
SELECT p_partkey, 'ALFA' AS marker, substr(txt, instr(txt, 'ALFA'), CASE WHEN instr(txt, 'BETA') > 0 THEN instr(txt, 'BETA') ELSE instr(txt, 'GAMA') END - instr(txt, 'ALFA')) AS section FROM t
UNION ALL SELECT p_partkey, 'BETA', 'BETA two ' FROM t WHERE p_size % 3 <> 0
UNION ALL SELECT p_partkey, 'GAMA', 'GAMA three' FROM t""")
def rsh6_sections(spark, d):
    text = F.expr("'head ALFA one ' || p_name || CASE WHEN p_size % 3 = 0 THEN '' ELSE ' BETA two' END || ' GAMA three'")
    return reshape.sections(table(spark, d, "part").withColumn("txt", text), "p_partkey", "txt", ["ALFA", "BETA", "DELTA", "GAMA"])


#: 25 names as departments have them, of which a text holds some.
_PLACES = [f"REGION {chr(65 + i)}" for i in range(25)]


@R.query("rsh6_many_markers", """
WITH t AS (SELECT o_orderkey, 'head ' || 'REGION ' || chr(CAST(65 + o_orderkey % 12 AS INT)) || ' Ca so: ' || o_custkey || ' REGION ' || chr(CAST(65 + 12 + o_orderkey % 13 AS INT)) || ' Lu gar: x' AS txt FROM orders)
SELECT o_orderkey, 'REGION ' || chr(CAST(65 + o_orderkey % 12 AS INT)) AS marker, 'REGION ' || chr(CAST(65 + o_orderkey % 12 AS INT)) || ' Caso: ' || o_custkey || ' ' AS section FROM orders
UNION ALL SELECT o_orderkey, 'REGION ' || chr(CAST(65 + 12 + o_orderkey % 13 AS INT)), 'REGION ' || chr(CAST(65 + 12 + o_orderkey % 13 AS INT)) || ' Lugar: x' FROM orders""")
def rsh6_many_markers(spark, d):
    """25 markers and 9 labels in a pass each."""
    place = lambda n: F.concat(F.lit("REGION "), F.char(n.cast("int")))
    key = F.col("o_orderkey")
    txt = F.concat(F.lit("head "), place(65 + key % 12), F.lit(" Ca so: "), F.col("o_custkey").cast("string"), F.lit(" "), place(77 + key % 13), F.lit(" Lu gar: x"))
    labels = ["Caso:", "Lugar:", "Tipo:", "Fecha:", "Actores:", "Detalle:", "Mes:", "Nota:", "Fin:"]
    return markers.sections(table(spark, d, "orders").select("o_orderkey", markers.repair(txt, labels).alias("txt")), "o_orderkey", "txt", _PLACES)


@R.query("rsh7_record_split", "SELECT s_suppkey, unnest(['Tipo: a' || s_name || ' ', 'Tipo: b']) AS rec FROM supplier")
def rsh7_record_split(spark, d):
    text = F.expr("'preface Tipo: a' || s_name || ' Tipo: b'")
    return table(spark, d, "supplier").select("s_suppkey", F.explode(reshape.records(text)).alias("rec"))


QUERIES, ORACLES = R.queries, R.oracles
