import pytest

import __spark_entry__
from quillwork.plans import catalogue

from .helpers import same_as_sql


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf, name):
    query = catalogue.QUERIES[name]
    if name in catalogue.ORACLES:
        same_as_sql(spark, query, catalogue.ORACLES[name], sf)
    else:
        assert query(spark, sf).count() > 0


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["id", "status", "start_date", "end_date"] and df.count() > 0


def test_partitioning_does_not_matter(spark, sf):
    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(map(tuple, catalogue.QUERIES["spl1_stratified"](spark, sf).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]
