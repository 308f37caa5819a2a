"""Comparison of a query with its SQL in DuckDB."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(df):
    names = sorted(df.columns)
    return sorted(tuple("None" if pd.isna(v) else str(v) for v in row) for row in df[names].astype(object).itertuples(index=False))


def same_as_sql(spark, query, sql, folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    mine, theirs = query(spark, folder).toPandas(), con.execute(sql).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows_of(mine) == rows_of(theirs)
