"""Runs a query beside its SQL on the driver's smallest tables, as the driver does."""

import glob

import duckdb


def sql_rows(sql, sf="/root/testdata/sf0.001"):
    """Column names, sorted, and rows of the SQL over the tables of a folder."""
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {path.rpartition('/')[2][:-8]} AS SELECT * FROM '{path}'")
    found = con.sql(sql)
    names = sorted(found.columns)
    at = [found.columns.index(n) for n in names]
    return names, sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=str)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)
