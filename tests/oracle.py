"""Compares a query's rows with DuckDB's."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}


def connection(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(x + 0.0)
        return str(x)

    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, c, sf_dir, query, sql):
    df = query(spark, sf_dir)
    rel = c.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    kinds = {n: str(t) for n, t in zip(rel.columns, rel.types, strict=True)}
    for n, t in df.dtypes:
        assert TYPES.get(t, kinds[n]) == kinds[n], (n, t, kinds[n])
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(rel.fetchall(), rel.columns)
