"""Compares a query with its SQL twin on the same Parquet files."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return ("", "")
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float) and math.isnan(value):
        return ("", "nan")
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return ("n", float(value))
    return ("s", str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    got_columns, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want_columns, want = canonical([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference: spark {str(g)[:400]} | sql {str(w)[:400]}"
    return None
