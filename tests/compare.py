"""Compare a Spark result with a DuckDB result: columns, rows and values."""

from __future__ import annotations

import glob
import os

import duckdb

# Spark and DuckDB type names that count as the same type.
SAME_TYPE = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is not None, v) for v in r))


def difference(df, con, sql: str) -> str | None:
    """What differs, or nothing."""
    result = con.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} vs {sorted(result.columns)}"
    types = {c: str(t) for c, t in zip(result.columns, result.types)}
    for column, spark_type in df.dtypes:
        if SAME_TYPE.get(spark_type, spark_type) != types[column]:
            return f"type of {column}: {spark_type} vs {types[column]}"
    ours = rows_of(df.columns, df.collect())
    theirs = rows_of(result.columns, result.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} vs {b}"
    return None
