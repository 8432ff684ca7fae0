"""Comparing a Spark result with the same query in SQL."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list:
    """Up to six rows only one side has; columns in alphabetical order, as tuples, or the differing columns."""
    columns = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != columns:
        return [("columns", columns, sorted(relation.columns))]
    types = {c: TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types, strict=True)}
    if dict(df.dtypes) != types:
        return [("types", df.dtypes, types)]
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    theirs = Counter(relation.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    return [("spark", r) for r in (ours - theirs)][:3] + [("sql", r) for r in (theirs - ours)][:3]
