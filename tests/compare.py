"""Compare a Spark result with the SQL oracle's: columns, types, rows and values."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type to the SQL type that holds the same values.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _sorted(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    # -0.0 equals 0.0; NULL sorts first; values keep their Python type and full precision
    plain = [tuple((r[i] is not None, repr(r[i] + 0.0 if isinstance(r[i], float) else r[i])) for i in order) for r in rows]
    return sorted(plain)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both engines agree."""
    relation = con.sql(sql)
    ours = {n: TYPES.get(t, t) for n, t in df.dtypes}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    problems = []
    if ours != theirs:
        odd = {n: (ours.get(n), theirs.get(n)) for n in ours.keys() | theirs.keys() if ours.get(n) != theirs.get(n)}
        problems.append(f"columns or types differ: {odd}")
        if ours.keys() != theirs.keys():
            return problems
    mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    other = _sorted(list(relation.columns), relation.fetchall())
    if len(mine) != len(other):
        problems.append(f"{len(mine)} rows, expected {len(other)}")
    if mine != other:
        only = [r for r in mine if r not in set(other)][:2]
        missing = [r for r in other if r not in set(mine)][:2]
        problems.append(f"values differ: {only} against {missing}")
    return problems
