"""Compare a Spark result with the rows another engine gives for the same query."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer part orders lineitem events".split()

# Spark type -> type of the other engine.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        files = f"{folder}/{t}.parquet"
        if os.path.isdir(files):
            files += "/*.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{files}'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs in columns, types or rows; empty if nothing does."""
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    sql_types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    if spark_types != sql_types:
        names = sorted(set(spark_types) | set(sql_types))
        return [f"{n}: {spark_types.get(n)} / {sql_types.get(n)}" for n in names if spark_types.get(n) != sql_types.get(n)]
    columns = sorted(spark_types)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    picked = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(con.execute(f"SELECT {picked} FROM ({sql})").fetchall(), key=key)
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows / {len(theirs)} rows"]
    return [f"{a} / {b}" for a, b in zip(ours, theirs) if a != b][:3]
