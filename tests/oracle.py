"""Order-insensitive comparison of a Spark result with SQL run by DuckDB."""

from __future__ import annotations

import math
import pathlib
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if pathlib.Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(t[i]) for i in order) for t in tuples)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return rows([d[0] for d in cur.description], cur.fetchall())


_KINDS = {"bigint": "BIGINT", "smallint": "SMALLINT", "int": "INTEGER", "string": "VARCHAR",
          "double": "DOUBLE", "boolean": "BOOLEAN"}


def types_differ(df, con, sql):
    sql_types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    mine = {n: _KINDS.get(t, t) for n, t in df.dtypes}
    return {c: (mine[c], sql_types[c]) for c in mine if c in sql_types and mine[c] != sql_types[c]}
