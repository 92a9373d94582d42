"""Spark query against its SQL in DuckDB: column names, row count, and all values."""

from __future__ import annotations

import datetime as dt
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def rows(columns: list[str], data) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in data)


# Spark type -> DuckDB type
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
         "boolean": "BOOLEAN", "double": "DOUBLE"}


def difference(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    cols, got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols2, want = rows([d[0] for d in cur.description], cur.fetchall())
    if cols != cols2:
        return f"columns {cols} vs {cols2}"
    types = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = {c: (t, types[c]) for c, t in df.dtypes if TYPES[t] != types[c]}
    if wrong:
        return f"types {wrong}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}: {[r for r in got if r not in want][:2]} / {[r for r in want if r not in got][:2]}"
    if got != want:
        i = next(i for i in range(len(got)) if got[i] != want[i])
        return f"first difference {got[i]} vs {want[i]}"
    return None
