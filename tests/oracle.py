"""Compare a query's rows with those of its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(x):
    if x is None:
        return ""
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return str(x)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, row count and all values agree exactly."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    theirs = canonical(names, rel.fetchall())
    ours = canonical(df.columns, df.collect())
    out = []
    if sorted(names) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} != {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs, strict=False) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ, first {sorted(names)}: {bad[0]}")
    return out
