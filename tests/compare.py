"""Run registered queries against their SQL counterparts in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def difference(spark, con, name, fn, sql, sf_dir) -> str | None:
    """None when both sides agree, else a short description."""
    got = fn(spark, sf_dir)
    mine = rows_of(got.columns, [tuple(r) for r in got.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} vs {sorted(names)}"
    if mine == want:
        return None
    got_set, want_set = set(mine), set(want)
    extra = [r for r in mine if r not in want_set][:3]
    missing = [r for r in want if r not in got_set][:3]
    return f"rows {len(mine)} vs {len(want)}; only mine {extra}; only sql {missing}"
