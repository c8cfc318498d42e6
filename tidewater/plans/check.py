"""Compare a registered query with its DuckDB oracle (row count, column
names and an order-insensitive hash of the values)."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if hasattr(v, "asDict"):
        return {k: _norm(x) for k, x in v.asDict().items()}
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in v.items()}
    return v


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr([_norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from tidewater.plans import all_oracles, all_queries
    q = all_queries()[name]
    df = q(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"name": name, "spark_rows": len(s_rows)}
    sql = all_oracles().get(name)
    if sql is None:
        out["oracle"] = False
        return out
    con = con or duck_connection(sf_dir)
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    out.update(oracle=True, duck_rows=len(d_rows),
               cols_match=sorted(s_cols) == sorted(d_cols),
               hash_match=digest(s_cols, s_rows) == digest(d_cols, d_rows))
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
    if not out["hash_match"]:
        so = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        do = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        sset = sorted(repr([_norm(r[i]) for i in so]) for r in s_rows)
        dset = sorted(repr([_norm(r[i]) for i in do]) for r in d_rows)
        out["only_spark"] = sorted(set(sset) - set(dset))[:3]
        out["only_duck"] = sorted(set(dset) - set(sset))[:3]
    return out
