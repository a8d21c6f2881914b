"""Comparing a Spark result with its SQL result, value by value."""

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0)
                                           for v in r))


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(con, df, sql):
    """Empty when columns, types and all values agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = [f"type of {n}: {t} against {kinds[n]}" for n, t in df.dtypes
           if SPARK_TYPES.get(t) != kinds[n]]
    got, want = normal([tuple(r) for r in df.collect()], df.columns), normal(expected, names)
    if len(got) != len(want):
        out.append(f"{len(got)} rows against {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first {sorted(df.columns)}: {bad[0][0]} against {bad[0][1]}")
    return out
