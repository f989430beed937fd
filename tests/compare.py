"""Side by side run of a registered query and its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return sorted_rows([c[0] for c in result.description], result.fetchall())


def duck_types(con, sql):
    result = con.execute(sql)
    return {c[0]: str(c[1]) for c in result.description}
