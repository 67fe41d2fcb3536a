"""Run a query and its SQL on the same tables and compare the two results."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows(frame):
    cols = sorted(frame.columns)
    data = [tuple(_cell(v) for v in r) for r in frame[cols].astype(object).values.tolist()]
    return cols, sorted(data, key=repr)


def kinds(frame):
    return {c: frame[c].dtype.kind for c in frame.columns}


def compare(spark_df, con, sql):
    got, want = spark_df.toPandas(), con.execute(sql).df()
    a, b = rows(got), rows(want)
    problems = []
    if a[0] != b[0]:
        problems.append(f"columns {a[0]} != {b[0]}")
    elif len(a[1]) != len(b[1]):
        problems.append(f"rows {len(a[1])} != {len(b[1])}")
        extra = [r for r in a[1] if r not in set(b[1])][:2] if len(a[1]) < 50000 else []
        lost = [r for r in b[1] if r not in set(a[1])][:2] if len(a[1]) < 50000 else []
        problems.append(f"extra {extra} lost {lost}")
    elif a[1] != b[1]:
        bad = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    if a[0] == b[0]:
        ka, kb = kinds(got), kinds(want)
        odd = {c: (got[c].dtype.name, want[c].dtype.name) for c in ka if ka[c] != kb[c] or
               got[c].dtype.name != want[c].dtype.name and "datetime" not in got[c].dtype.name and ka[c] not in "OM"}
        if odd:
            problems.append(f"types {odd}")
    return len(want), problems
