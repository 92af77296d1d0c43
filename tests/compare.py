"""Runs a query and its SQL twin and compares the rows, whatever their order."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26].replace("T00:00:00", "")
    v = v.item() if hasattr(v, "item") else v
    return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))


def twin(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.sql(sql).df()
