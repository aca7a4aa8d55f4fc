"""Compares a query's rows with its SQL's, without regard to order."""

import os

import duckdb
import numpy as np
import pandas as pd


def connect(folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.sql(f"create view {f.split('.')[0]} as select * from '{folder}/{f}'")
    return con


def plain(v):
    if isinstance(v, (list, np.ndarray)):
        return str([plain(x) for x in v])
    if v is None or pd.isna(v):
        return "~"
    if isinstance(v, (bool, np.bool_)):
        return str(v)
    if isinstance(v, (int, float, np.number)):
        return f"{float(v):.9g}"
    try:
        return f"{float(v):.9g}" if type(v).__name__ == "Decimal" else str(v)[:19].replace(" 00:00:00", "") if hasattr(v, "year") else str(v)
    except ValueError:
        return str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(plain(v) for v in r) for r in df.itertuples(index=False, name=None))
