"""Side-by-side run of a registered query and its SQL on the same parquet tables."""

import glob
import math
import os

import duckdb


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, (int, float)):
        return float(f"{float(value):.12g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def sql_rows(folder: str, sql: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])
