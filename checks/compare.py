"""Run a registered query and its oracle on the same tables and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as bigints, so that engines agree on types."""
    cols = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v: object) -> object:
    if isinstance(v, Decimal):
        return float(v) + 0.0
    if isinstance(v, float):
        return v + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if both give the same columns and exactly the same values."""
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    duck_rows = cur.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns: only spark {sorted(set(df.columns) - set(names))}, only oracle {sorted(set(names) - set(df.columns))}"]
    want = {"bigint": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    for f in df.schema:
        t = f.dataType.typeName() if not isinstance(f.dataType, T.LongType) else "bigint"
        if want.get(t) != kinds[f.name]:
            problems.append(f"type of {f.name}: {t} vs {kinds[f.name]}")
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows: {len(spark_rows)} vs {len(duck_rows)}")
    a, b = _rows(df.columns, spark_rows), _rows(names, duck_rows)
    if a != b:
        cols = sorted(names)
        in_a, in_b = set(a), set(b)
        only_a = [r for r in a if r not in in_b][:3]
        only_b = [r for r in b if r not in in_a][:3]
        for x, y in zip(only_a, only_b):
            problems.append(str({c: (p, q) for c, p, q in zip(cols, x, y) if p != q or c == cols[0]})[:600])
        if not only_b or not only_a:
            problems.append(f"extra rows: {only_a[:1]} / {only_b[:1]}")
    return problems
