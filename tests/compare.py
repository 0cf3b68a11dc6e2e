"""Compare Spark results with the SQL twin, order-insensitive, by column name."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels",
    "benchmark", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v) else v for v in row)
        for row in frame.itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def assert_same(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> None:
    assert sorted(spark_frame.columns) == sorted(sql_frame.columns)
    left, right = _canonical(spark_frame), _canonical(sql_frame)
    assert len(left) == len(right), f"{len(left)} rows, expected {len(right)}"
    for a, b in zip(left, right):
        assert a == b, f"{a} != {b}"
