"""Compare a registered query with its SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import numpy as np


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(map(_plain, r)) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=repr)


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = sorted(rel.columns)
    quoted = ", ".join(f'"{n}"' for n in names)
    rows = con.sql(f"select {quoted} from ({sql})").fetchall()
    return names, sorted((tuple(map(_plain, r)) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs first."""
    left_names, left = rows_of_spark(df)
    right_names, right = rows_of_duck(con, sql)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}; only spark {list(set(left) - set(right))[:3]}, only sql {list(set(right) - set(left))[:3]}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"
    return None
