"""Run registered queries on Spark and their SQL on DuckDB and compare the results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _cell(value, tolerance):
    if value is None:
        return ("null",)
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("num", round(value, tolerance))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("num", float(value))
    return (type(value).__name__, value)


def _rows(columns, rows, tolerance):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(r[i], tolerance) for i in order) for r in rows), key=repr
    )


def differences(spark_df, con, sql, tolerance=9) -> list[str]:
    """Empty if both results have the same columns, types and rows."""
    relation = con.sql(sql)
    expected_rows, expected_columns = relation.fetchall(), relation.columns
    if sorted(spark_df.columns) != sorted(expected_columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"]
    found = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()], tolerance)
    expected = _rows(expected_columns, expected_rows, tolerance)
    if len(found) != len(expected):
        return [f"{len(found)} rows != {len(expected)}"]
    wrong = [f"{a} != {b}" for a, b in zip(found, expected, strict=True) if a != b]
    kinds = dict(zip(expected_columns, [str(t).lower() for t in relation.types], strict=True))
    names = {"int": "integer", "string": "varchar"}
    for name, kind in spark_df.dtypes:
        if names.get(kind, kind) != kinds[name]:
            wrong.append(f"type of {name}: {kind} != {kinds[name]}")
    return wrong
