"""Compare a registered query with its DuckDB oracle, row by row, order aside."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _bag(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else what differs."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = _bag(names, result.fetchall())
    have = _bag(df.columns, [tuple(r) for r in df.collect()])
    if want == have:
        same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
        wrong = [
            (c, k, kinds[c]) for c, k in df.dtypes if same.get(k, kinds[c]) != kinds[c]
        ]
        return f"types {wrong}" if wrong else None
    return (
        f"{sum(have.values())} rows against {sum(want.values())}; "
        f"only here {list((have - want).items())[:2]}; only in SQL {list((want - have).items())[:2]}"
    )
