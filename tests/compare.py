"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in VIEWS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _bag(rows, order):
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, types and the bag of rows agree exactly."""
    result = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in result.description}
    duck_names = list(duck_types)
    spark_types = dict(df.dtypes)
    problems = []
    if sorted(spark_types) != sorted(duck_names):
        return [f"columns: spark {sorted(spark_types)} oracle {sorted(duck_names)}"]
    for name, kind in spark_types.items():
        if KINDS.get(kind) != duck_types[name]:
            problems.append(f"type of {name}: spark {kind} oracle {duck_types[name]}")
    names = sorted(spark_types)
    got = _bag(df.collect(), [df.columns.index(n) for n in names])
    want = _bag(result.fetchall(), [duck_names.index(n) for n in names])
    if not want:
        problems.append("the oracle gives no rows")
    if got != want:
        missing, extra = want - got, got - want
        problems.append(
            f"{names}: {missing.total()} missing e.g. {list(missing)[:2]}; "
            f"{extra.total()} extra e.g. {list(extra)[:2]}"
        )
    return problems
