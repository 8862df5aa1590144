"""Compare a registered query with its SQL: names, types, rows and values."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

_FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "hugeint": "int",
    "float": "float", "double": "float", "string": "text", "varchar": "text",
    "timestamp_ntz": "time", "timestamp": "time", "date": "date", "boolean": "bool",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def difference(connection: duckdb.DuckDBPyConnection, sql: str, result: DataFrame) -> str | None:
    """What differs, or None."""
    cursor = connection.execute(sql)
    theirs = {d[0]: str(d[1]).lower() for d in cursor.description}
    ours = dict(result.dtypes)
    if sorted(theirs) != sorted(ours):
        return f"columns {sorted(set(theirs) ^ set(ours))}"
    for name, kind in ours.items():
        if _FAMILY.get(kind, kind) != _FAMILY.get(theirs[name], theirs[name]):
            return f"type of {name}: {kind} and {theirs[name]}"
    names = sorted(ours)
    at = [list(theirs).index(name) for name in names]
    expected = Counter(tuple(_value(row[i]) for i in at) for row in cursor.fetchall())
    found = Counter(tuple(map(_value, row)) for row in result.select(*(f"`{n}`" for n in names)).collect())
    if expected == found:
        return None
    return (
        f"{sum(found.values())} rows, {sum(expected.values())} expected;"
        f" only here {list((found - expected).items())[:2]}; only in SQL {list((expected - found).items())[:2]}"
    )
