"""Run a query on Spark and its SQL on DuckDB, and compare the results as multisets of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "pages", "benchmark", "labels")


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as text; empty if names, types, row counts and values agree."""
    found = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in found.description}
    names, expected = _bag(list(sql_types), found.fetchall())
    got_names, got = _bag(df.columns, df.collect())
    if names != got_names:
        return [f"columns {got_names} instead of {names}"]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    problems = [
        f"{f.name}: {f.dataType.simpleString()} against {sql_types[f.name]}"
        for f in df.schema.fields
        if kinds.get(f.dataType.simpleString()) != sql_types[f.name]
    ]
    missing, extra = expected - got, got - expected
    if missing or extra:
        problems.append(f"{sum(missing.values())} rows missing, {sum(extra.values())} unexpected of {sum(expected.values())}")
        problems += [f"missing {r}" for r in list(missing)[:3]] + [f"unexpected {r}" for r in list(extra)[:3]]
    return problems
