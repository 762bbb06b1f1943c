"""Run registered queries and their SQL side by side.

``python tests/compare.py [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from plumbline.plans.oracles import TABLES  # noqa: E402


def duckdb_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value: object) -> object:
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of_duckdb(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return names, [tuple(map(_plain, row)) for row in result.fetchall()]


def sorted_rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    moved = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(moved, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def difference(spark, connection, query, sql: str, folder: str) -> str | None:
    """None if results agree in columns, types of numbers and every value."""
    got = query(spark, folder)
    got_names, got_rows = sorted_rows(got.columns, [tuple(map(_plain, r)) for r in got.collect()])
    want_names, want_rows = sorted_rows(*rows_of_duckdb(connection, sql))
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows != {len(want_rows)}"
    bad = [(g, w) for g, w in zip(got_rows, want_rows) if g != w or list(map(type, g)) != list(map(type, w))]
    if bad:
        return f"{len(bad)} of {len(got_rows)} rows differ, first: {bad[0][0]} != {bad[0][1]}"
    return None


def main() -> None:
    import __spark_entry__
    from plumbline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled=False, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_connection(folder)
    sql = __spark_entry__.oracle_sql()
    bad = 0
    for name, query in __spark_entry__.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            if name in sql:
                problem = difference(spark, connection, query, sql[name], folder)
            else:
                problem = None if query(spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - began:7.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
