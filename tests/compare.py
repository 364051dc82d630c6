"""Compare a Spark result with a DuckDB result, whatever their row order.

Run as ``python -m tests.compare <folder> [name ...]`` to check registered queries and print their times.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time

import duckdb


def given_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _value(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, connection, sql: str) -> str | None:
    """None if both results agree, else what differs first."""
    got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = connection.execute(sql)
    types = {c[0]: str(c[1]).lower() for c in result.description}
    mine = {f.name: f.dataType.simpleString().replace("string", "varchar") for f in spark_df.schema.fields}
    if types != mine:
        return f"types {sorted(set(types.items()) ^ set(mine.items()))}"
    expected = normal([c[0] for c in result.description], result.fetchall())
    if got[0] != expected[0]:
        return f"columns {got[0]} against {expected[0]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows against {len(expected[1])}"
    for mine, theirs in zip(got[1], expected[1], strict=True):
        if mine != theirs:
            return f"{got[0]}: {mine} against {theirs}"
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from remitlens.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, failed = given_tables(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start, took = time.time(), 0.0
        try:
            df = query(spark, folder)
            df.collect()
            took = time.time() - start
            problem = differences(df, connection, oracle[name]) if name in oracle else f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            connection = given_tables(folder)
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {took:6.2f}s {name} {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
