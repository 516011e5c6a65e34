"""Run registered queries in Spark and DuckDB and compare all their rows.

    python tests/oracle_check.py <folder> [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as spark_entry  # noqa: E402
from starloom.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()

DUCK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def differences(spark, connection, folder: str, name: str) -> list[str]:
    """What differs between the two results; empty when they agree or no SQL is given."""
    found = spark_entry.queries()[name](spark, folder)
    rows = Counter(tuple(row) for row in found.collect())
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return [] if rows else ["no rows"]
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    fetched = cursor.fetchall()
    if sorted(columns) != sorted(found.columns):
        return [f"columns {sorted(found.columns)} and {sorted(columns)}"]
    kinds = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    for name_, kind in found.dtypes:
        if kinds[name_] != DUCK_TYPES[kind]:
            return [f"{name_} is {kind} and {kinds[name_]}"]
    place = [columns.index(c) for c in found.columns]
    expected = Counter(tuple(row[i] for i in place) for row in fetched)
    problems = []
    if not expected:
        problems.append("empty oracle")
    if rows != expected:
        problems.append(
            f"{rows.total()} and {expected.total()} rows, e.g."
            f" {list((rows - expected).items())[:2]!r:.600} and"
            f" {list((expected - rows).items())[:2]!r:.600}"
        )
    return problems


def main() -> None:
    folder, *chosen = sys.argv[1:]
    spark = build_session(
        "oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name in chosen or spark_entry.queries():
        start = time.time()
        try:
            problems = differences(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:800]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.1f}s", *problems, flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
