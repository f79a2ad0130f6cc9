"""Run the checks in both engines: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import CHECKS
from stopwise.session import build_session

VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in VIEWS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(names, rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda place: names[place])
    return sorted(repr([(type(row[i]).__name__, _value(row[i])) for i in order]) for row in rows)


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None when both agree, else what differs first."""
    check = CHECKS[name]
    frame = check.query(spark, folder)
    mine = _rows(frame.columns, frame.collect())
    if check.sql is None:
        return None if mine else "no rows"
    result = connection.execute(check.sql)
    names = [column[0] for column in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(names)}"
    if mine == theirs:
        return None
    only = next(((a, b) for a, b in zip(mine, theirs, strict=False) if a != b), ("", ""))
    return f"{len(mine)} / {len(theirs)} rows\n    {only[0][:1500]}\n    {only[1][:1500]}"


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), 0
    for name in arguments[1:] or CHECKS:
        started = time.time()
        try:
            problem = difference(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name}")
        if problem is not None:
            print(f"    {problem}")
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
