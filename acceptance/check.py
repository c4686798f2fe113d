"""Compare queries with their SQL: `python -m acceptance.check [sf_dir] [name ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from acceptance.oracle import statements
from acceptance.queries import all_queries
from clickloom.session import build_session

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, db: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """None when both give the same rows, else what differs."""
    frame = all_queries()[name](spark, sf_dir)
    result = db.execute(statements()[name])
    names = [c[0] for c in result.description]
    types = {c: TYPES[t] for c, t in frame.dtypes}
    theirs = {c[0]: str(c[1]) for c in result.description}
    if types != theirs:
        return f"types {types} != {theirs}"
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    ours, theirs = rows_of(frame.columns, frame.collect()), rows_of(names, result.fetchall())
    if ours == theirs:
        return None
    differing = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]][:3]
    return f"{len(ours)} rows != {len(theirs)} rows; {differing}"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("acceptance", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    db, failures = views(sf_dir), 0
    for name in names or all_queries():
        began = time.time()
        try:
            problem = compare(spark, db, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {error}"[:1500]
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
