"""Run registered queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def canonical(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "null"
        return repr(value + 0.0)
    if isinstance(value, int):
        return repr(float(value))
    if hasattr(value, "as_tuple"):
        return repr(float(value))
    return str(value)


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, connection, folder: str, name: str, run, sql: str | None) -> str:
    """'' when equal, else what differs."""
    frame = run(spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    if sql is None:
        return "" if rows else "no rows"
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    left_names, left = canonical_rows(frame.columns, rows)
    right_names, right = canonical_rows(names, cursor.fetchall())
    if left_names != right_names:
        return f"columns {left_names} against {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return "" if not different else f"{len(different)} of {len(left)} rows differ, first {different[0]}"


def main() -> int:
    from tabloom.catalog import all_queries
    from tabloom.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark, connection, failed = local_session(), duck(folder), 0
    for name, entry in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        started = time.time()
        try:
            problem = compare(spark, connection, folder, name, entry.run, entry.sql)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "rows" if entry.sql is None else "sql"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {time.time() - started:6.2f}s {name} {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
