"""Run queries next to their SQL and compare whole results.

``python -m tests.oracle FOLDER [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

from lanewise.catalog.oracles import all_oracles
from lanewise.catalog.queries import all_queries


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def _sort_key(row):
    return tuple(
        (v is None, type(v).__name__ if not isinstance(v, (int, float)) else "number",
         v if v is not None else 0)
        for v in row
    )


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=_sort_key)


def _kind(name: str) -> str:
    name = name.lower()
    if name in ("long", "bigint"):
        return "bigint"
    if name in ("string", "varchar"):
        return "string"
    return name


def compare(connection, name: str, result) -> str | None:
    """None if equal, else the first difference."""
    found = result.collect()
    query = connection.execute(all_oracles()[name])
    expected_names = [d[0] for d in query.description]
    expected_kinds = {d[0]: _kind(str(d[1])) for d in query.description}
    kinds = {f.name: _kind(f.dataType.typeName()) for f in result.schema.fields}
    names, left = _rows(result.columns, found)
    expected_names, right = _rows(expected_names, query.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if kinds != expected_kinds:
        return f"types differ: { {k: (v, expected_kinds[k]) for k, v in kinds.items() if v != expected_kinds[k]} }"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for mine, other in zip(left, right):
        for column, a, b in zip(names, mine, other):
            if a != b and not (
                isinstance(a, float) and isinstance(b, (int, float))
                and abs(a - b) <= 1.5e-6 + 1e-9 * abs(b)
            ):
                return f"{column}: {a!r} != {b!r} in {mine} / {other}"
    exact = sum(a != b for a, b in zip(left, right))
    return f"~{exact} rows differ in the last place" if exact else None


def main() -> None:
    from tests.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    connection = connect(folder)
    bad = 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(connection, name, query(spark, folder))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
