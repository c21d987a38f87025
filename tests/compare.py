"""Run registered queries against their SQL: ``python tests/compare.py <sf dir> [name …]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, sf_dir: str, name: str, build, sql: str) -> list[str]:
    got = build(spark, sf_dir)
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(got.columns) != sorted(names):
        return [f"{name}: columns {sorted(got.columns)} against {sorted(names)}"]
    want_types = dict(zip(names, (str(d[1]) for d in expected.description)))
    found = _bag(got.columns, [tuple(r) for r in got.collect()])
    wanted = _bag(names, expected.fetchall())
    problems = []
    same = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    for column, spark_type in got.dtypes:
        if same.get(spark_type) != want_types[column]:
            problems.append(f"{name}: type of {column} is {spark_type} against {want_types[column]}")
    if found != wanted:
        extra, missing = list((found - wanted).items())[:2], list((wanted - found).items())[:2]
        problems.append(
            f"{name}: {found.total()} rows against {wanted.total()}; extra {extra}; missing {missing}"
        )
    elif not found:
        problems.append(f"{name}: no rows")
    return problems


def main() -> int:
    sys.path.insert(0, str(ROOT))
    from __spark_entry__ import oracle_sql, queries
    from matchloom.session import build_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = differences(spark, connection, sf_dir, name, build, oracles[name])
            else:
                problems = [] if build(spark, sf_dir).count() else [f"{name}: no rows"]
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            problems = [f"{name}: {type(error).__name__} {str(error)[:1500]}"]
        bad += bool(problems)
        note = "ok" if not problems else "FAIL"
        print(f"{note} {name} {time.time() - start:.1f}s{'' if name in oracles else ' (rows only)'}", flush=True)
        for problem in problems:
            print("   ", problem, flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
