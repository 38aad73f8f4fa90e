"""Compare queries with their SQL: ``python tests/oracle_check.py [folder] [query …]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def compare(spark_frame, connection, sql: str) -> str:
    """'' when names, types and rows agree, else what differs."""
    names = sorted(spark_frame.columns)
    found = sorted((tuple(r) for r in spark_frame.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    relation = connection.sql(f"SELECT * FROM ({sql})")
    if sorted(relation.columns) != names:
        return f"columns {names} against {sorted(relation.columns)}"
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = sorted(connection.execute(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    wrong = [(n, k, types[n]) for n, k in spark_frame.dtypes if kinds.get(types[n]) != k]
    if wrong:
        return f"types {wrong}"
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    for left, right in zip(found, expected):
        for a, b in zip(left, right):
            same = math.isclose(a, b, rel_tol=1e-9) if isinstance(a, float) and isinstance(b, float) else a == b
            if not same:
                return f"{left} against {right}"[:1500]
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from reviewloom.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                              "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    wanted = sys.argv[2:] or list(queries())
    bad = 0
    for name in wanted:
        started = time.time()
        try:
            difference = compare(queries()[name](spark, folder), connection, oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(difference)
        print(f"{'ok ' if not difference else 'BAD'} {name} {time.time() - started:.1f}s {difference}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
