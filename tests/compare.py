"""Run registered queries in Spark and their SQL in DuckDB, and compare all rows.

    python -m tests.compare FOLDER [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(int(value)))
    if isinstance(value, (int, float)):
        return (2, "nan" if isinstance(value, float) and math.isnan(value) else repr(float(value)))
    return (3, str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: [_key(v) for v in r])
    return [columns[i] for i in order], data


def run_sql(con, sql: str):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def run_spark(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def difference(spark_result, sql_result) -> str | None:
    """None when equal; otherwise the first difference."""
    (cols_a, rows_a), (cols_b, rows_b) = spark_result, sql_result
    if cols_a != cols_b:
        return f"columns {cols_a} != {cols_b}"
    if len(rows_a) != len(rows_b):
        return f"{len(rows_a)} rows != {len(rows_b)} rows"
    for a, b in zip(rows_a, rows_b):
        for name, x, y in zip(cols_a, a, b):
            if x != y or type(x) is not type(y):
                return f"{name}: {x!r} != {y!r} in\n    {a}\n    {b}"
    return None


def main(folder: str, prefixes: list[str]) -> int:
    import __spark_entry__ as entry
    from paylake.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            ours = run_spark(query(spark, folder))
            took = time.time() - start
            problem = difference(ours, run_sql(con, sql[name])) if name in sql else None
            note = "" if name in sql else " (no SQL)"
            rows = len(ours[1])
        except Exception as error:  # report every query, then fail
            problem, took, note, rows = f"{type(error).__name__}: {str(error)[:600]}", 0, "", -1
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={rows} {took:.2f}s{note}" +
              (f"\n    {problem}" if problem else ""), flush=True)
    print(f"{bad} differences")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
