"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def normalized(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else the first difference."""
    spark_columns, spark_rows = normalized(df.columns, df.collect())
    relation = con.sql(sql)
    sql_columns, sql_rows = normalized(list(relation.columns), relation.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} vs {sql_columns}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows vs {len(sql_rows)}"
    for a, b in zip(spark_rows, sql_rows):
        if a != b:
            return f"{a} vs {b}"
    return None


def main() -> int:
    from conftest import make_session

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(entry.queries())
    spark, con, failed = make_session(), connect(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else (None if df.count() >= 0 else "no rows")
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
