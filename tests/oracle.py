"""Compare registered queries with their SQL in DuckDB. Also a script: python tests/oracle.py [sf] [key ...]"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, (Decimal, bool)) or value is None:
        return None if value is None else str(value)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return sorted((k, _plain(v)) for k, v in value.items())
    return str(value)


def canonical(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT", "binary": "BLOB"}


def compare(spark, con, query, sql: str, sf: str) -> str | None:
    """None when rows, columns and types agree, else what differs."""
    df = query(spark, sf)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = canonical(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema}
    wrong = {c: (expected[c], types[c]) for c in names if expected[c] != types[c].replace("DECIMAL(", "DECIMAL(") and "[" not in types[c]}
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        at = next(i for i, (a, b) in enumerate(zip(got, want)) if a != b)
        return f"row {at} of {sorted(names)}:\n  spark  {got[at][:1500]}\n  duckdb {want[at][:1500]}"
    if wrong:
        return f"types (spark, duckdb): {wrong}"
    return None


def main() -> None:
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    from tablewright.registry import all_queries, all_sql
    from tablewright.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, sql = all_queries(), all_sql()
    keys = sys.argv[2:] or list(queries)
    spark = build_session("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                                   "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for key in keys:
        started = time.time()
        try:
            if key in sql:
                difference = compare(spark, con, queries[key], sql[key], sf)
            else:
                difference = None
                print(f"   {key}: {queries[key](spark, sf).count()} rows, no SQL")
        except Exception as error:
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {key} {time.time() - started:.1f}s {difference or ''}", flush=True)
    print(f"{len(keys)} queries, {bad} bad")


if __name__ == "__main__":
    main()
