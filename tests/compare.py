"""Run registered queries against their DuckDB SQL: ``python tests/compare.py SF_DIR [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def differences(spark_df, con, sql):
    """None when both give the same rows, else a short text."""
    result = con.execute(sql)
    expected = canonical([c[0] for c in result.description], result.fetchall())
    actual = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if actual[1] != expected[1]:
        extra, missing = set(actual[1]) - set(expected[1]), set(expected[1]) - set(actual[1])
        return f"rows {len(actual[1])} vs {len(expected[1])}; extra {sorted(extra)[:2]}, missing {sorted(missing)[:2]}"
    return None


def main() -> None:
    from conftest import session

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con, oracle = session(), duck(sf_dir), entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        problem = differences(query(spark, sf_dir), con, oracle[name]) if name in oracle else f"{query(spark, sf_dir).count()} rows, no SQL"
        failed += problem is not None and name in oracle
        print(f"{name:28s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
