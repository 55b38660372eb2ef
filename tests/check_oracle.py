"""Compare registered queries with their SQL: python tests/check_oracle.py [sf] [name..]"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _sorted(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def mismatch(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """First difference between a DataFrame and a SQL result, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _sorted(names, result.fetchall())
    have = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(have):
        return f"{len(have)} rows != {len(want)}"
    for w, h in zip(want, have):
        if w != h:
            return f"columns {sorted(names)}\n  spark {h}\n  sql   {w}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(), connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    wanted = sys.argv[2:] or list(queries())
    for name in wanted:
        start = time.time()
        try:
            problem = mismatch(queries()[name](spark, sf_dir), con, sqls[name])
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
