"""Run queries beside their checking SQL: python -m checks.compare [sf] [name ...]"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


def _rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def compare(spark: SparkSession, con, name: str, sf_dir: str, df: DataFrame | None = None) -> str | None:
    """None when equal, else what differs."""
    df = QUERIES[name](spark, sf_dir) if df is None else df
    got_columns, got = df.columns, [tuple(row) for row in df.collect()]
    if name not in ORACLES:
        return None if got else "no rows"
    result = con.execute(ORACLES[name])
    want_columns, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} / {sorted(want_columns)}"
    left, right = _rows(got_columns, got), _rows(want_columns, want)
    if left != right:
        a, b = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        return f"{len(left)} / {len(right)} rows; spark {a[:2]}; sql {b[:2]}"
    if not got:
        return "both empty"
    kinds = {d[0]: str(d[1]) for d in result.description}
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    odd = [(c, t, kinds[c]) for c, t in df.dtypes if types.get(t, t) != kinds[c]]
    return f"types {odd}" if odd else None


def main() -> None:
    from yearring.session import local_session

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name:32s} {'ok' if problem is None else problem}", flush=True)
    print(f"{len(names)} queries, {bad} problems, {dt.datetime.now():%H:%M}")


if __name__ == "__main__":
    main()
