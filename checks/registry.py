"""Collects the queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import with_sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, since two engines add them in different orders.

    Six decimals, or two from a billion on, where a double holds no more.
    """

    def rounded(name: str):
        value = F.col(f"`{name}`")
        return F.when(F.abs(value) >= 1e9, F.round(value, 2)).otherwise(F.round(value, digits)).alias(name)

    return df.select(*[rounded(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def r(expr: str, digits: int = 6) -> str:
    """The same rounding in the checking SQL, half up on the decimal value."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(30, 12)), {digits}) AS DOUBLE)"


def big(expr: str) -> str:
    """:func:`r` for values that may pass a billion."""
    return f"CASE WHEN ABS({expr}) >= 1e9 THEN {r(expr, 2)} ELSE {r(expr)} END"


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(query(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_sources(sql.strip())
        return query

    return keep
