"""Registration of queries with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.oracle_base import with_base
from contract.tables import Tables, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, text arrays joined: equal in every client."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind.startswith("timestamp") or kind == "date":
            c = c.cast("string")
        elif kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(name))
    return df.select(*out)


def five(df: DataFrame, column: str = "quartiles") -> DataFrame:
    """The five quartile values as columns q0..q4."""
    return df.select(
        *[c for c in df.columns if c != column],
        *[F.element_at(column, i + 1).alias(f"q{i}") for i in range(5)],
    )


def query(name: str, sql: str | None = None, text: str = ""):
    """Register `build(tables) -> DataFrame` under a name; `text` lists the columns the
    oracle has to cast to text."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: comparable(build(tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_base(sql, text)
        return build

    return register
