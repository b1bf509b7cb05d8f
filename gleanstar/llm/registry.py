"""Queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanstar.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def query(name: str, sql: str | None = None):
    """Register `build(spark, sf_dir) -> DataFrame`, with its oracle where SQL has one."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
