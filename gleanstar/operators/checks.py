"""Checks that are computed while a table is written.

A check is a named aggregate over the rows of the table: a count of rows that are NULL,
flagged, outside a domain, malformed or impossible. `Warehouse.save(..., checks=)` observes
all checks of a table in the write itself, so validating a table costs no scan of its own,
and the results are kept with the version they belong to. The builders return mappings that
can be merged: `{**row_count(), **nulls(["a"]), **flags(["f"])}`.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanstar.functions import measures as m
from gleanstar.functions.text import malformed_code

Checks = Mapping[str, Column]
Results = dict[str, object]


def row_count(name: str = "row_count") -> dict[str, Column]:
    return {name: m.rows()}


def counts(rules: Mapping[str, Column]) -> dict[str, Column]:
    """Rows per rule; a rule that is NULL counts as not met."""
    return {name: F.count_if(rule) for name, rule in rules.items()}


def nulls(columns: Sequence[str]) -> dict[str, Column]:
    return {f"null_{c}": m.null_count(c) for c in columns}


def flags(columns: Sequence[str]) -> dict[str, Column]:
    return counts({f"n_{c}": F.col(c) for c in columns})


def outside_domain(column: str, allowed: Sequence, name: str | None = None) -> dict[str, Column]:
    """Rows whose value is none of those allowed (NULL is no violation)."""
    return counts({name or f"outside_{column}": ~F.col(column).isin(*allowed)})


def code_format(column: str, width: int = 5, name: str = "malformed") -> dict[str, Column]:
    return counts({name: malformed_code(column, width)})


def standardized(normalisers: Mapping[str, Column], name: str = "unstandardized_rows") -> dict[str, Column]:
    """Rows where any column differs from its own normal form."""
    return counts({name: m.any_true(F.col(c) != n for c, n in normalisers.items())})


def pattern_rows(column: str, pattern: str, name: str = "matching_rows") -> dict[str, Column]:
    return counts({name: F.col(column).rlike(pattern)})


def mutually_exclusive(first: str, second: str, name: str = "overlap_rows") -> dict[str, Column]:
    return counts({name: F.col(first) & F.col(second)})


def reconcile(parts: Sequence[str], whole: Column) -> dict[str, Column]:
    """Rows in any part, and the base population they should add up to."""
    return counts({"combined": m.any_true(parts), "baseline": whole})


def non_negative(columns: Sequence[str], zero: Sequence[str] = ()) -> dict[str, Column]:
    return counts({f"negative_{c}": F.col(c) < 0 for c in columns} | {f"zero_{c}": F.col(c) == 0 for c in zero})


def null_equivalence(a: str, b: str, name: str = "null_mismatch") -> dict[str, Column]:
    return counts({name: F.col(a).isNull() != F.col(b).isNull()})


def value_range(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{f}_{c}": getattr(F, f)(c) for c in columns for f in ("min", "max")}


class ChecksFailed(ValueError):
    """A required check counted rows; the table keeps the version it had."""

    def __init__(self, table: str, failed: Results, results: Results):
        super().__init__(f"{table}: {failed}")
        self.table, self.failed, self.results = table, failed, results


def observed(df: DataFrame, checks: Checks) -> tuple[DataFrame, Observation]:
    """df with the checks attached: their results are there once an action has run on it.

    They stand at the top of the plan, so they are counted by the tasks that write, each of
    which counts once however often it is tried.
    """
    watch = Observation()
    return df.observe(watch, *[c.alias(name) for name, c in checks.items()]), watch


def plain(value):
    """A result as JSON has it."""
    if isinstance(value, dt.datetime | dt.date):
        return value.isoformat()
    return float(value) if isinstance(value, decimal.Decimal) else value


def as_frame(spark: SparkSession, results: Results, names: Sequence[str] | None = None) -> DataFrame:
    """Counts as one row, as the checks that scan a stored table return them."""
    names = list(results) if names is None else list(names)
    return spark.createDataFrame([tuple(results[n] for n in names)], ", ".join(f"`{n}` long" for n in names))


def parity(spark: SparkSession, source: Results, target: Results, name: str = "row_count") -> DataFrame:
    """Rows of two stored tables and the difference, from the results kept with them."""
    rows = {"source_rows": source[name], "target_rows": target[name], "removed": source[name] - target[name]}
    return as_frame(spark, rows)


def domain_listing(df: DataFrame, column: str, allowed: Sequence, results: Results, name: str | None = None) -> DataFrame:
    """Values outside the domain with their rows; read from the table only if there are any."""
    kept = df.filter(~F.col(column).isin(*allowed))
    if not results[name or f"outside_{column}"]:
        kept = df.sparkSession.createDataFrame([], df.schema)
    return kept.groupBy(column).agg(m.rows().alias("n"))
