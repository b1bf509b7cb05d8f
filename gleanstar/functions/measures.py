"""Aggregate expressions shared by profiling, audit and validation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanstar.functions.text import col

# Rank error of a sketch is rows / ACCURACY; small groups come out exact.
ACCURACY = 10_000


def rows() -> Column:
    return F.count(F.lit(1))


def null_count(c: Column | str) -> Column:
    return F.count_if(col(c).isNull())


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part, whole) * 100, digits)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part, whole), digits)


def outside(c: Column | str, lo, hi) -> Column:
    """NULL when the value is NULL, so NULLs are not counted as violations."""
    return ~col(c).between(lo, hi)


def varies(c: Column | str) -> Column:
    """The group holds more than one distinct non-null value.

    Equal to COUNT(DISTINCT c) > 1, but from two mergeable aggregates.
    """
    return F.coalesce(F.min(col(c)) < F.max(col(c)), F.lit(False))


def sketch(c: Column | str, probs: Iterable[float], accuracy: int = ACCURACY) -> Column:
    """Quantiles that are values of the data, from a mergeable sketch."""
    return F.percentile_approx(col(c), [float(p) for p in probs], accuracy)


def n_tiles(n: int) -> list[float]:
    return [i / n for i in range(n + 1)]


def any_true(flags: Iterable[Column | str]) -> Column:
    out = None
    for flag in flags:
        out = col(flag) if out is None else out | col(flag)
    return out
