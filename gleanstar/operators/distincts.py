"""Several exact distinct counts in one scan.

A row gives one line (count number, 128 bits that tell its value) per count; equal lines
meet within the task before one shuffle, and the lines left are counted by number. The row
count and NULL counts come from the same lines. Integers, dates, times and booleans stand for
themselves, other values and tuples are told apart by two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanstar.operators.joins import as_list

_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def _line(number: int, first: Column, second: Column, present: Column | None = None) -> Column:
    line = F.struct(F.lit(number).alias("_k"), first.alias("_a"), second.alias("_b"))
    return line if present is None else F.when(present, line)


def _identity(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits that differ for different values."""
    if len(columns) == 1:
        kind, value = df.schema[columns[0]].dataType, F.col(columns[0])
        if isinstance(kind, _EXACT):
            return value.cast("bigint"), F.lit(0).cast("bigint")
        if isinstance(kind, T.DateType):
            return F.unix_date(value).cast("bigint"), F.lit(0).cast("bigint")
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(value), F.lit(0).cast("bigint")
    values = [F.col(c) for c in columns]
    return F.xxhash64(*values), F.xxhash64(F.lit(1), *values, F.lit(2))


def distinct_counts(
    df: DataFrame, keys: Mapping[str, str | Sequence[str]], nulls: Mapping[str, Column] | None = None, total: str | None = None
) -> DataFrame:
    """One row: the number of rows (if a name is given for it), the exact number of distinct
    values of each key or key tuple (those with a NULL part are not counted), and the rows
    for which each condition holds."""
    zero = F.lit(0).cast("bigint")
    lines, names = [], []

    def add(name: str, line: Column, value: str) -> None:
        lines.append(line)
        names.append((name, value))

    if total is not None:
        add(total, _line(len(names), zero, zero), "_n")
    for name, key in keys.items():
        columns = as_list(key)
        present = None
        for c in columns:
            present = F.col(c).isNotNull() if present is None else present & F.col(c).isNotNull()
        add(name, _line(len(names), *_identity(df, columns), present), "_d")
    for name, condition in (nulls or {}).items():
        add(name, _line(len(names), zero, zero, condition), "_n")
    tagged = df.select(F.inline(F.array_compact(F.array(*lines))))
    values = tagged.groupBy("_k", "_a", "_b").agg(F.count(F.lit(1)).alias("_n"))
    counts = values.groupBy("_k").agg(F.count(F.lit(1)).alias("_d"), F.sum("_n").alias("_n"))
    return counts.agg(
        *[F.coalesce(F.max(F.when(F.col("_k") == k, F.col(value))), F.lit(0)).alias(name) for k, (name, value) in enumerate(names)]
    )
