"""Stored quantile sketches: computed once per table version and group, merged on demand.

A sketch table holds, per group and column, a KLL sketch with the number of values, NULLs,
smallest, largest and total value: a few kilobytes whatever the rows behind it. Quartiles,
medians, percentiles, ranks and averages of the whole table or of coarser groups come from
merging these rows, so no statement reads the table again, and new rows are added by
merging their sketches with the stored ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.functions.measures import null_count

# Size parameter of a sketch: larger is nearer.
K = 4096


def rank_error(k: int = K) -> float:
    """The published normalised rank error of a KLL sketch, which holds with 99 % confidence;
    merging does not raise it."""
    return 2.296 / k**0.9723


def sketch_table(df: DataFrame, columns: Mapping[str, Column] | Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One row per group and column: the group columns, column_name, n, nulls, min_val, max_val,
    total, sketch. Values are read as doubles; NaN counts as NULL. Every task's partial
    sketches are merged, so a hot group costs one row a task."""
    exprs = dict(columns) if isinstance(columns, Mapping) else {c: F.col(c) for c in columns}
    aggs = []
    for i, c in enumerate(exprs.values()):
        v = c.cast("double")
        v = F.when(~F.isnan(v), v)
        one = F.struct(
            F.count(v).alias("n"), null_count(v).alias("nulls"), F.min(v).alias("min_val"), F.max(v).alias("max_val"), F.sum(v).alias("total"),
            F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"),
        )
        aggs.append(one.alias(f"_{i}"))
    wide = df.groupBy(*by).agg(*aggs)
    lines = [F.struct(F.lit(name).alias("column_name"), F.col(f"_{i}").alias("_s")) for i, name in enumerate(exprs)]
    return wide.select(*by, F.inline(F.array(*lines))).select(*by, "column_name", "_s.*")


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups (by default one per column), or of several sketch tables."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("min_val").alias("min_val"), F.max("max_val").alias("max_val"),
        F.sum("total").alias("total"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def added(stored: DataFrame, new: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A stored sketch table with the sketches of new rows."""
    return merged(stored.unionByName(new), by)


def quantile(prob: float | Sequence[float]) -> Column:
    """Quantiles of a sketch row that are values of the data; NULL without values. The ends are exact."""
    if not isinstance(prob, float | int):
        return F.when(F.col("n") > 0, F.array(*[quantile(p) for p in prob]))
    if prob in (0, 1):
        return F.col("max_val" if prob else "min_val")
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(prob))))


def quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """group columns, column_name, n, quantiles (in the order of probs)."""
    return merged(sketches, by).select(*by, "column_name", "n", quantile(list(probs)).alias("quantiles"))


def ranks(sketches: DataFrame, values: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """group columns, column_name, n, ranks: the share of values not above each given one."""
    at = F.array(*[F.kll_sketch_get_rank_double("sketch", F.lit(float(v))) for v in values])
    return merged(sketches, by).select(*by, "column_name", "n", F.when(F.col("n") > 0, at).alias("ranks"))


def numeric_summary(sketches: DataFrame, by: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """group columns, column_name, min_val, max_val, avg_val, quartiles, without the table."""
    return merged(sketches, by).select(
        *by, "column_name", "min_val", "max_val", F.round(F.try_divide("total", "n"), digits).alias("avg_val"),
        quantile([0.0, 0.25, 0.5, 0.75, 1.0]).alias("quartiles"),
    )


def duration_distribution(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """group columns, column_name, n, min, median, 95th percentile and max, without the table."""
    return merged(sketches, by).select(
        *by, "column_name", "n", F.col("min_val"), quantile(0.5).alias("p50"), quantile(0.95).alias("p95"), F.col("max_val")
    )


def group_median(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """group columns, column_name, median."""
    return merged(sketches, by).select(*by, "column_name", quantile(0.5).alias("median"))
