"""Global numbering, running totals, tiers and exact quantiles without a one-task sort.

The common step is `sorted_table`: the rows are range-partitioned by the key, sorted
within each partition and stored, one file per partition. A row's global position is
then the number of rows in earlier partitions plus its position in its own file, so
numbering costs one shuffle and one write, and reading the result costs a scan. Because
positions come from the stored files, a recomputed task cannot shift them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleanstar.functions.measures import any_true, rows
from gleanstar.operators.joins import as_list
from gleanstar.session import stage


def sorted_table(df: DataFrame, order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """df stored in ascending key order (NULLs first), with `_part`, the number of the key
    range, and `_pos`, the 0-based position within it.

    There are `buckets` ranges, or as many as the session has shuffle partitions, of which
    AQE joins small neighbours up to its advisory size. Runs when it is called."""
    order = as_list(order)
    ranged = df.repartitionByRange(*([buckets] if buckets else []), *order).sortWithinPartitions(*order)
    stored = stage(ranged.withColumn("_part", F.spark_partition_id()), "sorted")
    return stored.select("*", F.col("_metadata.row_index").alias("_pos"))


def _before(table: DataFrame, weight: Column) -> DataFrame:
    """Total weight in earlier ranges: one row per range, hence bounded."""
    totals = table.groupBy("_part").agg(F.sum(weight).alias("_sum"))
    return totals.select(
        F.col("_part").alias("_p"), (F.sum("_sum").over(W.orderBy("_part")) - F.col("_sum")).alias("_before")
    )


def _add_before(table: DataFrame, weight: Column) -> DataFrame:
    before = _before(table, weight)
    return table.join(F.broadcast(before), F.col("_part") == F.col("_p"), "inner").drop("_p")


def global_row_number(
    df: DataFrame, order: str | Sequence[str], name: str, buckets: int | None = None
) -> DataFrame:
    """Dense 1..n in the order of a unique key, NULLs first; first column of the result."""
    table = _add_before(sorted_table(df, order, buckets), F.lit(1))
    number = (F.col("_before") + F.col("_pos") + 1).cast("bigint")
    return table.select(number.alias(name), *df.columns)


def running_total(
    df: DataFrame, order: str | Sequence[str], name: str, weight: str, buckets: int | None = None
) -> DataFrame:
    """Inclusive running total of `weight` over the whole table in the order of a unique key."""
    order = as_list(order)
    table = _add_before(sorted_table(df, order, buckets), F.col(weight))
    in_range = W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = (F.sum(weight).over(in_range) + F.col("_before")).cast("bigint")
    return table.select(*df.columns, total.alias(name))


def small_row_number(df: DataFrame, order: str | Sequence[str], name: str) -> DataFrame:
    """Plain numbering for tables that are small by construction (junk dimension)."""
    return df.select(F.row_number().over(W.orderBy(*as_list(order))).cast("bigint").alias(name), *df.columns)


def ntile_tier(
    df: DataFrame, order: str | Sequence[str], tiers: int, name: str, buckets: int | None = None
) -> DataFrame:
    """Balanced tiers 1..tiers; the first n mod tiers tiers hold one row more."""
    numbered = global_row_number(df, order, "_i", buckets)
    n = numbered.select(rows().alias("n")).scalar()
    k = F.lit(tiers).cast("bigint")
    i = F.col("_i") - 1
    base, extra = F.floor(n / k), n % k
    cut = extra * (base + 1)
    tier = F.when(i < cut, F.floor(i / (base + 1))).otherwise(
        extra + F.floor((i - cut) / F.greatest(base, F.lit(1)))
    )
    return numbered.select(*df.columns, (tier + 1).cast("int").alias(name))


def pick_one_per_key(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """The first row per key in a total order.

    The filter on the rank lets Spark keep one row per key and task before the shuffle.
    """
    keys = as_list(keys)
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    out = ranked.filter(F.col("_rank") == 1).drop("_rank")
    return out.select(*columns) if columns else out


def exact_quantiles(
    df: DataFrame,
    metrics: Sequence[str],
    probs: Sequence[float],
    discrete: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Quantiles per metric column: metric, n, prob, value (as double).

    Interpolated, or with `discrete` the smallest value that at least that share of
    the rows do not exceed. Works on the (metric, value) counts, so repeated values
    collapse before they are ordered, and reads off the values at the wanted ranks:
    no task sees more than its range of distinct values.
    """
    long = df.unpivot([], [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("metric", "value").agg(rows().alias("c"))
    placed = running_total(counts, ["metric", "value"], "upto", "c", buckets)
    # One row per metric, hence bounded by the argument list.
    spans = placed.groupBy(F.col("metric").alias("_m")).agg(F.sum("c").alias("n"))
    first = spans.withColumn("_start", F.sum("n").over(W.orderBy("_m")) - F.col("n"))
    ranks = []
    for p in probs:
        exact = F.lit(float(p)) * (F.col("n") if discrete else F.col("n") - 1)
        if discrete:
            left = F.greatest(F.ceil(F.round(exact, 6)) - 1, F.lit(0))
            right, frac = left, F.lit(0.0)
        else:
            left = F.floor(exact)
            right, frac = F.least(left + 1, F.col("n") - 1), exact - left
        ranks.append(
            F.struct(
                F.lit(float(p)).alias("prob"),
                (F.col("_start") + left).alias("left"),
                (F.col("_start") + right).alias("right"),
                frac.alias("frac"),
            )
        )
    targets = first.select("_m", "n", *[r.alias(f"_t{i}") for i, r in enumerate(ranks)])

    def holds(rank: Column) -> Column:
        return (F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto"))

    def wanted(t: str) -> Column:
        return holds(F.col(f"{t}.left")) | holds(F.col(f"{t}.right"))

    joined = placed.join(F.broadcast(targets), F.col("metric") == F.col("_m"), "inner")
    names = [f"_t{i}" for i in range(len(ranks))]
    # Only the one or two values around each wanted rank pass this filter.
    near = joined.filter(any_true(wanted(t) for t in names))
    hits = near.select("metric", "value", "c", "upto", "n", F.explode(F.array(*names)).alias("t")).filter(wanted("t"))
    part = F.when(holds(F.col("t.left")), F.col("value") * (1 - F.col("t.frac"))).otherwise(0.0) + F.when(
        holds(F.col("t.right")), F.col("value") * F.col("t.frac")
    ).otherwise(0.0)
    return hits.groupBy("metric", "n", F.col("t.prob").alias("prob")).agg(F.sum(part).alias("value"))
