"""Checks on built tables; each returns one row of evidence or the violating rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleanstar.functions import measures as m
from gleanstar.operators import checks
from gleanstar.operators.audit import (
    duplicate_combinations,
    orphan_count,
)
from gleanstar.operators.joins import as_list
from gleanstar.operators.profile import distinct_count, quantile_columns, table_profile


def scanned(df: DataFrame, wanted: checks.Checks) -> DataFrame:
    """Checks of a table that was stored without them, in one scan."""
    return df.agg(*[c.alias(name) for name, c in wanted.items()])


def row_parity(source: DataFrame, target: DataFrame, source_key: str | None = None) -> DataFrame:
    """Rows (or distinct keys) of the source, rows of the target and the difference."""
    count = distinct_count(source, source_key) if source_key else source.select(m.rows()).scalar()
    out = target.agg(m.rows().alias("target_rows")).withColumn("source_rows", count)
    return out.select("source_rows", "target_rows", (F.col("source_rows") - F.col("target_rows")).alias("removed"))


def pk_unique(df: DataFrame, *keys: str | Sequence[str]) -> DataFrame:
    return table_profile(df, keys=keys).withColumnRenamed("row_count", "total_rows")


def null_or_duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that are NULL or repeated."""
    bad = df.groupBy(key).agg(m.rows().alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1))
    return bad.agg(m.rows().alias("null_or_duplicate_keys"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return scanned(df, checks.nulls(columns))


def standardized(df: DataFrame, normalisers: Mapping[str, Column], name: str = "unstandardized_rows") -> DataFrame:
    """Rows where any column differs from its own normal form."""
    return scanned(df, checks.standardized(normalisers, name))


def pattern_rows(df: DataFrame, column: str, pattern: str, name: str = "matching_rows") -> DataFrame:
    return scanned(df, checks.pattern_rows(column, pattern, name))


def domain(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values outside the allowed set with their row counts."""
    return df.filter(~F.col(column).isin(*allowed)).groupBy(column).agg(m.rows().alias("n"))


def code_format(df: DataFrame, column: str, width: int = 5, name: str = "malformed") -> DataFrame:
    return scanned(df, checks.code_format(column, width, name))


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return scanned(df, checks.flags(flags))


def flagged_keys(df: DataFrame, flag: str, key: str) -> DataFrame:
    return df.filter(F.col(flag)).agg(F.count_distinct(key).alias("flagged_keys"))


def flagged_by_group(df: DataFrame, flag: str, group: str) -> DataFrame:
    return df.filter(F.col(flag)).groupBy(group).agg(m.rows().alias("n")).orderBy(F.desc("n"), group)


def mutually_exclusive(df: DataFrame, first: str, second: str) -> DataFrame:
    return scanned(df, checks.mutually_exclusive(first, second))


def reconcile(df: DataFrame, parts: Sequence[str], whole: Column) -> DataFrame:
    """Rows in any part against the base population they should add up to."""
    return scanned(df, checks.reconcile(parts, whole))


def flagged_groups_with_variety(df: DataFrame, flag: str, key: str, column: str) -> DataFrame:
    """Flagged keys that hold more than one distinct value of the column."""
    counts = df.filter(F.col(flag)).groupBy(key).agg(F.count_distinct(column).alias("n_distinct"))
    return counts.filter(F.col("n_distinct") > 1)


def non_negative(df: DataFrame, columns: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    return scanned(df, checks.non_negative(columns, zero))


def implication(df: DataFrame, impossible: Mapping[str, Column]) -> DataFrame:
    """Rows per combination of values that must not (or rarely) occur."""
    return scanned(df, checks.counts(impossible))


def null_equivalence(df: DataFrame, a: str, b: str, name: str = "null_mismatch") -> DataFrame:
    return scanned(df, checks.null_equivalence(a, b, name))


def forbidden_in_lookup(
    df: DataFrame, predicate: Column, other: DataFrame, key: str, name: str = "forbidden_rows"
) -> DataFrame:
    """Rows that meet the predicate although their key occurs in `other`."""
    counts = df.filter(predicate).groupBy(key).agg(m.rows().alias("_n"))
    found = counts.join(other.select(key).distinct(), key, "left_semi")
    return found.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))


def denormalized_consistency(df: DataFrame, key: str, column: str) -> DataFrame:
    """Keys for which a value copied from the parent is not constant."""
    varying = df.groupBy(key).agg(m.varies(column).alias("_v"))
    return varying.agg(F.count_if("_v").alias("inconsistent_keys"))


def dimension_coverage(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, name: str = "unmatched_rows"
) -> DataFrame:
    """Fact rows with a key that the dimension lacks."""
    return orphan_count(fact, dim, key, dim_key, name=name, count_null_keys=False)


def unmatched_combinations(fact: DataFrame, dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fact rows whose combination of flags equals no dimension row (a NULL equals nothing)."""
    counts = fact.groupBy(*columns).agg(m.rows().alias("_n"))
    missing = counts.join(dim.select(*columns).distinct(), list(columns), "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("unmatched_rows"))


def schema_excludes(df: DataFrame, pattern: str) -> DataFrame:
    """column_name and number of non-null values of the columns LIKE the pattern."""
    # LIKE over the list of names: % is any text, _ any character
    like = "".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in pattern)
    hits = [c for c in df.columns if re.fullmatch(like, c.lower(), re.DOTALL)]
    if not hits:
        return df.limit(0).select(F.lit("").alias("column_name"), F.lit(0).cast("bigint").alias("filled_rows"))
    one = df.agg(*[F.count(c).alias(c) for c in hits])
    lines = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled_rows")) for c in hits]
    return one.select(F.inline(F.array(*lines)))


def calendar_complete(dates: DataFrame) -> DataFrame:
    """Rows against the length of the span, and rows with wrong attributes."""
    d = F.col("full_date")
    wrong = (
        (F.col("year") != F.year(d))
        | (F.col("quarter") != F.quarter(d))
        | (F.col("month") != F.month(d))
        | (F.col("day_of_month") != F.dayofmonth(d))
    )
    return dates.agg(
        m.rows().alias("actual_rows"),
        (F.date_diff(F.max(d), F.min(d)) + 1).cast("bigint").alias("expected_rows"),
        F.count_if(wrong).alias("inconsistent_rows"),
        F.count_if(F.col("is_weekend") != F.col("day_of_week").isin(1, 7)).alias("inconsistent_weekend"),
    )


def calendar_bounds(
    dates: DataFrame,
    orders: DataFrame,
    start: str = "order_purchase_timestamp",
    end: str = "order_estimated_delivery_date",
) -> DataFrame:
    return dates.agg(F.min("full_date").alias("dim_min"), F.max("full_date").alias("dim_max")).select(
        "dim_min",
        orders.select(F.to_date(F.min(start))).scalar().alias("source_min"),
        "dim_max",
        orders.select(F.to_date(F.max(end))).scalar().alias("source_max"),
    )


def tier_sizes(df: DataFrame, tier: str) -> DataFrame:
    return df.groupBy(tier).agg(m.rows().alias("n")).orderBy(tier)


def tier_monotonic(dim: DataFrame, measures: DataFrame, key: str, tier: str, value: str, digits: int = 4) -> DataFrame:
    """Range and mean of the ranked measure per tier."""
    joined = dim.select(key, tier).join(measures.select(key, value), key)
    return (
        joined.groupBy(tier)
        .agg(F.min(value).alias("min_val"), F.max(value).alias("max_val"), F.round(F.avg(value), digits).alias("avg_val"))
        .orderBy("avg_val")
    )


def fallback_fired(
    df: DataFrame, original: str, resolved: str, placeholder: str = "unknown"
) -> DataFrame:
    """Original values that stand for themselves (other than the placeholder), with counts."""
    fired = df.filter((F.col(original) == F.col(resolved)) & (F.col(original) != placeholder))
    return fired.groupBy(original).agg(m.rows().alias("n")).orderBy(F.desc("n"), original)


def placeholder_fallback(df: DataFrame, original: str, resolved: str, placeholder: str = "unknown") -> DataFrame:
    return df.filter(F.col(original) == placeholder).agg(
        m.rows().alias("placeholder_rows"), F.count_if(F.col(resolved) == placeholder).alias("correctly_resolved")
    )


def translated_sample(df: DataFrame, original: str, resolved: str, k: int = 10) -> DataFrame:
    changed = df.filter(F.col(original) != F.col(resolved)).select(original, resolved).distinct()
    return changed.orderBy(original, resolved).limit(k)


def rollup_equals_or(fact: DataFrame, dim: DataFrame, key: str, rollup: str, flags: Sequence[str]) -> DataFrame:
    """Fact rows whose precomputed flag differs from the OR of the dimension's flags.

    Facts are counted per (key, rollup) first, so only a handful of rows per key join.
    """
    counts = fact.groupBy(key, rollup).agg(m.rows().alias("_n"))
    joined = counts.join(dim.select(key, m.any_true(flags).alias("_or")), key)
    return joined.agg(F.coalesce(F.sum(F.when(F.col(rollup) != F.col("_or"), F.col("_n"))), F.lit(0)).alias("inconsistent_rows"))


def resolution_spot_check(
    chosen: DataFrame,
    candidates: DataFrame,
    key: str,
    columns: Sequence[str],
    chosen_order: Sequence[Column],
    candidate_order: Sequence[Column],
    k: int,
) -> DataFrame:
    """Top k (chosen, candidate) pairs for keys with several candidates, to compare by eye.

    Sorted by key, chosen row, candidate. The top k pairs lie within the k smallest
    keys and, per key, within the first k rows of each side, so only those are paired.
    """
    several = candidates.groupBy(key).agg(m.rows().alias("_n")).filter(F.col("_n") > 1).select(key)
    shared = several.join(chosen.select(key).distinct(), key, "left_semi")
    smallest = F.broadcast(shared.orderBy(key).limit(k))

    def first(df: DataFrame, order: Sequence[Column]) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
        return df.join(smallest, key, "left_semi").withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")

    pairs = first(chosen, chosen_order).join(first(candidates, candidate_order), key)
    return pairs.orderBy(key, *chosen_order, *candidate_order).limit(k).select(*columns)


def grain_null_reconcile(
    parent: DataFrame, child: DataFrame, key: str, parent_null: str, child_null: str
) -> DataFrame:
    """NULLs at parent grain, NULLs at child grain, child rows filled although the parent is not."""
    empty = parent.filter(F.col(parent_null).isNull()).select(key).distinct().withColumn("_empty", F.lit(True))
    # One pass over the children: both counts per key meet the parents.
    counts = child.groupBy(key).agg(
        F.count_if(F.col(child_null).isNull()).alias("_nulls"), F.count(child_null).alias("_filled")
    )
    both = counts.join(empty, key, "left")
    return both.agg(
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("child_nulls"),
        F.coalesce(F.sum(F.when(F.col("_empty"), F.col("_filled"))), F.lit(0)).alias("mismatched_rows"),
    ).select(
        parent.select(F.count_if(F.col(parent_null).isNull())).scalar().alias("parent_nulls"), "child_nulls", "mismatched_rows"
    )


def distribution_sanity(df: DataFrame, column: str, accuracy: int | None = None) -> DataFrame:
    """NULLs, range and quartiles of a numeric column."""
    q = quantile_columns(df, {column: F.col(column)}, m.n_tiles(4), accuracy).select("quantiles").scalar()
    return df.agg(
        m.null_count(column).alias("nulls"), F.min(column).alias("min_val"), F.max(column).alias("max_val")
    ).withColumn("quartiles", q)


def repeated_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return duplicate_combinations(df, as_list(keys))
