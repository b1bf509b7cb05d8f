"""Integrity audit: orphans, coverage, key and rule violations, issue register."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.functions import measures as m
from gleanstar.functions.text import col
from gleanstar.operators.distincts import distinct_counts
from gleanstar.operators.joins import as_list, full_outer, lookup_join, unmatched_counts
from gleanstar.operators.listing import PAGE_SIZE, paged_values


def orphan_count(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
    name: str = "orphans",
    count_null_keys: bool = True,
) -> DataFrame:
    """Child rows whose key has no parent."""
    kept = child if count_null_keys else child.filter(F.col(key).isNotNull())
    missing = unmatched_counts(kept, parent, key, parent_key)
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))


def childless_rows(
    parent: DataFrame,
    child: DataFrame,
    key: str,
    predicate: Column | None = None,
    columns: Sequence[str] = (),
) -> DataFrame:
    """Parent rows without any child."""
    kept = parent if predicate is None else parent.filter(predicate)
    out = lookup_join(kept, child.select(key).distinct(), key, "anti")
    return out.select(*columns) if columns else out


def parents_without_children(
    parent: DataFrame,
    child: DataFrame,
    key: str,
    group: str | None = None,
    pct: bool = False,
    digits: int = 2,
) -> DataFrame:
    """Number of childless parents, per group if asked; pct of all parents, or of the
    childless ones when grouped."""
    missing = unmatched_counts(parent, child, key, group=as_list(group) if group else ())
    n = F.coalesce(F.sum("_n"), F.lit(0)).alias("n")
    if group is None:
        out = missing.agg(n)
        total = parent.select(m.rows()).scalar()
        return out.withColumn("pct", m.percent(F.col("n"), total, digits)) if pct else out
    out = missing.groupBy(group).agg(n)
    if pct:
        out = out.withColumn("pct", m.percent(F.col("n"), missing.select(F.sum("_n")).scalar(), digits))
    return out.orderBy(F.desc("n"), group)


def coverage_gap(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    ref_key: str | None = None,
    group: str | None = None,
    predicate: Column | None = None,
) -> DataFrame:
    """Distinct keys that the reference table lacks and the rows they affect."""
    kept = df if predicate is None else df.filter(predicate)
    missing = unmatched_counts(kept, ref, key, ref_key, group=as_list(group) if group else ())
    aggs = [F.count(key).alias("missing_keys"), F.coalesce(F.sum("_n"), F.lit(0)).alias("affected_rows")]
    if group is None:
        return missing.agg(*aggs)
    return missing.groupBy(group).agg(*aggs).orderBy(F.desc("missing_keys"), group)


def missing_keys(
    df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None, predicate: Column | None = None
) -> DataFrame:
    """The distinct keys themselves."""
    kept = df if predicate is None else df.filter(predicate)
    return unmatched_counts(kept, ref, key, ref_key).select(key)


def unused_reference(ref: DataFrame, df: DataFrame, ref_key: str, key: str | None = None) -> DataFrame:
    """Reference rows that no row of df uses."""
    used = df.select(F.col(key or ref_key).alias(ref_key)).distinct()
    return ref.join(used, ref_key, "left_anti")


def not_in_null_aware(df: DataFrame, sub: DataFrame, key: str, sub_key: str | None = None) -> DataFrame:
    """Rows where `key NOT IN (sub)` is true in three-valued logic.

    A NULL in the list yields no rows and a NULL key only passes an empty list. Both
    are scalar tests here, so the join itself is an ordinary anti join; Spark's own
    null-aware form would have to broadcast the whole list.
    """
    listed = sub.select(F.col(sub_key or key).alias(key))
    nulls = listed.select(m.null_count(key)).scalar()
    size = listed.select(m.rows()).scalar()
    out = lookup_join(df, listed.distinct(), key, "anti")
    return out.filter((nulls == 0) & (F.col(key).isNotNull() | (size == 0))).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], name: str = "duplicates") -> DataFrame:
    """Rows minus distinct key tuples (tuples with a NULL part are not counted)."""
    counts = distinct_counts(df, {"distinct_keys": as_list(keys)}, total="total_rows")
    return counts.withColumn(name, F.col("total_rows") - F.col("distinct_keys"))


def duplicate_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(m.rows().alias("n")).filter(F.col("n") > 1)


def duplicate_rows(df: DataFrame, columns: Sequence[str], name: str = "duplicate_groups") -> DataFrame:
    return duplicate_combinations(df, columns).agg(m.rows().alias(name))


def future_dated(df: DataFrame, ts: str, as_of: Column | None = None, name: str = "future_dated") -> DataFrame:
    """Rows later than `as_of` (default now); text is read leniently."""
    limit = F.current_timestamp() if as_of is None else as_of
    return df.agg(F.count_if(F.col(ts).try_cast("timestamp") > limit).alias(name))


def range_rule(df: DataFrame, column: str, lo, hi, name: str = "out_of_range") -> DataFrame:
    return df.agg(F.count_if(m.outside(column, lo, hi)).alias(name))


def register_lines(counts: DataFrame) -> DataFrame:
    """A one-row frame of counts as (issue, evidence_count) lines."""
    lines = [
        F.struct(F.lit(c).alias("issue"), F.col(c).cast("bigint").alias("evidence_count")) for c in counts.columns
    ]
    return counts.select(F.inline(F.array(*lines)))


def issue_register(counts: Sequence[DataFrame]) -> DataFrame:
    """Union of one-row count frames (one per table or relation) as an issue list."""
    out = None
    for frame in counts:
        lines = register_lines(frame)
        out = lines if out is None else out.unionByName(lines)
    return out


def symmetric_discrepancy(
    expected: DataFrame,
    actual: DataFrame,
    key: str,
    labels: tuple[str, str] = ("expected_but_not_actual", "actual_but_not_expected"),
) -> DataFrame:
    """Keys found on one side only, tagged with the side."""
    e, a = expected.select(key).distinct(), actual.select(key).distinct()
    return (
        e.join(a, key, "left_anti")
        .select(F.lit(labels[0]).alias("discrepancy_type"), key)
        .unionByName(a.join(e, key, "left_anti").select(F.lit(labels[1]).alias("discrepancy_type"), key))
    )


def outer_compare(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_pred: Column,
    right_pred: Column,
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Both sides of a text key with their lengths where either side meets its predicate.

    Rows that match have equal keys, so each side is first cut to the keys that can
    pass on either side, and the full join reads only those. `row_id` tells equal
    left rows apart, which lets a hot key spread.
    """
    either = F.coalesce(left_pred, F.lit(False)) | F.coalesce(right_pred, F.lit(False))
    a = left.select(left_key, *row_id).withColumn(right_key, F.col(left_key)).filter(either).drop(right_key)
    b = right.select(right_key).withColumn(left_key, F.col(right_key)).filter(either).drop(left_key)
    both = full_outer(a, b, left_key, right_key).filter(either)
    return both.select(
        F.col(left_key).alias("left_side"),
        F.char_length(left_key).alias("left_length"),
        F.col(right_key).alias("right_side"),
        F.char_length(right_key).alias("right_length"),
    )


def zero_value_audit(
    df: DataFrame, key: str, value: str, kind: str, digits: int = 2, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Keys with a zero value: rows, total and the kinds used (one entry per row)."""
    pairs = df.groupBy(key, kind).agg(
        m.rows().alias("_n"), F.sum(value).alias("_v"), F.count_if(F.col(value) == 0).alias("_zero")
    )
    stats = (
        pairs.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.sum("_n").alias("rows"),
            F.round(F.sum("_v"), digits).alias("total"),
            F.sum("_zero").alias("_zeros"),
        )
        .filter(F.col("_zeros") > 0)
        .drop("_zeros")
    )
    found = lookup_join(pairs.drop("_v", "_zero"), stats, key, "inner")
    pages = paged_values(found, [key, "rows", "total"], kind, "_kinds", copies="_n", page_size=page_size)
    return pages.select(key, "page", "rows", "total", F.concat_ws(", ", "_kinds").alias("kinds_used"))


def zero_value_parents(
    df: DataFrame, parent: DataFrame, key: str, value: str, columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """The zero-valued rows with attributes of their parent."""
    zero = df.filter(F.col(value) == 0)
    return lookup_join(zero, parent, key, how).select(*columns)
