"""Joins and counts that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.functions.measures import rows


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def lookup_join(
    left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Equi join of many rows with a table that has one row per key.

    One plan at every size: a shuffle join whose left side AQE splits where a key (or NULL)
    holds too much of it, by the session's limits on partition bytes; `configure` lets it
    do so also where a later step then shuffles again. Rows that are equal split like others.

    how: "left", "inner", "semi" or "anti". Columns: keys, rest of left, rest of right.
    """
    keys = as_list(keys)
    if how not in ("left", "inner", "semi", "anti"):
        raise ValueError(f"unsupported join type {how!r}")
    spark_how = {"semi": "left_semi", "anti": "left_anti"}.get(how, how)
    if not null_safe:
        return left.join(right, keys, spark_how)
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = _all(left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys)
    rest = [c for c in left.columns if c not in keys]
    out = left.join(r, cond, spark_how).drop(*[f"_r_{k}" for k in keys])
    return out.select(*keys, *rest, *[c for c in out.columns if c not in left.columns])


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out


def key_counts(df: DataFrame, keys: str | Sequence[str], name: str = "_n") -> DataFrame:
    """Rows per key. Combines before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(*as_list(keys)).agg(rows().alias(name))


def unmatched_counts(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    ref_key: str | None = None,
    group: Sequence[str] = (),
    name: str = "_n",
) -> DataFrame:
    """Rows of df per (group, key) whose key is absent from ref; a NULL key is absent.

    Both sides are reduced to distinct keys before they meet, so neither a hot key
    nor many reference rows per key reach the join.
    """
    ref_keys = ref.select(F.col(ref_key or key).alias(key)).distinct()
    return key_counts(df, [*group, key], name).join(ref_keys, key, "left_anti")


def full_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer equi join against a table with one row per key.

    Built from a left join and the unmatched right rows, because only the left join
    can be split when one key dominates.
    """
    r = right.withColumn("_k", F.col(right_key))
    matched = lookup_join(left.withColumn("_k", F.col(left_key)), r, "_k", "left").drop("_k")
    left_keys = left.select(F.col(left_key).alias("_k")).distinct()
    only_right = r.join(left_keys, "_k", "left_anti").drop("_k")
    return matched.unionByName(only_right, allowMissingColumns=True)
