"""An integrity register over many tables in one pass.

Every table is read once, whatever the number of relations, duplicate checks and rules it
takes part in: a row gives one tagged line (issue, key) for each of them, the lines are
counted per issue and key within the task, and the counts of all tables meet in one
shuffle. A key of a relation is then there with its number of child rows and of parent
rows, which tells orphans and childless parents; a hot key costs one line a task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.operators.joins import as_list

Key = str | Sequence[str]


@dataclass(frozen=True)
class Relation:
    """Rows of `child` refer to rows of `parent`. Keys are compared as text."""

    child: str
    parent: str
    key: Key
    parent_key: Key | None = None
    # which child rows take part
    predicate: Column | None = None


@dataclass(frozen=True)
class Duplicates:
    """Rows of a table beyond the first of each key; a key with a NULL part is a row without key."""

    table: str
    key: Key


@dataclass(frozen=True)
class Rule:
    """Rows of a table that break a rule; a rule that is NULL is not broken."""

    table: str
    broken: Column


def _key(key: Key) -> Column:
    """The key as text, NULL if a part is NULL."""
    columns = as_list(key)
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    whole = F.to_json(F.struct(*[F.col(c).cast("string").alias(str(i)) for i, c in enumerate(columns)]))
    present = None
    for c in columns:
        present = F.col(c).isNotNull() if present is None else present & F.col(c).isNotNull()
    return F.when(present, whole)


def _line(issue: int, key: Column, child: bool) -> Column:
    """child: a row that is counted; else a parent."""
    return F.struct(
        F.lit(issue).alias("_issue"), key.alias("_key"), F.lit(int(child)).cast("bigint").alias("_rows"), F.lit(int(not child)).cast("bigint").alias("_parents")
    )


def integrity_register(tables: Mapping[str, DataFrame], issues: Mapping[str, Relation | Duplicates | Rule]) -> DataFrame:
    """One row per issue, in their order: issue, checked_rows, null_keys, keys, orphan_rows,
    orphan_keys, parents, childless_parents, duplicate_rows, broken_rows.

    Relations fill checked_rows (child rows), null_keys (child rows without a key), keys,
    orphan_rows and orphan_keys (without a parent; rows without a key are not among them),
    parents (parent rows with a key) and childless_parents; duplicate checks fill checked_rows,
    null_keys, keys and duplicate_rows (checked rows less keys, so rows without a key count);
    rules fill broken_rows only. All others are NULL. Issues without a row count 0.
    """
    lines: dict[str, list[Column]] = {}
    for number, issue in enumerate(issues.values()):
        if isinstance(issue, Relation):
            child = _line(number, _key(issue.key), True)
            lines.setdefault(issue.child, []).append(child if issue.predicate is None else F.when(issue.predicate, child))
            lines.setdefault(issue.parent, []).append(_line(number, _key(issue.parent_key or issue.key), False))
        elif isinstance(issue, Duplicates):
            lines.setdefault(issue.table, []).append(_line(number, _key(issue.key), True))
        else:
            lines.setdefault(issue.table, []).append(F.when(issue.broken, _line(number, F.lit(None).cast("string"), True)))
    tagged = None
    for table, columns in lines.items():
        part = tables[table].select(F.inline(F.array_compact(F.array(*columns))))
        tagged = part if tagged is None else tagged.unionByName(part)
    if tagged is None:
        raise ValueError("no issues")
    by_key = tagged.groupBy("_issue", "_key").agg(F.sum("_rows").alias("_rows"), F.sum("_parents").alias("_parents"))
    with_key, orphan = F.col("_key").isNotNull(), F.col("_parents") == 0

    def total(value: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0))

    n, p = F.col("_rows"), F.col("_parents")
    counts = by_key.groupBy("_issue").agg(
        F.sum(n).alias("rows"),
        total(n, ~with_key).alias("null_keys"),
        F.count_if(with_key & (n > 0)).alias("keys"),
        total(n, with_key & orphan).alias("orphan_rows"),
        F.count_if(with_key & orphan & (n > 0)).alias("orphan_keys"),
        total(p, with_key).alias("parents"),
        total(p, with_key & (n == 0)).alias("childless_parents"),
    )
    kinds = {Relation: "relation", Duplicates: "duplicates", Rule: "rule"}
    spark = tagged.sparkSession
    listed = spark.createDataFrame([(k, name, kinds[type(i)]) for k, (name, i) in enumerate(issues.items())], "_number int, issue string, _kind string")
    # counts has a row an issue, as the list of issues has
    out = listed.join(F.broadcast(counts), F.col("_number") == F.col("_issue"), "left")

    def of(value: Column | str, *which: str) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.when(F.col("_kind").isin(*which), F.coalesce(value, F.lit(0)))

    return out.orderBy("_number").select(
        "issue",
        of("rows", "relation", "duplicates").alias("checked_rows"),
        of("null_keys", "relation", "duplicates").alias("null_keys"),
        of("keys", "relation", "duplicates").alias("keys"),
        of("orphan_rows", "relation").alias("orphan_rows"),
        of("orphan_keys", "relation").alias("orphan_keys"),
        of("parents", "relation").alias("parents"),
        of("childless_parents", "relation").alias("childless_parents"),
        of(F.col("rows") - F.col("keys"), "duplicates").alias("duplicate_rows"),
        of("rows", "rule").alias("broken_rows"),
    )


def evidence_lines(register: DataFrame, measure: Mapping[str, Column] | None = None) -> DataFrame:
    """The register as (issue, evidence_count): orphan rows with those that have no key,
    duplicate or broken rows, or for some issues another measure of the register."""
    usual = F.coalesce(F.col("orphan_rows") + F.col("null_keys"), F.col("duplicate_rows"), F.col("broken_rows"))
    count = usual
    for issue, column in (measure or {}).items():
        count = F.when(F.col("issue") == issue, column).otherwise(count)
    return register.select("issue", count.alias("evidence_count"))


def evidence_columns(register: DataFrame, issues: Sequence[str], measure: Mapping[str, Column] | None = None) -> DataFrame:
    """One row with the evidence of each issue as a column."""
    lines = evidence_lines(register, measure)
    return lines.agg(*[F.max(F.when(F.col("issue") == i, F.col("evidence_count"))).alias(i) for i in issues])


