"""Profiling: counts, distributions, ranges, durations, dependencies, normalisation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.functions import measures as m
from gleanstar.functions.text import col
from gleanstar.functions.timeparts import elapsed, year_month
from gleanstar.operators.distincts import distinct_counts
from gleanstar.operators.joins import as_list, lookup_join
from gleanstar.operators.listing import PAGE_SIZE, paged_values
from gleanstar.operators.selection import measured_quantiles, selected_quantiles

Normaliser = Callable[[str], Column]


def distinct_count(df: DataFrame, *columns: str) -> Column:
    """Exact count of distinct non-null values (or value tuples), as a scalar subquery.

    Each count groups by its own columns and reads only those; several COUNT(DISTINCT)
    in one aggregate would copy every row once per column instead.
    """
    values = df.select(*columns)
    for c in columns:
        values = values.filter(F.col(c).isNotNull())
    return values.distinct().select(m.rows().alias("n")).scalar()


def table_profile(
    df: DataFrame,
    keys: Sequence[str | Sequence[str]] = (),
    nulls: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """One row: row_count, distinct_<key> per key (estimated with `approx`), null_<column> per column."""
    named = {"distinct_" + "_".join(as_list(key)): as_list(key) for key in keys}
    conditions = {f"null_{c}": F.col(c).isNull() for c in nulls}
    if named and not approx:
        return distinct_counts(df, named, conditions, total="row_count")
    estimates = []
    for name, cols in named.items():
        one = F.col(cols[0]) if len(cols) == 1 else F.when(_all_present(cols), F.struct(*cols))
        estimates.append(F.approx_count_distinct(one).alias(name))
    return df.agg(m.rows().alias("row_count"), *estimates, *[F.count_if(c).alias(n) for n, c in conditions.items()])


def _all_present(columns: Sequence[str]) -> Column:
    present = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        present = present & F.col(c).isNotNull()
    return present


def null_rates(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    return df.agg(*[m.percent(m.null_count(c), m.rows(), digits).alias(f"pct_null_{c}") for c in columns])


def _with_share(counts: DataFrame, part: str, name: str, digits: int) -> DataFrame:
    """Share of the grand total, which is a scalar rather than a window over all groups."""
    total = counts.select(F.sum(part)).scalar()
    return counts.withColumn(name, m.percent(F.col(part), total, digits))


def freq_distribution(
    df: DataFrame, columns: str | Sequence[str], digits: int = 2, share: bool = True
) -> DataFrame:
    """Value(s), n and pct of all rows, most frequent first."""
    keys = as_list(columns)
    counts = df.groupBy(*keys).agg(m.rows().alias("n"))
    out = _with_share(counts, "n", "pct", digits) if share else counts
    return out.orderBy(F.desc("n"), *keys)


def null_by_group(df: DataFrame, group: str, column: str, digits: int = 2) -> DataFrame:
    """Rows, NULLs and NULL percentage per group: is the column missing at random?"""
    return (
        df.groupBy(group)
        .agg(m.rows().alias("n"), m.null_count(column).alias("null_n"))
        .withColumn("pct_null", m.percent(F.col("null_n"), F.col("n"), digits))
        .orderBy(F.desc("n"), group)
    )


def null_share_by_group(df: DataFrame, group: str, column: str, digits: int = 2) -> DataFrame:
    """How the NULLs of a column spread over the groups."""
    counts = df.groupBy(group).agg(m.null_count(column).alias("null_n"))
    return _with_share(counts, "null_n", "pct_of_nulls", digits).orderBy(F.desc("null_n"), group)


def filtered_group_count(df: DataFrame, predicate: Column, group: str | Sequence[str]) -> DataFrame:
    return df.filter(predicate).groupBy(*as_list(group)).agg(m.rows().alias("n"))


def cardinality_ratio(
    df: DataFrame, per: str, of: str | None = None, digits: int = 2, extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows (or distinct `of`) per distinct `per`, plus any extra aggregates."""
    distinct = {f"distinct_{c}": c for c in (per, of) if c is not None}
    counts = distinct_counts(df, distinct, total="row_count")
    if extra:
        one = df.agg(*[c.alias(n) for n, c in extra.items()])
        counts = counts.select("row_count", *[one.select(n).scalar().alias(n) for n in extra], *distinct)
    part = "row_count" if of is None else f"distinct_{of}"
    return counts.withColumn("ratio", m.ratio(F.col(part), F.col(f"distinct_{per}"), digits))


def fanout_distribution(df: DataFrame, key: str, digits: int = 2, share: bool = True) -> DataFrame:
    """Histogram of group sizes: rows_per_key, num_keys, pct of keys."""
    sizes = df.groupBy(key).agg(m.rows().alias("rows_per_key"))
    hist = sizes.groupBy("rows_per_key").agg(m.rows().alias("num_keys"))
    out = _with_share(hist, "num_keys", "pct", digits) if share else hist
    return out.orderBy("rows_per_key")


def quantile_columns(
    df: DataFrame, exprs: Mapping[str, Column], probs: Sequence[float], accuracy: int | None
) -> DataFrame:
    """column_name and an array of quantiles that are values of the data.

    Exact by default; with `accuracy` from a sketch, in the same pass as everything
    else but with every task's sketch merged in one.
    """
    values = df.select(*[c.cast("double").alias(n) for n, c in exprs.items()])
    if accuracy is not None:
        one = values.agg(*[m.sketch(n, probs, accuracy).alias(n) for n in exprs])
        lines = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias("quantiles")) for n in exprs]
        return one.select(F.inline(F.array(*lines)))
    found = selected_quantiles(values, list(exprs), sorted(set(probs)), discrete=True)
    # One value per wanted quantile, so the array is bounded by the argument list.
    pairs = F.array_sort(F.collect_list(F.struct("prob", "value")))
    return found.groupBy(F.col("metric").alias("column_name")).agg(
        F.transform(pairs, lambda x: x["value"]).alias("quantiles")
    )


def numeric_summary(
    df: DataFrame,
    columns: Mapping[str, Column] | Sequence[str],
    digits: int = 2,
    rules: Mapping[str, Column] | None = None,
    accuracy: int | None = m.ACCURACY,
) -> DataFrame:
    """column_name, min_val, max_val, avg_val, quartiles (5 values), plus rule counts.

    Quartiles come from a sketch (one pass, rank error of 1/accuracy), or exact with
    accuracy=None, which scans the rows a few times when it is called."""
    exprs = dict(columns) if isinstance(columns, Mapping) else {c: F.col(c) for c in columns}
    aggs = []
    for i, c in enumerate(exprs.values()):
        v = c.cast("double")
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.round(F.avg(v), digits).alias(f"mean{i}")]
    rules = rules or {}
    one = df.agg(*aggs, *[F.count_if(p).alias(n) for n, p in rules.items()])
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"lo{i}").alias("min_val"),
            F.col(f"hi{i}").alias("max_val"),
            F.col(f"mean{i}").alias("avg_val"),
        )
        for i, name in enumerate(exprs)
    ]
    base = one.select(F.inline(F.array(*lines)), *rules)
    quartiles = quantile_columns(df, exprs, m.n_tiles(4), accuracy)
    # Both sides have one row per named column.
    joined = base.join(F.broadcast(quartiles), "column_name", "left")
    return joined.select("column_name", "min_val", "max_val", "avg_val", F.col("quantiles").alias("quartiles"), *rules)


def value_range(
    df: DataFrame, columns: Mapping[str, Column] | Sequence[str], extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """min_<name> and max_<name> of numbers, texts, dates or expressions."""
    exprs = dict(columns) if isinstance(columns, Mapping) else {c: F.col(c) for c in columns}
    aggs = []
    for name, c in exprs.items():
        aggs += [F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}")]
    return df.agg(*aggs, *[c.alias(n) for n, c in (extra or {}).items()])


def duration_distribution(
    df: DataFrame, start: str, end: str, unit: str = "hour", accuracy: int | None = m.ACCURACY
) -> DataFrame:
    """n, min, median, 95th percentile and max of the elapsed units where both ends exist;
    quantiles from a sketch, or exact with accuracy=None."""
    known = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    d = elapsed(end, start, unit)
    if accuracy is not None:
        q = m.sketch(d, [0.5, 0.95], accuracy)
        one = known.agg(m.rows().alias("n"), F.min(d).alias("min_val"), F.max(d).alias("max_val"), q.alias("q"))
        p50, p95 = (F.get("q", F.lit(i)).cast("bigint") for i in (0, 1))
        return one.select("n", "min_val", p50.alias("p50"), p95.alias("p95"), "max_val")
    q = quantile_columns(known, {"d": d}, [0.5, 0.95], accuracy).select("quantiles").scalar()
    return known.agg(m.rows().alias("n"), F.min(d).alias("min_val"), F.max(d).alias("max_val")).select(
        "n", "min_val", q[0].cast("bigint").alias("p50"), q[1].cast("bigint").alias("p95"), "max_val"
    )


def duration_histogram(
    df: DataFrame, start: str, end: str, unit: str = "hour", predicate: Column | None = None
) -> DataFrame:
    kept = df if predicate is None else df.filter(predicate)
    return kept.groupBy(elapsed(end, start, unit).alias("diff")).agg(m.rows().alias("n")).orderBy("diff")


def period_volume(
    df: DataFrame, ts: str, predicate: Column | None = None, by: str = "year_month"
) -> DataFrame:
    """Rows per 'yyyy-MM' period, or per year and month with by='parts'."""
    kept = df if predicate is None else df.filter(predicate)
    keys = (
        {"year_month": year_month(ts)}
        if by == "year_month"
        else {"year": F.year(ts), "month": F.month(ts)}
    )
    return kept.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(m.rows().alias("n")).orderBy(*keys)


def parse_audit(df: DataFrame, column: str, to: str = "timestamp") -> DataFrame:
    """Range of the values that parse and the number of non-null values that do not."""
    parsed = F.col(column).try_cast(to)
    return df.agg(
        F.min(parsed).alias("min_val"),
        F.max(parsed).alias("max_val"),
        F.count_if(parsed.isNull() & F.col(column).isNotNull()).alias("unparseable"),
    )


def temporal_order_violations(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per named pair (earlier, later): rows where `later` precedes `earlier`.

    Text columns are read leniently, so an unparseable value counts for nothing.
    """

    def instant(c: str) -> Column:
        return F.col(c).try_cast("timestamp") if dict(df.dtypes)[c] == "string" else F.col(c)

    return df.agg(*[F.count_if(instant(b) < instant(a)).alias(n) for n, (a, b) in pairs.items()])


def inspect_rows(df: DataFrame, predicate: Column | None = None, columns: Sequence[str] = ()) -> DataFrame:
    out = df if predicate is None else df.filter(predicate)
    return out.select(*columns) if columns else out


def _dependency_stats(pairs: DataFrame, determinant: str, dependent: str) -> DataFrame:
    return (
        pairs.groupBy(determinant)
        .agg(F.count(dependent).alias("n_distinct"), F.sum("_n").alias("rows"))
        .filter(F.col("n_distinct") > 1)
    )


def fd_violations(df: DataFrame, determinant: str, dependents: str | Sequence[str]) -> DataFrame:
    """Determinant values with more than one distinct dependent value.

    One dependent: determinant, n_distinct, rows. Several: n_<dependent> each, kept
    when any exceeds one.
    """
    deps = as_list(dependents)
    if len(deps) == 1:
        pairs = df.groupBy(determinant, deps[0]).agg(m.rows().alias("_n"))
        return _dependency_stats(pairs, determinant, deps[0])
    # (determinant, column, value) once, then one count per column: no row is copied per count
    long = df.select(determinant, F.inline(F.array(*[F.struct(F.lit(d).alias("_c"), F.col(d).cast("string").alias("_v")) for d in deps])))
    values = long.filter(F.col("_v").isNotNull()).distinct()
    counts = values.groupBy(determinant).agg(*[F.count_if(F.col("_c") == d).alias(f"n_{d}") for d in deps])
    return counts.filter(m.any_true(F.col(f"n_{d}") > 1 for d in deps))


def fd_variants(
    df: DataFrame, determinant: str, dependent: str, page_size: int = PAGE_SIZE
) -> DataFrame:
    """As `fd_violations`, with the sorted distinct values as pages of an array."""
    pairs = df.groupBy(determinant, dependent).agg(m.rows().alias("_n"))
    stats = _dependency_stats(pairs, determinant, dependent)
    values = pairs.filter(F.col(dependent).isNotNull() & F.col(determinant).isNotNull()).drop("_n")
    found = lookup_join(values, stats, determinant, "inner")
    return paged_values(found, [determinant, "n_distinct", "rows"], dependent, "variants", page_size=page_size)


def normalization_effect(df: DataFrame, column: str, normaliser: Normaliser) -> DataFrame:
    """Distinct values before and after normalising; only 256-bit digests are shuffled."""

    def digest(c: Column) -> Column:
        return F.unhex(F.sha2(c.cast("string").cast("binary"), 256))

    raw = df.select(digest(F.col(column)).alias("_raw"), digest(normaliser(column)).alias("_norm")).distinct()
    return raw.agg(F.count("_raw").alias("original"), F.count_distinct("_norm").alias("normalized"))


def normalization_variants(
    df: DataFrame, column: str, normaliser: Normaliser, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Normalised values that stand for more than one raw value, with the raw variants."""
    pairs = df.groupBy(column).agg(m.rows().alias("_n")).withColumn("normalized", normaliser(column))
    stats = _dependency_stats(pairs, "normalized", column)
    values = pairs.filter(F.col(column).isNotNull()).drop("_n")
    found = lookup_join(values, stats, "normalized", "inner")
    return paged_values(found, ["normalized", "n_distinct", "rows"], column, "variants", page_size=page_size)


def normalization_reduction(df: DataFrame, key: str, column: str, normaliser: Normaliser) -> DataFrame:
    """Keys with several raw values, and how many of them have fewer once normalised."""
    pairs = df.select(key, column).distinct().withColumn("_norm", normaliser(column))
    per_key = pairs.groupBy(key).agg(F.count(column).alias("raw"), F.count_distinct("_norm").alias("norm"))
    return per_key.filter(F.col("raw") > 1).agg(
        m.rows().alias("keys_with_variants"), F.count_if(F.col("raw") > F.col("norm")).alias("reduced")
    )


def bounds_check(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Range per column and the rows outside the box in any column."""
    aggs = []
    for c in bounds:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    bad = m.any_true(m.outside(c, lo, hi) for c, (lo, hi) in bounds.items())
    return df.agg(*aggs, F.count_if(bad).alias("out_of_bounds"))


def _gap_stats(df: DataFrame, key: str, seq: str, distinct: str | None) -> DataFrame:
    aggs = [m.rows().alias("rows"), F.max(seq).alias("max_seq")]
    if distinct:
        aggs.append(F.count_distinct(distinct).alias(f"distinct_{distinct}"))
    return df.groupBy(key).agg(*aggs).filter(F.col("rows") != F.col("max_seq"))


def sequence_gaps(df: DataFrame, key: str, seq: str, distinct: str | None = None) -> DataFrame:
    """Keys whose highest sequence number differs from their row count."""
    return _gap_stats(df, key, seq, distinct)


def sequence_gap_lists(df: DataFrame, key: str, seq: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """As `sequence_gaps`, with the sorted sequence numbers as pages of an array."""
    stats = _gap_stats(df, key, seq, None)
    pairs = df.filter(F.col(seq).isNotNull()).groupBy(key, seq).agg(m.rows().alias("_n"))
    found = lookup_join(pairs, stats, key, "inner")
    return paged_values(found, [key, "rows", "max_seq"], seq, "sequences", copies="_n", page_size=page_size)


def domain_listing(df: DataFrame, column: str, predicate: Column | None = None) -> DataFrame:
    kept = df if predicate is None else df.filter(predicate)
    return kept.select(column).distinct().orderBy(column)


def domain_joined(df: DataFrame, column: str, separator: str = ",", page_size: int = PAGE_SIZE) -> DataFrame:
    """Number of distinct values and the sorted values as text, paged for large domains."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    sized = values.withColumn("total", values.select(m.rows()).scalar())
    pages = paged_values(sized, ["total"], column, "_values", page_size=page_size)
    return pages.select("page", "total", F.concat_ws(separator, "_values").alias("values"))


def top_k_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    return df.groupBy(column).agg(m.rows().alias("n")).orderBy(F.desc("n"), column).limit(k)


def semi_lookup(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key occurs in `other`."""
    return lookup_join(df, other.select(key).distinct(), key, "semi")


def repeated_key_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key occurs more than once."""
    repeated = df.groupBy(key).agg(m.rows().alias("_n")).filter(F.col("_n") > 1).select(key)
    return lookup_join(df, repeated, key, "semi")


def join_inspect(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    predicate: Column | None = None,
    columns: Sequence[str] = (),
    order: Sequence[Column] = (),
) -> DataFrame:
    """Child rows with parent columns; the predicate is on the child and applied first."""
    kept = child if predicate is None else child.filter(predicate)
    out = lookup_join(kept, parent, key, "inner")
    out = out.select(*columns) if columns else out
    return out.orderBy(*order) if order else out


def distribution_summary(
    df: DataFrame, metrics: Sequence[str], fence: float = 1.5, digits: int = 2
) -> DataFrame:
    """metric, n, mean, median, sd, iqr, skew, kurtosis, fences and % outside them.

    Skewness and kurtosis are bias-corrected, quantiles are interpolated and exact. The rows
    are scanned a few times (moments in the first scan) and not shuffled; runs when it is called.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in metrics])
    moments = [f(c) for c in metrics for f in (F.avg, F.stddev_samp, F.skewness, F.kurtosis)]
    found, sums = measured_quantiles(values, metrics, [0.25, 0.5, 0.75], extra=moments)
    known = [c for c in metrics if found[c][0]]
    lines = [
        (c, found[c][0], *(float(found[c][1][p]) for p in (0.25, 0.5, 0.75)), *sums[4 * k : 4 * k + 4])
        for k, c in enumerate(metrics)
        if c in known
    ]
    schema = "metric string, n long, q1 double, median double, q3 double, mean double, sd double, _g1 double, _g2 double"
    measured = df.sparkSession.createDataFrame(lines, schema).withColumn("iqr", F.col("q3") - F.col("q1"))
    # Rounded, so that a value equal to its fence does not fall outside by float noise.
    measured = measured.withColumn("lower_fence", F.round(F.col("q1") - fence * F.col("iqr"), 9)).withColumn(
        "upper_fence", F.round(F.col("q3") + fence * F.col("iqr"), 9)
    )
    fences = {r["metric"]: (r["lower_fence"], r["upper_fence"]) for r in measured.collect()}
    beyond = [F.count_if((F.col(c) < fences[c][0]) | (F.col(c) > fences[c][1])).alias(c) for c in known]
    if beyond:
        counts = values.agg(*beyond)
        outside = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("_out")) for c in known])))
    else:
        outside = measured.select("metric", F.lit(0).cast("bigint").alias("_out"))
    n = F.col("n").cast("double")
    # Both sides have one row per metric.
    return measured.join(F.broadcast(outside), "metric").select(
        "metric",
        "n",
        "mean",
        "median",
        "sd",
        "iqr",
        F.try_divide(F.sqrt(n * (n - 1)) * F.col("_g1"), n - 2).alias("skew"),
        F.try_divide((n - 1) * ((n + 1) * F.col("_g2") + 6), (n - 2) * (n - 3)).alias("kurtosis"),
        "lower_fence",
        "upper_fence",
        m.percent(F.col("_out"), F.col("n"), digits).alias("pct_outside_fence"),
    )


def group_median(
    df: DataFrame, group: str, column: str, predicate: Column | None = None, accuracy: int = m.ACCURACY
) -> DataFrame:
    """Median per group that is a value of the data (the lower one of an even count)."""
    kept = df if predicate is None else df.filter(predicate)
    return kept.groupBy(group).agg(F.percentile_approx(column, 0.5, accuracy).alias("median"))


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows per rule in one pass; a rule that is NULL counts as not met."""
    return df.agg(*[F.count_if(p).alias(n) for n, p in rules.items()])


def complete_period_trim(df: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    """Rows of the complete months first..last ('yyyy-MM'), as a prunable range."""
    lo = F.to_timestamp(F.lit(f"{first}-01"))
    hi = F.add_months(F.to_date(F.lit(f"{last}-01")), 1).cast("timestamp")
    return df.filter((col(ts) >= lo) & (col(ts) < hi))
