"""Exact quantiles by successive refinement of histograms.

The rows are scanned a few times and never shuffled: a scan counts the rows of BINS bins per
wanted interval of values, with the smallest and largest value of each bin. The bin that
holds a wanted rank is the next interval, unless it has one value only or few enough rows to
be listed. The first bins lie on a logarithmic scale, the later ones on a linear one, so
doubles of any distribution need seven scans at most, and usual ones two or three.
Only counts of bins leave the tasks; their number depends on the arguments alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.functions.measures import rows

BINS = 1024
# Rows of a bin whose values are listed instead of counted by finer bins.
FEW = 4096


@dataclass
class _Interval:
    """Values lo..hi of a metric, the rows below them, and the ranks looked for in it."""

    metric: str
    lo: float
    hi: float
    below: int
    ranks: set[int] = field(default_factory=set)
    first: bool = False


def _signed_log(v: float) -> float:
    return math.copysign(math.log1p(abs(v)), v)


def _bin(v: Column, part: _Interval) -> Column:
    """A number that never falls as the value rises; NaN is above infinity, as in Spark's order."""
    lo, hi, scaled = part.lo, part.hi, v
    if part.first and _signed_log(lo) < _signed_log(hi):
        lo, hi, scaled = _signed_log(lo), _signed_log(hi), F.signum(v) * F.log1p(F.abs(v))
    # halves, as the span of two doubles may not be a double
    share = (scaled / 2 - lo / 2) / (hi / 2 - lo / 2)
    number = F.least(F.greatest(F.floor(share * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    return F.when(F.isnan(v), BINS + 1).when(v == math.inf, BINS).when(v == -math.inf, -1).otherwise(number)


def _inside(v: Column, part: _Interval) -> Column:
    # the first interval has all values, infinite ones as well
    return v.isNotNull() if part.first else v.between(part.lo, part.hi)


def _lines(df: DataFrame, parts: Sequence[_Interval], value) -> DataFrame:
    """(interval number, value(v, interval), v) of each row and interval that holds it."""
    lines = []
    for k, part in enumerate(parts):
        v = F.col(f"`{part.metric}`").cast("double")
        line = F.struct(F.lit(k).alias("_i"), value(v, part).alias("_b"), v.alias("_v"))
        lines.append(F.when(_inside(v, part), line))
    return df.select(F.inline(F.array_compact(F.array(*lines))))


def values_at(df: DataFrame, ranks: dict[str, tuple[float, float, Iterable[int]]]) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks of the non-null values: per metric the smallest and the largest
    finite value and the ranks. Runs when it is called."""
    found: dict[tuple[str, int], float] = {}
    parts = [_Interval(name, lo, hi, 0, set(r), True) for name, (lo, hi, r) in ranks.items() if r]
    while parts:
        counted = _lines(df, parts, _bin).groupBy("_i", "_b").agg(rows().alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect()
        following, listed = [], []
        for k, part in enumerate(parts):
            below = part.below
            for r in sorted((r for r in counted if r["_i"] == k), key=lambda r: r["_b"]):
                here = {rank for rank in part.ranks if below <= rank < below + r["n"]}
                if here and (r["lo"] == r["hi"] or math.isnan(r["lo"])):
                    found |= {(part.metric, rank): r["lo"] for rank in here}
                elif here:
                    (listed if r["n"] <= FEW else following).append(_Interval(part.metric, r["lo"], r["hi"], below, here))
                below += r["n"]
        if listed:
            values = _lines(df, listed, lambda v, part: F.lit(0)).groupBy("_i", "_v").agg(rows().alias("n")).collect()
            for k, part in enumerate(listed):
                below = part.below
                for r in sorted((r for r in values if r["_i"] == k), key=lambda r: r["_v"]):
                    found |= {(part.metric, rank): r["_v"] for rank in part.ranks if below <= rank < below + r["n"]}
                    below += r["n"]
        parts = following
    return found


def quantile_ranks(n: int, prob: float, discrete: bool) -> tuple[int, int, float]:
    """The two ranks a quantile lies between, and the weight of the second."""
    if discrete:
        left = max(math.ceil(round(prob * n, 6)) - 1, 0)
        return left, left, 0.0
    exact = prob * (n - 1)
    left = math.floor(exact)
    return left, min(left + 1, n - 1), exact - left


def _finite_bounds(metric: str) -> list[Column]:
    v = F.col(f"`{metric}`").cast("double")
    finite = F.when(F.abs(v) < math.inf, v)
    return [F.count(v), F.coalesce(F.min(finite), F.lit(0.0)), F.coalesce(F.max(finite), F.lit(0.0))]


def measured_quantiles(
    df: DataFrame, metrics: Sequence[str], probs: Sequence[float], discrete: bool = False, extra: Sequence[Column] = ()
) -> tuple[dict[str, tuple[int, dict[float, float]]], list]:
    """Per metric the number of values and its quantiles (none without values), and the values of
    any extra aggregates, which the first scan computes as well."""
    first = [c for name in metrics for c in _finite_bounds(name)]
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate([*first, *extra])]).first()
    bounds = {name: row[3 * k : 3 * k + 3] for k, name in enumerate(metrics)}
    wanted, ranks = {}, {}
    for name, (n, lo, hi) in bounds.items():
        wanted[name] = {p: quantile_ranks(n, p, discrete) for p in probs} if n else {}
        # one value: any bins part it from the infinite ones
        ranks[name] = (lo, hi if hi > lo else lo + max(1.0, abs(lo)), {r for left, right, _ in wanted[name].values() for r in (left, right)})
    at = values_at(df, ranks)
    out = {}
    for name in metrics:
        values = {}
        for p, (left, right, share) in wanted[name].items():
            a, b = at[name, left], at[name, right]
            values[p] = a if share == 0 or a == b else a * (1 - share) + b * share
        out[name] = bounds[name][0], values
    return out, list(row[3 * len(metrics) :])


def selected_quantiles(df: DataFrame, metrics: Sequence[str], probs: Sequence[float], discrete: bool = False) -> DataFrame:
    """Quantiles per metric column: metric, n, prob, value (as double); metrics without a value
    have no rows. Interpolated, or with `discrete` the smallest value that at least that
    share of the rows do not exceed. Runs when it is called; a frame that is costly to compute
    is best stored first, as it is read a few times."""
    found, _ = measured_quantiles(df, metrics, probs, discrete)
    lines = [(name, n, float(p), v) for name, (n, values) in found.items() for p, v in values.items()]
    return df.sparkSession.createDataFrame(lines, "metric string, n long, prob double, value double")
