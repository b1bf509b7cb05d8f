import math
import random
import re

import numpy as np
import pytest

from gleanstar.operators import profile as p
from gleanstar.operators import selection as s
from conftest import plan, rows

SHAPES = {
    "uniform": lambda g: g.random(),
    "few values": lambda g: float(g.randrange(4)),
    "wide": lambda g: math.copysign(10.0 ** g.uniform(-300, 300), g.random() - 0.5),
    "outlier": lambda g: g.gauss(0, 1) if g.random() > 0.001 else 1e200,
    "equal": lambda g: 7.25,
    "close": lambda g: 1.0 + g.randrange(5000) * 2.0**-52,
    "negative": lambda g: -g.expovariate(1),
}


@pytest.fixture
def small_steps(monkeypatch):
    monkeypatch.setattr(s, "BINS", 64)
    monkeypatch.setattr(s, "FEW", 3)


@pytest.mark.parametrize("bins", [None, 64])
def test_quantiles_of_any_distribution(spark, bins, request):
    if bins:
        request.getfixturevalue("small_steps")
    g = random.Random(5)
    n = 300 if bins else 3000
    data = {name: [make(g) if g.random() > 0.05 else None for _ in range(n)] for name, make in SHAPES.items()}
    df = spark.createDataFrame(list(zip(*data.values(), strict=True)), ", ".join(f"`{k}` double" for k in data)).repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    exact = {(m, q): v for m, _, q, v in rows(s.selected_quantiles(df, list(data), probs))}
    low = {(m, q): (c, v) for m, c, q, v in rows(s.selected_quantiles(df, list(data), probs, discrete=True))}
    for name, values in data.items():
        values = np.array(sorted(v for v in values if v is not None))
        for q in probs:
            r = q * (len(values) - 1)
            a, b = values[math.floor(r)], values[min(math.floor(r) + 1, len(values) - 1)]
            assert exact[name, q] == (a if a == b or r == math.floor(r) else a * (1 - r % 1) + b * (r % 1))
            assert low[name, q] == (len(values), values[max(math.ceil(round(q * len(values), 6)) - 1, 0)])


def test_special_values(spark, small_steps):
    values = [None, -math.inf, -math.inf, -1.0, 0.0, 2.0, 2.5, math.inf, math.nan]
    df = spark.createDataFrame([(v, None) for v in values], "x double, none double")
    got = {q: v for _, _, q, v in rows(s.selected_quantiles(df, ["x", "none"], [i / 8 for i in range(1, 9)], discrete=True))}
    assert [got[i / 8] for i in range(1, 8)] == [-math.inf, -math.inf, -1.0, 0.0, 2.0, 2.5, math.inf] and math.isnan(got[1.0])
    assert s.selected_quantiles(df.limit(0), ["x"], [0.5]).count() == 0


def test_scans_and_exchanges(spark, tmp_path, monkeypatch):
    """A few scans of the wanted columns; only counts of bins are exchanged."""
    spark.range(50_000).selectExpr("cast(id % 7919 as double) * 1.5 as a", "sqrt(id) as b", "'text' as c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    frames = []
    lines = s._lines

    def spied(*args):
        frames.append(plan(lines(*args)))
        return lines(*args)

    monkeypatch.setattr(s, "_lines", spied)
    got = {(m, q): v for m, _, q, v in rows(s.selected_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75]))}
    assert got["b", 0.5] == pytest.approx((math.sqrt(24999) + math.sqrt(25000)) / 2)
    assert len(frames) <= 4
    for text in frames:
        assert "Exchange" not in text and re.search(r"ReadSchema: struct<a:double,b:double>|ReadSchema: struct<[ab]:double>", text)


def test_summary_of_metrics_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "x double, y double")
    (got,) = p.distribution_summary(df, ["x", "y"]).collect()
    assert (got["metric"], got["n"], got["median"], got["iqr"]) == ("x", 3, 2.0, 1.5)
    assert p.distribution_summary(df.limit(0), ["x", "y"]).count() == 0
    (flat,) = p.distribution_summary(df.selectExpr("3.0d as x"), ["x"]).collect()
    assert flat["iqr"] == 0.0 and flat["pct_outside_fence"] == 0.0 and flat["median"] == 3.0
