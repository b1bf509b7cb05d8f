import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from gleanstar.operators import sketches as q
from gleanstar.sources.tables import Warehouse


@pytest.fixture(scope="module")
def prices(spark):
    g = random.Random(7)
    lines = [("hot" if g.random() < 0.5 else f"g{g.randrange(5)}", g.lognormvariate(3, 2) if g.random() > 0.1 else None, g.randrange(40)) for _ in range(40_000)]
    lines += [("empty", None, None), ("nan", float("nan"), 1), (None, 3.0, 2)]
    return spark.createDataFrame(lines, "kind string, price double, days int").repartition(6).cache()


def exact(df, column, kind=None):
    found = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    found = found if kind is None else found.filter(F.col("kind") == kind)
    return sorted(float(r[0]) for r in found.select(column).collect())


def near(values, found, prob, k=q.K):
    slack = 2 * q.rank_error(k) * len(values) + 1
    below, upto = sum(v < found for v in values), sum(v <= found for v in values)
    return found in values and below - slack <= prob * len(values) <= upto + slack


def test_quantiles_of_merged_groups(prices):
    table = q.sketch_table(prices, ["price", "days"], ["kind"])
    whole = {r.column_name: r for r in q.quantiles(table, [0.0, 0.25, 0.5, 0.95, 1.0]).collect()}
    for column in ("price", "days"):
        values = exact(prices, column)
        assert whole[column].n == len(values)
        assert all(near(values, f, p) for f, p in zip(whole[column].quantiles, [0.0, 0.25, 0.5, 0.95, 1.0], strict=True))
        assert whole[column].quantiles[0] == values[0] and whole[column].quantiles[-1] == values[-1]
    medians = {(r.kind, r.column_name): r["median"] for r in q.group_median(table, ["kind"]).collect()}
    assert all(near(exact(prices, "price", k), medians[k, "price"], 0.5) for k in ("hot", "g0", "g4"))
    assert medians["empty", "price"] is None and medians["nan", "price"] is None and medians[None, "price"] == 3.0


def test_halves_merge_to_the_whole(prices):
    """Rank errors of two halves that are added stay within the bound of one sketch."""
    for k in (200, q.K):
        halves = [q.sketch_table(prices.filter(F.coalesce(F.crc32(F.col("price").cast("string")), F.lit(0)) % 2 == i), ["price"], k=k) for i in (0, 1)]
        (both,) = q.added(*halves).select("n", "nulls", "min_val", "max_val", q.quantile([0.1, 0.5, 0.9]).alias("q")).collect()
        values = exact(prices, "price")
        assert (both["n"], both["min_val"], both["max_val"]) == (len(values), values[0], values[-1])
        assert both["nulls"] == prices.count() - len(values)
        assert all(near(values, f, p, k) for f, p in zip(both["q"], (0.1, 0.5, 0.9), strict=True))


def test_summaries_need_no_table(spark, prices, tmp_path):
    store = Warehouse(spark, str(tmp_path / "shop"))
    prices.write.parquet(str(tmp_path / "prices"))
    table = spark.read.parquet(str(tmp_path / "prices"))
    kept = store.save("clean", "price_sketches", q.sketch_table(table, {"p": F.col("price")}, ["kind"]))
    for out in (q.numeric_summary(kept), q.duration_distribution(kept, ["kind"]), q.ranks(kept, [20.0])):
        assert str(tmp_path / "prices") not in plan(out)
    (summary,) = q.numeric_summary(kept, digits=6).collect()
    values = exact(prices, "price")
    assert summary["avg_val"] == pytest.approx(sum(values) / len(values), abs=1e-5)
    (found,) = q.ranks(kept, [20.0]).collect()
    assert found["ranks"][0] == pytest.approx(sum(v <= 20 for v in values) / len(values), abs=2 * q.rank_error() + 1e-4)
    assert rows(q.duration_distribution(kept.filter("kind = 'empty'")), "n", "p50", "max_val") == [(0, None, None)]


def test_empty_table(prices):
    table = q.sketch_table(prices.limit(0), ["price"], ["kind"])
    assert table.count() == 0 and q.quantiles(table, [0.5]).count() == 0
    (whole,) = q.quantiles(q.sketch_table(prices.limit(0), ["price"]), [0.5]).collect()
    assert (whole["n"], whole["quantiles"]) == (0, None)
