"""Every registered query against its DuckDB oracle at the smallest scale factor."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
QUERIES = entry.load().QUERIES
ORACLES = entry.load().ORACLES


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    outcome = compare.compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert outcome.startswith("ok"), outcome


def test_a_wrong_median_does_not_pass(spark, monkeypatch):
    from contract import profiling

    real = profiling.p.duration_distribution
    monkeypatch.setattr(profiling.p, "duration_distribution", lambda *a, **k: real(*a, **k).withColumn("p50", F.col("min_val")))
    (row,) = QUERIES["duration_distribution_sketch"](spark, SF_DIR).collect()
    assert row.n > 0 and not row.ordered


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and "on_time_pct" in out.columns
