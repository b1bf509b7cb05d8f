import os

import pytest
from conftest import one, plan, rows
from mini import raw_tables
from pyspark.sql import functions as F

from gleanstar.operators import checks as c
from gleanstar.operators import validate as v
from gleanstar.plans import cleaning, star
from gleanstar.plans.checks import CHECKS, REQUIRED, checked_save
from gleanstar.sources import tables as src


@pytest.fixture(params=["folder", "database"])
def store(request, spark, tmp_path):
    if request.param == "folder":
        yield src.Warehouse(spark, str(tmp_path / "shop"))
        return
    out = src.Warehouse(spark, prefix="checked_", location=str(tmp_path / "db"))
    out.create_namespaces()
    yield out
    for layer in ("raw", "clean", "serving"):
        spark.sql(f"drop database checked_{layer} cascade")


@pytest.fixture
def lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([(1, 5.0, "a"), (2, -1.0, "b"), (3, None, "zz"), (4, 0.0, None)], "id long, price double, kind string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def wanted():
    return {
        **c.row_count(), **c.nulls(["price", "kind"]), **c.non_negative(["price"], zero=["price"]), **c.outside_domain("kind", ["a", "b"]),
        **c.counts({"odd": F.col("id") % 2 == 1}), **c.value_range(["price"]),
    }


def jobs(spark, run) -> int:
    context = spark.sparkContext
    group = os.urandom(8).hex()
    context.setJobGroup(group, "test")
    try:
        run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_checks_cost_no_scan_of_their_own(spark, store, lines):
    store.save("clean", "t", lines)
    plain = jobs(spark, lambda: store.save("clean", "t", lines))
    got = {}

    def save():
        store.save("clean", "t", lines, checks=wanted())
        got.update(store.checks("clean", "t"))

    # the results of the write and those read back with it: no job more than a plain write
    assert jobs(spark, save) == plain
    assert got == {
        "row_count": 4, "null_price": 1, "null_kind": 1, "negative_price": 1, "zero_price": 1, "outside_kind": 1, "odd": 2,
        "min_price": -1.0, "max_price": 5.0,
    }
    watched, _ = c.observed(lines, wanted())
    assert plan(watched).count("FileScan parquet") == 1 and "CollectMetrics" in plan(watched)


def test_results_equal_scanning_checks(store, lines):
    saved = store.save("clean", "t", lines, checks={**c.nulls(["price"]), **c.non_negative(["price"])})
    results = store.checks("clean", "t")
    both = {**one(v.null_profile(saved, ["price"])), **one(v.non_negative(saved, ["price"]))}
    assert results == both == one(c.as_frame(saved.sparkSession, results))


def test_required_checks_keep_the_old_version(store, lines):
    rule = c.non_negative(["price"])
    first = store.save("clean", "t", lines.filter("price >= 0"), checks=rule, require=["negative_price"])
    with pytest.raises(c.ChecksFailed) as e:
        store.save("clean", "t", lines, checks=rule, require=["negative_price"])
    assert e.value.failed == {"negative_price": 1} and e.value.results == {"negative_price": 1}
    assert rows(store.read("clean", "t"), "id") == rows(first, "id") == [(1,), (4,)]
    assert store.checks("clean", "t") == {"negative_price": 0}
    with pytest.raises(ValueError, match="not checked"):
        store.save("clean", "t", lines, require=["negative_price"])
    # versions that were not made current go as old ones do
    assert store.vacuum("clean", "t") == 1 and rows(store.read("clean", "t"), "id") == [(1,), (4,)]


def test_a_failed_write_keeps_the_old_version(store, spark):
    store.save("clean", "t", spark.range(3))
    store.save("clean", "t", store.read("clean", "t").selectExpr("id + 10 as id"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store.save("clean", "t", spark.range(3).selectExpr("cast(concat('x', id) as int) as id"))
    assert rows(store.read("clean", "t")) == [(10,), (11,), (12,)]
    # a version may change the columns
    store.save("clean", "t", spark.range(2).selectExpr("id", "'it''s' as name"), checks=c.counts({"it's \\": F.col("id") == 1}))
    assert rows(store.read("clean", "t")) == [(0, "it's"), (1, "it's")] and store.checks("clean", "t") == {"it's \\": 1}
    assert store.vacuum("clean", "t") >= 1 and rows(store.read("clean", "t"), "id") == [(0,), (1,)]


def test_a_table_of_the_catalogue_becomes_a_version(spark, tmp_path):
    store = src.Warehouse(spark, prefix="older_", location=str(tmp_path / "db"))
    store.create_namespaces()
    try:
        spark.range(2).write.saveAsTable("older_clean.t")
        assert store.save("clean", "t", spark.range(5)).count() == 5
        assert spark.table("older_clean.t__v0").count() == 2
    finally:
        for layer in ("raw", "clean", "serving"):
            spark.sql(f"drop database older_{layer} cascade")


def test_listing_of_a_domain_is_read_only_if_needed(spark, store, lines):
    allowed = ["a", "b"]
    saved = store.save("clean", "t", lines, checks=c.outside_domain("kind", allowed))
    assert rows(c.domain_listing(saved, "kind", allowed, store.checks("clean", "t"))) == [("zz", 1)]
    saved = store.save("clean", "t", lines.filter("kind <> 'zz'"), checks=c.outside_domain("kind", allowed))
    listing = c.domain_listing(saved, "kind", allowed, store.checks("clean", "t"))
    assert listing.count() == 0 and "FileScan" not in plan(listing)


def test_parity(spark, store, lines):
    store.save("raw", "t", lines, checks=c.row_count())
    store.save("clean", "t", lines.filter("price >= 0"), checks=c.row_count())
    out = c.parity(spark, store.checks("raw", "t"), store.checks("clean", "t"))
    assert one(out) == {"source_rows": 4, "target_rows": 2, "removed": 2} and "FileScan" not in plan(out)


def test_build_with_checks(spark, tmp_path):
    store = src.Warehouse(spark, str(tmp_path / "shop"))
    raw = raw_tables(spark)
    clean = cleaning.clean_all(raw, checked_save(store, "clean"))
    serving = star.build_star(clean, checked_save(store, "serving", strict=True))
    for name, df in clean.items():
        scanned = one(v.scanned(df, CHECKS[name]()))
        assert store.checks("clean", name) == scanned and scanned["row_count"] == df.count(), name
    fact = store.checks("serving", "fact_order_item_fulfillment")
    assert fact["row_count"] == serving["fact_order_item_fulfillment"].count() and not any(fact[r] for r in REQUIRED["fact_order_item_fulfillment"])
    assert set(REQUIRED) <= set(CHECKS)


def test_ordered_tables(spark, store):
    df = spark.range(3000).selectExpr("(id * 7919) % 3000 as k", "id as v", "repeat(md5(cast(id as string)), 3) as t").union(spark.range(2).selectExpr("cast(null as long)", "id", "'n'"))
    saved = store.save("clean", "t", df, order_by=["k", "v"])
    assert saved.count() == 3002
    # within a file rows are sorted, and files hold consecutive ranges
    placed = saved.select("k", F.col("_metadata.file_name").alias("f")).collect() if store.base else []
    ranges = {}
    for r in placed:
        assert r["k"] is None or r["f"] not in ranges or ranges[r["f"]][-1] is None or r["k"] >= ranges[r["f"]][-1]
        ranges.setdefault(r["f"], []).append(r["k"])
    spans = sorted((min(x for x in ks if x is not None), max(x for x in ks if x is not None)) for ks in ranges.values())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    found = store.read_range("clean", "t", 100, 130)
    assert rows(found, "k") == [(k,) for k in range(100, 131)]
    if store.base and len(spans) > 1:
        assert len(found.inputFiles()) < len(spans)
    assert store.read_range("clean", "t", 9000, 9001).count() == 0


def test_statistics_of_an_ordered_table_skip_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    store = src.Warehouse(spark, str(tmp_path / "shop"))
    found = store.save("clean", "t", spark.range(5000).selectExpr("(id * 7919) % 5000 as k"), order_by="k")
    low = sorted((pq.ParquetFile(f.removeprefix("file:")).metadata.row_group(0).column(0).statistics.min, f) for f in found.inputFiles())
    assert low[0][0] == 0 and len({m for m, _ in low}) == len(low)
