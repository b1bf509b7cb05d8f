import random
import statistics

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleanstar.operators import joins
from gleanstar.operators import ranking as r
from gleanstar.operators.listing import paged_values


@pytest.mark.parametrize("n, buckets", [(0, 4), (1, 7), (5, 64), (1000, 1), (1000, 7)])
def test_global_row_number_equals_the_window(spark, n, buckets):
    df = spark.range(n).selectExpr("id * 7919 % 1000 as a", "cast(id as string) as b")
    got = r.global_row_number(df, ["a", "b"], "rn", buckets=buckets)
    want = df.select(F.row_number().over(W.orderBy("a", "b")).cast("bigint").alias("rn"), "a", "b")
    assert rows(got) == rows(want)


def test_global_row_number_with_nulls_and_one_dominant_prefix(spark):
    """Two thirds of the rows share the first key column; the second splits them."""
    df = spark.range(3000).selectExpr("case when id % 3 = 0 then id when id % 97 = 0 then null else -1 end as a", "id as b")
    got = r.global_row_number(df, ["a", "b"], "rn", buckets=16)
    want = df.select(F.row_number().over(W.orderBy("a", "b")).cast("bigint").alias("rn"), "a", "b")
    assert rows(got) == rows(want)
    sizes = r.sorted_table(df, ["a", "b"], 16).groupBy("_part").count().collect()
    assert len(sizes) == 16 and max(s["count"] for s in sizes) < 600


def test_numbering_reads_the_stored_table_without_a_sort(spark):
    df = spark.range(1000).selectExpr("id as a", "id % 10 as b")
    text = plan(r.global_row_number(df, ["a"], "rn", buckets=8))
    # the only window runs over the totals of the ranges
    assert text.count("Window [") == 1 and "_sum" in text
    assert "BroadcastHashJoin" in text and "FileScan parquet" in text


def test_ranges_follow_the_session(spark):
    df = spark.range(500).selectExpr("id * 7919 % 1000 as a")
    assert {x["_part"] for x in r.sorted_table(df, "a").collect()} == {0}
    small = rows(r.global_row_number(df, "a", "rn"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {x["_part"] for x in r.sorted_table(df, "a").collect()} == set(range(8))
        assert rows(r.global_row_number(df, "a", "rn")) == small
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


@pytest.mark.parametrize("n, k", [(1, 3), (2, 7), (7, 3), (8, 3), (9, 7), (100, 7)])
def test_ntile_equals_the_built_in(spark, n, k):
    df = spark.range(n).selectExpr("id % 4 as v", "id")
    got = r.ntile_tier(df, ["v", "id"], k, "t", buckets=4)
    want = df.withColumn("t", F.ntile(k).over(W.orderBy("v", "id")))
    assert rows(got) == rows(want)


def test_running_total_of_weights(spark):
    df = spark.createDataFrame([(3, 5), (1, 2), (2, 10)], "a int, w bigint")
    assert rows(r.running_total(df, "a", "upto", "w", buckets=2), "a", "upto") == [(1, 2), (2, 12), (3, 17)]


def test_exact_quantiles_against_python(spark):
    rng = random.Random(3)
    values = [(round(rng.gauss(0, 10), 1), rng.choice([None, 1.0, 2.0, 2.0])) for _ in range(501)]
    df = spark.createDataFrame(values, "x double, y double")
    got = {(m, p): v for m, _, p, v in rows(r.exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75], buckets=8))}
    for i, name in enumerate("xy"):
        data = [v[i] for v in values if v[i] is not None]
        for p, want in zip([0.25, 0.5, 0.75], statistics.quantiles(data, n=4, method="inclusive")):
            assert got[name, p] == pytest.approx(want)


def test_discrete_quantiles_are_data_values(spark):
    df = spark.createDataFrame([(float(v),) for v in [10, 20, 30, 40]], "x double")
    got = {p: v for _, _, p, v in rows(r.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.51, 1.0], discrete=True))}
    assert got == {0.0: 10.0, 0.25: 10.0, 0.5: 20.0, 0.51: 30.0, 1.0: 40.0}


def test_pick_one_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 5 as k", "id as v")
    picked = r.pick_one_per_key(df, "k", [F.desc("v")])
    assert rows(picked) == [(0, 95), (1, 96), (2, 97), (3, 98), (4, 99)]
    text = plan(picked)
    assert "WindowGroupLimit" in text and "Partial" in text


def skewed(spark):
    left = spark.range(4000).selectExpr(
        "id",
        "case when id % 3 = 0 then 7 when id % 3 = 1 and id % 2 = 0 then -5 when id % 11 = 0 then null"
        " else id % 1500 end as k",
    )
    right = spark.range(1000).selectExpr("id as k", "concat('v', id) as v", "id * 2 as w")
    return left, right


@pytest.fixture
def tiny_partitions(spark, no_auto_broadcast):
    """AQE's limits as for tables of these tests' size."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "inner", "semi", "anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join_splits_hot_keys(spark, tiny_partitions, how, null_safe):
    """Key 7 is hot with a match, -5 hot without one, NULL is frequent."""
    left, right = skewed(spark)
    if null_safe:
        right = right.unionByName(spark.sql("select cast(null as bigint) as k, 'n' as v, cast(0 as bigint) as w"))
    got = joins.lookup_join(left, right, "k", how, null_safe=null_safe)
    assert got.columns == ["k", "id", *(["v", "w"] if how in ("left", "inner") else [])]
    by_key = {r.k: r for r in right.collect()}
    want = []
    for r in left.collect():
        hit = by_key.get(r.k) if r.k is not None or null_safe else None
        if how in ("semi", "anti"):
            want += [(r.k, r.id)] * ((hit is not None) == (how == "semi"))
        elif hit is not None or how == "left":
            want.append((r.k, r.id, hit and hit.v, hit and hit.w))
    assert rows(got) == sorted(want, key=repr)


def largest_partition(joined, path):
    """Rows of the largest file that a join writes."""
    joined.write.parquet(path)
    back = joined.sparkSession.read.parquet(path)
    return max(r["count"] for r in back.groupBy(F.col("_metadata.file_name")).count().collect())


@pytest.mark.parametrize("equal", [False, True])
def test_a_hot_key_lands_in_several_tasks(spark, tiny_partitions, tmp_path, equal):
    """Also if all its rows are equal."""
    columns = "cast(0 as bigint) as id" if equal else "id"
    left = spark.range(0, 200_000, 1, 16).selectExpr(columns, "if(id % 2 = 0, 7, id % 1500) as k")
    right = spark.range(1500).selectExpr("id as k", "concat('v', id) as v")
    assert largest_partition(joins.lookup_join(left, right, "k"), str(tmp_path / "a")) < 60_000
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert largest_partition(joins.lookup_join(left, right, "k"), str(tmp_path / "b")) > 100_000
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_full_outer_equals_the_built_in(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "x int, l string")
    right = spark.createDataFrame([(1, "p"), (3, "q"), (None, "r")], "y int, r string")
    got = joins.full_outer(left, right, "x", "y")
    want = left.join(right, left.x == right.y, "full_outer")
    assert rows(got, "x", "l", "y", "r") == rows(want, "x", "l", "y", "r")


@pytest.mark.parametrize("page_size", [1, 7, 10, 1000])
def test_pages_are_the_sorted_list(spark, page_size):
    pairs = spark.createDataFrame([(k, i, 1 + i % 3) for k in "ab" for i in range(25 if k == "a" else 4)], "k string, v int, c bigint")
    for copies in (None, "c"):
        found = paged_values(pairs.repartition(3), ["k"], "v", "vs", copies=copies, page_size=page_size).collect()
        for key, n in (("a", 25), ("b", 4)):
            pages = sorted((p.page, p.vs) for p in found if p.k == key)
            want = [i for i in range(n) for _ in range(1 if copies is None else 1 + i % 3)]
            assert [p for p, _ in pages] == list(range(-(-len(want) // page_size)))
            assert [v for _, vs in pages for v in vs] == want and all(len(vs) == page_size for _, vs in pages[:-1])
