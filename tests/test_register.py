import re

import pytest
from pyspark.sql import functions as F

from gleanstar.operators import register as g
from gleanstar.operators.distincts import distinct_counts
from conftest import one, plan, rows


@pytest.fixture
def shop(spark, tmp_path):
    """Orders with a NULL and a repeated id; lines with a missing, a NULL and a hot key."""
    data = {
        "orders": ([(1, 10, "a"), (2, 20, "b"), (3, None, "c"), (3, 10, "c"), (None, 10, "d"), (4, 30, "e")], "oid long, cid long, state string"),
        "lines": ([(1, 1, 5.0)] * 50 + [(2, 1, -1.0), (9, 1, 2.0), (9, 2, None), (None, 1, 0.0)], "oid int, no int, price double"),
        "people": ([(10, "x"), (20, "y"), (40, "z")], "cid string, name string"),
    }
    out = {}
    for name, (lines, schema) in data.items():
        spark.createDataFrame(lines, schema).repartition(3).write.parquet(str(tmp_path / name))
        out[name] = spark.read.parquet(str(tmp_path / name))
    return out


def issues():
    return {
        "lines_orders": g.Relation("lines", "orders", "oid"),
        "orders_people": g.Relation("orders", "people", "cid"),
        "dear_lines_orders": g.Relation("lines", "orders", "oid", predicate=F.col("price") > 0),
        "self": g.Relation("orders", "orders", ["oid", "state"]),
        "repeated_orders": g.Duplicates("orders", "oid"),
        "repeated_lines": g.Duplicates("lines", ["oid", "no"]),
        "negative": g.Rule("lines", F.col("price") < 0),
        "never": g.Rule("people", F.col("name") == "none"),
    }


def test_register_by_hand(shop):
    got = {r["issue"]: r.asDict() for r in g.integrity_register(shop, issues()).collect()}
    assert list(got) == list(issues())
    counts = ("checked_rows", "null_keys", "keys", "orphan_rows", "orphan_keys", "parents", "childless_parents", "duplicate_rows", "broken_rows")
    table = {k: tuple(v[c] for c in counts) for k, v in got.items()}
    assert table == {
        "lines_orders": (54, 1, 3, 2, 1, 5, 3, None, None),
        "orders_people": (6, 1, 3, 1, 1, 3, 1, None, None),
        "dear_lines_orders": (51, 0, 2, 1, 1, 5, 4, None, None),
        "self": (6, 1, 4, 0, 0, 5, 0, None, None),
        "repeated_orders": (6, 1, 4, None, None, None, None, 2, None),
        "repeated_lines": (54, 1, 4, None, None, None, None, 50, None),
        "negative": (None,) * 8 + (1,),
        "never": (None,) * 8 + (0,),
    }


def test_every_table_is_read_once(shop):
    out = g.integrity_register(shop, issues())
    text = plan(out)
    assert len(re.findall(r"FileScan parquet|Scan parquet", text)) == 3
    # lines meet in one exchange, after they are counted in the task
    assert len(re.findall(r"hashpartitioning\(_issue#\d+, _key#\d+", text)) == 1


def test_evidence(shop):
    register = g.integrity_register(shop, issues())
    lines = dict(rows(g.evidence_lines(register, {"orders_people": F.col("childless_parents")})))
    assert lines == {
        "lines_orders": 3, "orders_people": 1, "dear_lines_orders": 1, "self": 1,
        "repeated_orders": 2, "repeated_lines": 50, "negative": 1, "never": 0,
    }
    assert one(g.evidence_columns(register, ["negative", "lines_orders"])) == {"negative": 1, "lines_orders": 3}


def test_empty_tables(shop):
    empty = {n: df.limit(0) for n, df in shop.items()}
    got = g.integrity_register(empty, issues()).fillna(0).collect()
    assert len(got) == 8 and not any(sum(r[1:]) for r in got)
    with pytest.raises(ValueError):
        g.integrity_register(shop, {})


def test_distinct_counts_by_hand(spark, tmp_path):
    lines = [(1, "a", None, 1.5, True), (1, "b", "x", -0.0, None), (2, "a", "x", 0.0, True), (None, "a", "y", None, False), (2, "a", "x", 0.0, True)]
    spark.createDataFrame(lines, "i int, s string, t string, d double, b boolean").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.coalesce("i", F.lit(9))))
    df = df.withColumn("ts", F.col("day").cast("timestamp"))
    keys = {c: c for c in ("i", "s", "t", "d", "b", "day", "ts")} | {"is": ["i", "s"], "st": ["s", "t"]}
    out = distinct_counts(df, keys, {"no_t": F.col("t").isNull()}, total="n")
    assert len(re.findall("FileScan parquet", plan(out))) == 1
    assert one(out) == {"n": 5, "i": 2, "s": 2, "t": 2, "d": 2, "b": 2, "day": 3, "ts": 3, "is": 3, "st": 3, "no_t": 1}
    assert one(distinct_counts(df.limit(0), keys, total="n")) == dict.fromkeys(["n", *keys], 0)


def test_distinct_counts_of_tuples_do_not_mix(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", "abc"), ("abc", "")], "a string, b string")
    assert one(distinct_counts(df, {"ab": ["a", "b"], "ba": ["b", "a"]})) == {"ab": 4, "ba": 4}
