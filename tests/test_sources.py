import csv
import datetime as dt
import os
from types import SimpleNamespace

import pytest
from conftest import one, rows
from mini import ROWS, raw_tables

from gleanstar import session
from gleanstar.operators.profile import freq_distribution
from gleanstar.sources import tables as src
from gleanstar.sources.schemas import RAW_SCHEMAS


def write_csv(folder, name):
    header = [c.split()[0] for c in RAW_SCHEMAS[name].split(", ")]
    with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows([["" if v is None else v for v in r] for r in ROWS[name]])


def test_ingest_and_layers(spark, tmp_path):
    for name in RAW_SCHEMAS:
        write_csv(tmp_path, name)
    store = src.Warehouse(spark, str(tmp_path / "store"))
    store.create_namespaces()
    raw = store.ingest(str(tmp_path))
    want = raw_tables(spark)
    for name in RAW_SCHEMAS:
        if name not in ("order_reviews", "customers", "order_payments", "sellers"):
            assert rows(raw[name]) == rows(want[name]), name
    assert raw["order_reviews"].count() == len(ROWS["order_reviews"])
    again = store.save("raw", "orders", want["orders"].limit(1))
    assert again.count() == 1  # saving replaces the table
    assert set(store.layer("raw", ["customers"])) == {"customers"}
    with pytest.raises(ValueError):
        store.name("gold", "x")


def test_multiline_and_quoted_text(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\nr1,o1,5,,"two\nlines, ""quoted""",2018-01-01 00:00:00,2018-01-02 10:00:00\n')
    row = one(src.read_raw_csv(spark, "order_reviews", str(path)))
    assert row["review_comment_message"] == 'two\nlines, "quoted"'
    assert row["review_answer_timestamp"] == dt.datetime(2018, 1, 2, 10)


def test_inferred_schema(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("zip,name\n01310,a\n20040,b\n")
    inferred = src.read_csv(spark, str(path), infer=True)
    assert dict(inferred.dtypes) == {"zip": "int", "name": "string"}


def test_databases(spark, tmp_path):
    old = spark.conf.get("spark.sql.warehouse.dir")
    store = src.Warehouse(spark, prefix="gleanstar_test_")
    spark.sql(f"create database if not exists gleanstar_test_clean location '{tmp_path / 'db'}'")
    saved = store.save("clean", "t", spark.range(3))
    assert saved.count() == 3 and store.read("clean", "t").count() == 3
    spark.sql("drop database gleanstar_test_clean cascade")
    assert spark.conf.get("spark.sql.warehouse.dir") == old


def test_saving_switches_versions(spark, tmp_path):
    store = src.Warehouse(spark, str(tmp_path / "shop"))
    first = store.save("clean", "t", spark.range(3))
    # built from itself, while readers of the old version go on
    store.save("clean", "t", store.read("clean", "t").selectExpr("id + 10 as id"))
    assert rows(first) == [(0,), (1,), (2,)] and rows(store.read("clean", "t")) == [(10,), (11,), (12,)]
    broken = spark.range(3).selectExpr("cast(concat('x', id) as int) as id")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store.save("clean", "t", broken)
    assert rows(store.read("clean", "t")) == [(10,), (11,), (12,)]
    assert store.vacuum("clean", "t") >= 1 and rows(store.read("clean", "t")) == [(10,), (11,), (12,)]


def test_columns_like_and_literals(spark):
    df = src.literal_relation(spark, [(1, 2.0)], "Payment_id int, price double")
    assert rows(src.columns_like(df, "%payment%")) == [("Payment_id", "int")]


def test_report_as_csv(spark, tmp_path):
    report = freq_distribution(spark.range(10).selectExpr("id % 2 as k"), "k")
    src.write_report(report, str(tmp_path / "report"))
    back = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert rows(back) == [("0", "5", "50.0"), ("1", "5", "50.0")]


def test_staged_tables_go_to_the_session_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert session.shared_dir(spark) == folder
    assert rows(session.stage(spark.range(5), "five")) == [(i,) for i in range(5)]


def test_staged_tables_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_staged", {})
    kept = session.stage(spark.range(3), "three")
    (folder,) = session._staged[spark.sparkContext.applicationId]
    assert kept.count() == 3 and os.path.isdir(folder)
    assert session.drop_staged(spark) == 1 and not os.path.exists(folder)
    assert session.drop_staged(spark) == 0


class FakeSession:
    """A session without spark.checkpoint.dir."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")


def test_only_local_sessions_may_use_a_folder_of_their_own():
    local = FakeSession("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
    with pytest.raises(ValueError):
        session.shared_dir(FakeSession("spark://host:7077"))
