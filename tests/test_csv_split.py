import csv
import io
import random

import pytest
from conftest import rows

from gleanstar.sources import csv_split as cs
from gleanstar.sources.tables import read_csv


@pytest.fixture
def small_blocks(spark):
    """Splits of some hundred bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


def written(path, lines, end="\n"):
    text = io.StringIO()
    out = csv.writer(text, lineterminator=end)
    out.writerow(["id", "text", "n"])
    out.writerows(lines)
    path.write_bytes(text.getvalue().encode())


def texts(rng):
    pieces = ["plain", "two\nlines", 'a "quoted" word', '"', "\n\n", "comma, here", "ünï", '""\n"', "", " blank ", "x" * 300, "\n" * 40, 'q"\n' * 30]
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(4))) or None, rng.randrange(9)) for i in range(400)]


@pytest.mark.parametrize("size", [150, 700, 5000, 10_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_many_blocks(spark, tmp_path, small_blocks, size, end):
    lines = texts(random.Random(size))
    for k in range(2):
        written(tmp_path / f"part{k}.csv", [(i + 1000 * k, t, n) for i, t, n in lines], end)
    small_blocks(size)
    got = cs.read_multiline_csv(spark, str(tmp_path / "*.csv"), "id long, text string, n int")
    if size < 10_000:
        assert got.rdd.getNumPartitions() > 8
    want = [(i + 1000 * k, t, n) for k in range(2) for i, t, n in lines]
    assert rows(got) == sorted(want, key=repr)


def test_a_record_over_several_blocks_and_an_open_quote(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text('h\n"' + "line\n" * 400 + '"\nlast\n"never closed\nto the end')
    small_blocks(200)
    got = {r.record for r in cs.records(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {"h", '"' + "line\n" * 400 + '"', "last", '"never closed\nto the end'}


def test_as_the_reader_of_whole_files(spark, tmp_path, small_blocks):
    """Equal to Spark's own reader, which takes a file in one task."""
    rng = random.Random(3)
    written(tmp_path / "a.csv", [*texts(rng), ("x", "not a number", "1.5"), (7, "", "")])
    schema = "id long, text string, n int"
    want = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(str(tmp_path / "a.csv"))
    small_blocks(1000)
    assert rows(read_csv(spark, str(tmp_path / "a.csv"), schema, multiline=True)) == rows(want)


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,text,n\n")
    (tmp_path / "c.csv").write_text("id,text,n\n\n1,a,2\n\n")
    assert rows(cs.read_multiline_csv(spark, str(tmp_path / "*.csv"), "id long, text string, n int")) == [(1, "a", 2)]
    assert rows(cs.read_multiline_csv(spark, str(tmp_path / "c.csv"), "id string, text string, n string", header=False)) == [("1", "a", "2"), ("id", "text", "n")]
