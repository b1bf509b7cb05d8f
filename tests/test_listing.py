import random

import pytest

from gleanstar.operators import listing
from gleanstar.operators.listing import paged_values


def brute(rows, page_size):
    lists = {}
    for *key, value, copies in rows:
        lists.setdefault(tuple(key), []).extend([value] * copies)
    out = []
    for key, values in lists.items():
        values.sort()
        out += [(*key, k // page_size, values[k : k + page_size]) for k in range(0, len(values), page_size)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("page_size", "laid_out"), [(1, 3), (7, 5), (10, 64), (1000, 1 << 18)])
def test_pages_of_many_keys_and_a_hot_one(spark, monkeypatch, page_size, laid_out):
    """A key over several ranges, keys of one value, NULL keys, values repeated beyond a page."""
    monkeypatch.setattr(listing, "_LAID_OUT", laid_out)
    rng = random.Random(page_size)
    rows = [("hot", 1, v, 1) for v in range(700)] + [("b", None, f, 30) for f in range(3)] + [(None, 2, 5, 2), (None, None, 6, 1)]
    rows += [(f"k{k}", k % 3, v, rng.randrange(1, 4)) for k in range(40) for v in rng.sample(range(100), rng.randrange(1, 30))]
    rng.shuffle(rows)
    pairs = spark.createDataFrame(rows, "k string, j int, v long, c int")
    old = {c: spark.conf.get(c) for c in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = paged_values(pairs.repartition(5), ["k", "j"], "v", "vs", copies="c", page_size=page_size)
        assert got.columns == ["k", "j", "page", "vs"]
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, page_size)
        single = paged_values(pairs.filter("k = 'hot'"), ["k"], "v", "vs", page_size=page_size)
        assert sorted(map(tuple, single.collect()), key=repr) == brute([(k, v, c) for k, _, v, c in rows if k == "hot"], page_size)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_kinds_of_values(spark):
    df = spark.sql("select 1.5d as k, v, date'2020-01-01' + v as d, timestamp'2020-01-01 00:00:00' as t, cast(v as decimal(9, 2)) as e from (select explode(array(3, 1, 2)) as v)")
    (row,) = paged_values(df, ["k", "t"], "d", "ds").collect()
    assert [str(d) for d in row.ds] == ["2020-01-02", "2020-01-03", "2020-01-04"] and str(row.t) == "2020-01-01 00:00:00"
    (row,) = paged_values(df, ["k"], "e", "es").collect()
    assert [float(e) for e in row.es] == [1.0, 2.0, 3.0]
    assert paged_values(df.limit(0), ["k"], "v", "vs").count() == 0
