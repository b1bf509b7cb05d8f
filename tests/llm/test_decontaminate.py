import re

import pytest
from pyspark.sql import functions as F

from gleanstar.llm import decontaminate as dc
from gleanstar.llm.registry import table


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, size=10):
    out = []
    windows = []
    for item, text in items:
        w = words(text)
        windows += [(item, w[i : i + size]) for i in range(max(1, len(w) - size + 1)) if w]
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, v in windows:
            for p in range(len(w) - len(v) + 1):
                if w[p : p + len(v)] == v:
                    hit |= set(range(p, p + len(v)))
                    if item is not None:
                        found.add(str(item))
        out.append((doc_id, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(map(repr, out))


def got(docs, items, **kw):
    return sorted(repr(tuple(r)) for r in dc.decontaminate(docs, items, **kw).collect())


ITEMS = [
    (1, "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu nu"),
    (2, "stop"),
    (3, "no straße é"),
    (4, "a a a a a a a a a a a a"),
    (5, ""),
    (6, None),
    (None, "wort7 und so weiter wort8"),
    (7, "two words"),
    (10, "two words"),
    (8, "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10"),
]
DOCS = [
    (1, "a " * 30 + "b " + "A,a." * 12),
    (2, "x1 x2 x3 x4 x5 x6 x7 x8 x9"),
    (3, "x0 x1 x2-x3 x4 x5 x6 x7 x8 x9 x10 x1 x2 x3"),
    (4, "Two... WORDS two two words"),
    (5, "no straße é no STRASSE é NO Straße É"),
]


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize(("threshold", "bound", "span"), [("10MB", dc.BROADCAST_ROWS, dc.SPAN), ("10MB", dc.BROADCAST_ROWS, 3), ("-1", 0, 5)])
def test_against_all_windows(spark, items, odd_documents, monkeypatch, threshold, bound, span):
    """With prefixes broadcast, with short spans, and with both sides shuffled."""
    monkeypatch.setattr(dc, "BROADCAST_ROWS", bound)
    monkeypatch.setattr(dc, "SPAN", span)
    docs = odd_documents.select("doc_id", "text").union(spark.createDataFrame(DOCS, "doc_id long, text string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert got(docs, items) == brute([tuple(r) for r in docs.collect()], ITEMS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_prefixes_are_joined(spark, monkeypatch):
    """A window whose other shingles stand everywhere meets the texts with its rarest one only."""
    frequent = "of the day in the end"
    items = spark.createDataFrame([(1, f"{frequent} rare {frequent}")], "item_id long, text string")
    texts = [f"{frequent} x{k} {frequent}" for k in range(50)] + [f"so {frequent} rare {frequent}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = {}
    stage = dc.stage
    monkeypatch.setattr(dc, "BROADCAST_ROWS", -1)

    def counted(df, name):
        out = stage(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(dc, "stage", counted)
    assert got(docs, items) == brute(list(enumerate(texts)), [(1, f"{frequent} rare {frequent}")])
    assert sizes["candidates"] == sizes["window_prefixes"] == 4 and sizes["open_candidates"] == 1
    # an item with one shingle that no text holds meets nothing
    never = spark.createDataFrame([(1, f"{frequent} absent")], "item_id long, text string")
    assert not any(r.contaminated for r in dc.decontaminate(docs, never).collect())
    assert sizes["window_prefixes"] == sizes["candidates"] == 0


def test_verified_by_words(spark, items, odd_documents, monkeypatch):
    """Equal hashes of different shingles change nothing."""
    monkeypatch.setattr(dc, "shingle_hash", lambda *parts: F.length(parts[0]).cast("long"))
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert got(docs, items) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("size", [1, 2, 4])
def test_other_window_sizes(spark, items, size):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert got(docs, items, size=size) == brute(DOCS, ITEMS, size)


def test_empty_tables(spark, items, odd_documents):
    none = got(odd_documents, items.limit(0))
    assert len(none) == odd_documents.count() and all(r.endswith("False)") for r in none)
    assert dc.decontaminate(odd_documents.limit(0), items).count() == 0


def test_clean_rows_keep_their_columns(odd_documents, items):
    clean = dc.drop_contaminated(odd_documents, items)
    assert clean.columns == odd_documents.columns
    flags = dc.decontaminate(odd_documents, items)
    assert clean.count() == flags.filter("not contaminated").count() < odd_documents.count()


def test_plan_has_no_python(spark, items, odd_documents):
    text = dc.decontaminate(odd_documents, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow", text) and "Cartesian" not in text


def test_shared_data(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").limit(120)
    items = table(spark, "/root/testdata/sf0.001", "benchmark").select("item_id", "text")
    assert got(docs, items) == brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
