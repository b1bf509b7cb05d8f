import hashlib
import zlib

import numpy as np
import pytest

from gleanstar.llm import line_dedup as ld
from gleanstar.llm.rows import text_hash


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, min_chars=20, min_docs=3):
    """rows: (id, hash of the text, text)"""
    def order(d):
        return (d[0] is not None, d[0] or 0, d[1])

    holders = {}
    for i, h, text in rows:
        for line in (text or "").split("\n"):
            key = ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add((i, h))
    out = []
    for i, h, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            found = holders.get(ascii_lower(line.strip(" \t\n\x0b\x0c\r")), ())
            if len(found) < max(2, min_docs) or max(found, key=order) == (i, h):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(map(repr, out))


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", text_hash("text"), "text").collect()]


@pytest.fixture(scope="module")
def hot_lines(spark):
    """One line in most documents, lines at both sides of the limits, line repeats, other cases."""
    common = "this line stands in nearly every document"
    texts = []
    for i in range(400):
        lines = [f"own line of document number {i}", common if i % 5 else "  " + common.upper() + "\t", "short line", f"pair line {i // 2} of two documents"]
        lines += [f"triple line {i // 3} of three documents"] * (1 + i % 2) + ["É" * 20 if i % 7 == 0 else "é" * 20, "x" * 19, ""]
        texts.append((i, "\n".join(lines[i % 3 :] + lines[: i % 3])))
    return spark.createDataFrame(texts, "doc_id long, text string")


@pytest.mark.parametrize("ranges", [1, 8, 60])
def test_line_dedup_over_ranges(spark, hot_lines, ranges):
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ld.line_dedup(hot_lines).drop("keep_bitmap").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
    assert sorted(repr(tuple(r)) for r in got) == brute(rows_of(hot_lines))


@pytest.mark.parametrize(("chars", "docs"), [(20, 3), (1, 1), (5, 2)])
def test_line_dedup_on_odd_rows(odd_documents, chars, docs):
    got = ld.line_dedup(odd_documents, min_chars=chars, min_docs=docs, with_text=True)
    rows = got.collect()
    assert sorted(repr(tuple(r)[:4]) for r in rows) == brute(rows_of(odd_documents), chars, docs)
    for r in rows:
        keep = np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bitmap), np.uint8))[: r.n_lines]
        assert int(keep.sum()) == r.n_lines - r.n_dropped
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
    assert ld.line_dedup(odd_documents.limit(0)).count() == 0


def test_bitmaps_only_for_documents_that_lose_lines(hot_lines):
    assert ld.dropped_lines(hot_lines, min_chars=1000).count() == 0
    assert 0 < ld.dropped_lines(hot_lines).count() <= 400
