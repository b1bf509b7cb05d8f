import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanstar.llm import exact_dedup as ed


def brute(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        g = groups[text or ""]
        ids = [i for i in g if i is not None]
        best = keep(ids) if ids else None
        out.append((doc_id, best, len(g), doc_id == best, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(map(repr, out))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(-5, 5)), max_size=60))
def test_trie_holds_every_string(pairs):
    trie, want = ed.PatriciaTrie(), {}
    for key, ident in pairs:
        trie.insert(key, (ident, 1))
        want[key] = (min(ident, want[key][0]), want[key][1] + 1) if key in want else (ident, 1)
    assert dict(trie.walk()) == want
    spilled = {}
    while trie.sizes:
        spilled |= dict(trie.spill())
    left = dict(trie.walk())
    assert spilled | left == want and set(left) <= {b""}


@pytest.mark.parametrize(("keep", "pick"), [("smallest", min), ("largest", max)])
@pytest.mark.parametrize("limit", [ed.TRIE_BYTES, 700])
def test_exact_dedup(odd_documents, keep, pick, limit):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = ed.exact_dedup(odd_documents, keep=keep, limit=limit)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows, pick)
    assert ed.exact_dedup(odd_documents.limit(0)).count() == 0


def test_drop_copies_keeps_columns(odd_documents):
    got = ed.drop_copies(odd_documents, keep="largest")
    assert got.columns == odd_documents.columns
    rows = got.collect()
    assert len(rows) == len({r.text or "" for r in odd_documents.collect()})
    assert {r.doc_id for r in rows if r.text and r.text.startswith("alpha")} == {2}
    assert {r.doc_id for r in rows if not r.text} == {4}
    assert ed.drop_copies(odd_documents.limit(0)).count() == 0


def test_hot_group_leaves_each_task_once(spark):
    docs = spark.range(0, 4000, 1, 8).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', concat('t', id)) as text")
    read = docs.selectExpr("cast(text as binary) as text", "doc_id as ident")
    local = read.mapInArrow(ed.local_tries(ed.TRIE_BYTES), "length long, hash long, text binary, ident long, n long")
    assert local.filter("length = 4 and text = cast('same' as binary)").count() == 8
    assert {r.keep_id for r in ed.exact_dedup(docs, keep="largest").filter("group_size > 1").collect()} == {3999}


def test_common_beginnings_are_inner_nodes():
    """Texts of one length are told apart within their bytes, not by a hash before them."""
    trie = ed.PatriciaTrie()
    texts = [b"the same long beginning of %d " % (i // 10) + b"end %04d" % i for i in range(500)]
    for i, text in enumerate(texts):
        trie.insert(text, (i, 1))
    stack, inner, held = [trie.root], 0, 0
    while stack:
        node = stack.pop()
        inner += len(node.children) > 1
        held += len(node.label)
        stack += node.children.values()
    assert inner > 50 and held < sum(map(len, texts)) / 4


def test_hash_is_that_of_spark(spark):
    texts = ["", "a", "ünï" * 40, "x" * 1000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) as h").collect()
    assert all(ed.content_hash(r.t.encode()) == r.h for r in got)
