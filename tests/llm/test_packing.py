import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanstar.llm import packing as pk
from gleanstar.llm.q_token_blocks import WORD_BPE
from gleanstar.llm.registry import table

tokenizers = pytest.importorskip("tokenizers")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60), st.integers(1, 6))
def test_every_id_once_and_no_padding(lengths, window):
    packer = pk.Packer(16, window, pk.cost)
    pieces, at = [], 0
    for d, n in enumerate(lengths):
        pieces += packer.add(d, np.arange(at, at + n))
        at += n
    pieces += packer.close()
    assert sorted(i for p in pieces for i in p[2].tolist()) == list(range(at))
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(int)
    sequences = {}
    for doc, start, ids, total, s, offset, spent in pieces:
        assert ids[0] == starts[doc] + start and total == lengths[doc]
        sequences.setdefault(s, []).append((offset, len(ids), spent))
    for parts in sequences.values():
        parts.sort()
        n = sum(x[1] for x in parts)
        assert [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts)])[:-1].tolist()
        assert n <= 16 and n & (n - 1) == 0
        assert parts[0][2] == pytest.approx(sum(pk.cost(p[1]) for p in parts))


def test_costs_are_balanced():
    rng = np.random.default_rng(4)
    lengths = (rng.pareto(1.2, 4000) * 60 + 5).astype(int).clip(5, 1500).tolist()
    sequences = sum(lengths) // 4096
    quadratic = 1 / 512

    def weigh(n):
        return pk.cost(n, 1.0, quadratic)

    def spread(pieces):
        spent = np.zeros(sequences)
        for _, _, n, s, _ in pieces:
            spent[s] += weigh(n)
        return spent.std() / spent.mean()

    balanced, _ = pk.balanced(lengths, [4096] * sequences, weigh)
    # against the same documents laid one after another
    edges = np.cumsum([0, *lengths])
    plain = []
    for d, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        while a < b and a // 4096 < sequences:
            to = min(b, (a // 4096 + 1) * 4096)
            plain.append((d, 0, to - a, a // 4096, 0))
            a = to
    assert spread(balanced) < 0.75 * spread(plain)
    # few documents are cut that a sequence could hold
    assert len(balanced) < 1.1 * len(lengths)


def check(rows, docs):
    t = tokenizers.Tokenizer.from_file(WORD_BPE)
    expected = {}
    for doc_id, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        expected.setdefault(doc_id, []).append(ids)
    sequences, got = {}, {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for parts in sequences.values():
        parts.sort()
        n = sum(x[1] for x in parts)
        assert [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts)])[:-1].tolist()
        assert n == 4096 or n < 4096 and n & (n - 1) == 0
    for doc_id, texts in expected.items():
        for size in {len(x) for x in texts}:
            same = [x for x in texts if len(x) == size]
            parts = sorted(got.pop((doc_id, size)), key=lambda p: p[0])
            if len(same) == 1:
                assert [i for _, ids in parts for i in ids] == same[0]
            assert sum(len(ids) for _, ids in parts) == size * len(same)
    assert not got


def test_packing_equals_library(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = pk.pack_documents(docs.repartition(3), WORD_BPE, with_ids=True, window=4)
    check(got.collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_packing_of_odd_rows(spark, odd_documents):
    got = pk.pack_documents(odd_documents, WORD_BPE, with_ids=True)
    assert got.columns[:8] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_cost"]
    check(got.collect(), [(r.doc_id, r.text) for r in odd_documents.collect()])
    assert pk.pack_documents(odd_documents.limit(0), WORD_BPE).count() == 0
