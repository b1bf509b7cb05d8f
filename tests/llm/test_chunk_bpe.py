import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanstar.llm import chunk_bpe as cb
from gleanstar.llm.encoder import Encoder
from gleanstar.llm.q_token_blocks import WORD_BPE
from gleanstar.llm.registry import table
from gleanstar.llm.rows import text_buffer

tokenizers = pytest.importorskip("tokenizers")
import pyarrow as pa  # noqa: E402


def brute(rows):
    t = tokenizers.Tokenizer.from_file(WORD_BPE)
    out = []
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False))]
        out.append((doc_id, len(ids), *sha))
    return sorted(map(repr, out))


def test_equal_passages_give_equal_chunks():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeé"), 6)) for _ in range(900)]
    passage = " ".join(words[:400])
    texts = [" ".join(words[500:700]) + " " + passage, "x " + passage + " y"]
    data, offsets = text_buffer(pa.array(texts))
    cuts = cb.cut_points(data, offsets, 64)
    chunks = []
    for k in range(2):
        edges = [offsets[k], *cuts[(cuts > offsets[k]) & (cuts < offsets[k + 1])], offsets[k + 1]]
        chunks.append({data[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)})
    assert len(chunks[0] & chunks[1]) > 20


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab é'.,1\n", max_size=8), min_size=1, max_size=8), st.lists(st.booleans(), min_size=8, max_size=8))
def test_joins_are_repaired(parts, stored):
    code = getattr(test_joins_are_repaired, "code", None) or Encoder(WORD_BPE)
    test_joins_are_repaired.code = code
    runs = []
    for text, is_stored in zip(parts, stored, strict=False):
        thirds = cb.split_chunk(text) or (text, "", "")
        runs.append((text, tuple(code.encode_all(list(thirds))) if is_stored else None))
    assert cb.assemble(runs, code) == code.encode_all(["".join(parts)])[0]


@pytest.mark.parametrize("mean", [16, 512])
def test_chunk_bpe_equals_library(spark, mean):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = cb.chunk_bpe(docs, WORD_BPE, mean=mean, with_ids=True)
    rows = got.collect()
    assert sorted(repr(tuple(r)[:4]) for r in rows) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256 and len(r.ids) == 4 * r.n_tokens for r in rows)


def test_chunk_bpe_on_odd_rows(odd_documents):
    got = cb.chunk_bpe(odd_documents, WORD_BPE, mean=64)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert cb.chunk_bpe(odd_documents.limit(0), WORD_BPE).count() == 0


def test_shared_chunks_are_encoded_once(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").selectExpr("doc_id as id", "xxhash64(text) as h", "text")
    docs = docs.union(docs.selectExpr("id + 1000", "h", "text")).repartition(4)
    seen = docs.mapInArrow(cb.count_chunks(512), "d0 long, d1 long, id long, h long, n long")
    shared = seen.groupBy("d0", "d1").agg({"n": "sum"}).filter("`sum(n)` > 1").count()
    got = {}
    original = cb.sorted_store

    def spy(df, folder, stem, arrays):
        got[stem] = df
        return original(df, folder, stem, arrays)

    cb.sorted_store = spy
    try:
        cb.chunk_bpe(docs.select("id", "text"), WORD_BPE, id_col="id").count()
    finally:
        cb.sorted_store = original
    assert got["ids"].count() == got["ids"].select("d0", "d1").distinct().count() == shared > 0
