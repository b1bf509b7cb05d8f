import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanstar.llm import token_blocks as tb
from gleanstar.llm.encoder import Encoder
from gleanstar.llm.q_token_blocks import WORD_BPE
from gleanstar.llm.registry import table

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(WORD_BPE)
    t.no_padding()
    t.no_truncation()
    return t


def brute(library, docs, end=1):
    out, start = [], 0
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("size", [1 << 26, 20_000])
def test_encoder_equals_library(library, size):
    texts = [
        "", " ", "Hello, world!! don't it's we'll", "naïve café's é ́abc ﬁn", "a\x1cb \x85c\xa0d　e",
        "<|endoftext|>x <|STARTOFTEXT|> <|startoftext|>", "ΟΔΥΣΣΕΥΣ ΑΣ. İstanbul Straße ŒUVRE", "12345 a1b2 ___ --- .,;'", "日本語 テキスト 한글 각",
        "Æon ªº µm ŉ Ǆ", "tabs\tand\r\nlines\n\n", "x" * 5000, "(a) [b] {c} 'tis 's't", "end.' next,'s", "\x00 \x7f",
        "TÜRKÇESİ.", "DERSİ, EVİ!", "İSTANBUL", "ANKARA'DAKİ.", "Kelvin Å ẞ.",
    ]
    code = Encoder(WORD_BPE, size)
    for _ in range(2):
        for t, raw in zip(texts, code.encode_all(texts), strict=True):
            ids = library.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(raw, "<u4").tolist() == ids, t
            assert code.decode(np.frombuffer(raw, "<u4")) == library.decode(ids, skip_special_tokens=False)


def test_encoder_on_mixed_texts(library):
    """Capitals whose lower case is longer, combining marks, letters of many scripts, punctuation."""
    rng = random.Random(3)
    alphabet = "aBéİıŞÇ ̇́K Åßẞ'.,!?\n <|>sS1tŉǰΣς\t-_ªºÀ　·fiﬁ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(10_000)]
    code = Encoder(WORD_BPE, 20_000)
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        ids, offsets = code.encode(pa.array(part))
        for k, t in enumerate(part):
            assert ids[offsets[k] : offsets[k + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_encoder_on_columns(library):
    code = Encoder(WORD_BPE)
    column = pa.array(["x", None, "", "a b.\nc", None]).slice(1)
    ids, offsets = code.encode(column)
    assert offsets.tolist() == [0, 0, 0, 4, 4]
    assert ids.tolist() == library.encode("a b.\nc", add_special_tokens=False).ids
    assert [len(x) for x in code.encode(pa.array([], pa.string()))] == [0, 1]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aBé '.,\n\t<|>sS1")), max_size=60))
def test_encoder_on_any_text(text):
    library = tokenizers.Tokenizer.from_file(WORD_BPE) if not hasattr(test_encoder_on_any_text, "t") else test_encoder_on_any_text.t
    test_encoder_on_any_text.t = library
    code = getattr(test_encoder_on_any_text, "c", None) or Encoder(WORD_BPE)
    test_encoder_on_any_text.c = code
    assert np.frombuffer(code.encode_all([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=1200))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    index, exceptions, payload = tb.pack(ids)
    back = tb.unpack(index, exceptions, np.frombuffer(payload, np.uint8), len(ids))
    assert back.tolist() == values


def test_outliers_become_exceptions():
    ids = np.full(tb.BLOCK, 7, np.uint32)
    ids[::2] = 10
    ids[5] = 4_000_000_000
    index, exceptions, payload = tb.pack(ids)
    assert index["width"][0] == 2 and len(exceptions) == 1 and len(payload) == tb.BLOCK // 4


def test_token_blocks(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = tb.token_blocks(docs, WORD_BPE, with_ids=True).collect()
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(tuple(r)[:4] for r in got) == brute(library, rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)


def test_token_blocks_on_odd_rows(spark, library, odd_documents, monkeypatch):
    got = tb.token_blocks(odd_documents, WORD_BPE)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = [(r.doc_id, r.text or "") for r in odd_documents.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(library, rows)))
    assert tb.token_blocks(odd_documents.limit(0), WORD_BPE).count() == 0
    assert hashlib  # digests are compared in the chunk tests
