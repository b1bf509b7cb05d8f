import os
import shutil

import pytest
from llm import test_chunk_bpe, test_decontaminate, test_ngram_join

import corpus_pipeline as cp
from gleanstar.llm.language_id import language_id
from gleanstar.llm.registry import table
from gleanstar.session import stage

SF_DIR = "/root/testdata/sf0.001"


def brute(docs, items, accepted):
    """docs: {id: text} with distinct ids."""
    left = {i: t for i, t in docs.items() if i in accepted}
    largest = {t: max(i for i in left if left[i] == t) for t in set(left.values())}
    left = {i: t for t, i in largest.items()}
    parts = dict(eval(r)[::2] for r in test_ngram_join.brute(sorted(left.items()), 80, 5))
    left = {i: t for i, t in left.items() if parts[i] == i}
    dirty = {r[0] for r in map(eval, test_decontaminate.brute(sorted(left.items()), items)) if r[5]}
    return test_chunk_bpe.brute([(i, t) for i, t in sorted(left.items()) if i not in dirty])


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    accepted = {r.doc_id for r in language_id(docs).filter("accepted").collect()}
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = cp.run(spark, SF_DIR)
    want = brute(texts, items, accepted)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want
    assert 0 < len(want) < len(texts)


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_rows(spark, odd_documents, rows, tmp_path):
    shutil.copy(f"{SF_DIR}/benchmark.parquet", tmp_path / "benchmark.parquet")
    docs = odd_documents if rows == "odd" else odd_documents.limit(0)
    for _, step in cp.STAGES[:-1]:
        kept = stage(step(spark, docs, str(tmp_path)), "kept")
        assert kept.columns == odd_documents.columns
        docs = kept
    last = cp.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.count() == docs.count() and (docs.count() > 0) == (rows == "odd")
    assert os.path.isdir(SF_DIR)
