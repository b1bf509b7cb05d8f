import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanstar.llm import elias_fano as ef
from gleanstar.llm import ngram_trie as nt
from gleanstar.llm.registry import table


@settings(max_examples=120, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**63)), max_size=300), st.booleans())
def test_elias_fano(values, distinct):
    values = np.array(sorted(set(values) if distinct else values), np.uint64)
    seq = ef.EliasFano(ef.encode(values))
    assert seq.all().tolist() == values.tolist() == ef.from_bytes(ef.to_bytes(values)).tolist()
    if len(values):
        assert seq.access(np.arange(len(values))).tolist() == values.tolist()
    asked = np.unique(np.concatenate([values, values + np.uint64(1), np.array([0, 5, 2**62], np.uint64)]))
    for v, at in zip(asked.tolist(), seq.find(asked).tolist(), strict=True):
        assert (at >= 0 and int(values[at]) == v) if v in set(values.tolist()) else at == -1


def test_quantised_values_are_near():
    values = np.random.default_rng(0).random(10_000) ** 4
    q = nt.quantised(values, "")
    back = q["book"][q["code"]]
    assert len(q["book"]) <= 256 and np.abs(np.log((back + 1e-4) / (values + 1e-4))).mean() < 0.05


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows, order, cutoff=nt.CUTOFF, d=nt.DISCOUNT):
    """Dictionaries, without quantisation; an n-gram needs its shorter context to be kept."""
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    train = [tokens(t) for (_, t), h in zip(rows, held, strict=True) if not h]
    words = Counter(w for t in train for w in t)
    total, v = sum(words.values()), len(words)
    kept, context_total, rest = [], [], []
    for n in range(2, order + 1):
        grams = Counter()
        for t in train:
            s = ["<s>", *t]
            for i in range(n - 1, len(s)):
                g = tuple(s[i - n + 1 : i + 1])
                if n == 2 or g[:-1] in kept[-1]:
                    grams[g] += 1
        sums = Counter()
        for g, c in grams.items():
            sums[g[:-1]] += c
        kept.append({g: c for g, c in grams.items() if c >= cutoff})
        context_total.append(sums)
        left = {h: 1.0 for h in sums}
        for g, c in kept[-1].items():
            left[g[:-1]] -= (c - d) / sums[g[:-1]]
        rest.append(left)
    out = []
    for (i, text), h in zip(rows, held, strict=True):
        t = tokens(text)
        base = score = 0.0
        s = ["<s>", *t]
        for k in range(1, len(s)):
            p = (words[s[k]] + 1) / (total + v + 1)
            base += np.log10(p)
            for n in range(2, order + 1):
                if k - n + 1 < 0:
                    break
                g = tuple(s[k - n + 1 : k + 1])
                if n > 2 and g[:-1] not in kept[n - 3]:
                    break
                if g[:-1] in rest[n - 2]:
                    p = max(kept[n - 2].get(g, 0) - d, 0) / context_total[n - 2][g[:-1]] + rest[n - 2][g[:-1]] * p
            score += np.log10(p)
        out.append((i, h, len(t), sum(words[w] > 0 for w in t), total, base, score))
    return out


def check(df, order, **kw):
    got = sorted(nt.lm_scores(df, order=order, **kw).collect(), key=lambda r: (repr(r[0]), r[2], r[5]))
    want = sorted(brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], order, **kw), key=lambda r: (repr(r[0]), r[2], r[5]))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9)
        assert g.score == pytest.approx(w[6], rel=0.02, abs=0.05)
    return got


@pytest.mark.parametrize(("order", "cutoff"), [(1, 2), (2, 1), (3, 2), (4, 1)])
def test_scores_equal_dictionaries(spark, order, cutoff):
    rng = np.random.default_rng(order)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 40)))) + "  New%d\n" % (i % 9)) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(df, order, cutoff=cutoff)


def test_model_beats_base_on_held_out_texts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = [r for r in nt.lm_scores(docs).collect() if r.held_out]
    assert len(got) > 80 and sum(r.score for r in got) > sum(r.base_score for r in got)


def test_odd_rows(odd_documents):
    check(odd_documents, 3)
    assert nt.lm_scores(odd_documents.limit(0)).count() == 0
    # nothing to learn from
    held = odd_documents.filter("doc_id = 2 or doc_id = 9").limit(0).union(odd_documents.filter("pmod(crc32(cast(doc_id as string)), 7) = 2"))
    for r in nt.lm_scores(held).collect():
        assert r.train_tokens == 0 and r.base_score == r.score == 0.0 and r.n_known == 0
