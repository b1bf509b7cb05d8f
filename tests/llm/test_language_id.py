import zlib
from collections import Counter

import numpy as np
import pytest

from gleanstar.llm import language_id as li
from gleanstar.llm.registry import table


def normal(text):
    out = []
    for c in text:
        c = c.lower() if c.isalpha() and len(c.lower()) == 1 else (c if c.isalpha() else " ")
        if c != " " or not out or out[-1] != " ":
            out.append(c)
    return "".join(out)


def grams(texts, n=li.ORDER):
    found = Counter()
    for t in texts:
        padded = "\0" * (n - 1) + normal(t)
        found.update(padded[i - n + 1 : i + 1] for i in range(n - 1, len(padded)))
    return found


def plain_kn(counts, alphabet):
    """Interpolated Kneser-Ney by dictionaries."""
    levels = {li.ORDER: dict(counts)}
    for n in range(li.ORDER - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def p(gram):
        if not gram:
            return 1 / (alphabet + 1)
        level = levels[len(gram)]
        values = Counter(level.values())
        d = values[1] / (values[1] + 2 * values[2]) if values[1] else 0.5
        d = min(max(d, 0.1), 0.9)
        same = [c for g, c in level.items() if g[:-1] == gram[:-1]]
        if not same:
            return p(gram[1:])
        own = max(level.get(gram, 0) - d, 0) / sum(same)
        return own + d * len(same) / sum(same) * p(gram[1:])

    return p


TEXTS = {"xx": ["abab abba, baab!", "aabb abab"], "yy": ["cdcd dcc abc", "ddc ccd Ddc é"]}


def trained():
    counts = {}
    for lang, texts in TEXTS.items():
        parts = []
        for _, _, codes, _, skip in li.coded_groups(texts):
            parts.append(li.keyed(codes)[skip:][codes[skip:] != 0])
        counts[lang] = np.unique(np.concatenate(parts), return_counts=True)
    return li.Model(counts)


def test_probabilities_equal_plain_kneser_ney():
    model = trained()
    alphabet = len(set().union(*(normal(t) for ts in TEXTS.values() for t in ts)))
    models = [plain_kn(grams(TEXTS[k]), alphabet) for k in ("xx", "yy")]
    texts = ["abcd", "ab  ,dd zq", "é", "x", "cdcd dcc abba"]
    got, letters = model.cross_entropies(texts)
    for i, t in enumerate(texts):
        padded = "\0" * 3 + normal(t)
        for j, p in enumerate(models):
            want = -np.mean([np.log(p(padded[k - 3 : k + 1])) for k in range(3, len(padded))])
            assert got[i, j] == pytest.approx(want, rel=1e-5), (t, j)
    assert letters.tolist() == [4, 6, 1, 1, 11]
    # each model is a distribution over the alphabet and one unknown character
    chars = sorted(set().union(*(normal(t) for ts in TEXTS.values() for t in ts)))
    for p in models:
        assert sum(p("ab" + " " + c) for c in [*chars, "?"]) == pytest.approx(1)


def test_long_texts_score_as_whole(monkeypatch):
    model = trained()
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcd  ,é\0"), 500)) for _ in range(3)] + ["", "   ", "ab"]
    whole, letters = model.cross_entropies(texts)
    monkeypatch.setattr(li, "PART", 37)
    parts, again = model.cross_entropies(texts)
    assert np.allclose(whole, parts, rtol=1e-6) and letters.tolist() == again.tolist() and letters[3] == letters[4] == 0


def test_letters_beyond_the_first_plane():
    """They neither begin a text nor are blanks, and no two are the same."""
    model = trained()
    texts = ["ab\U00010000ab", "cdcd dcc", "\U00020020\U00020020", "a\U00020000\U00030000 b", "", "abab", "\U00010400 \U0001f600"]
    got, letters = model.cross_entropies(texts)
    alone = [model.cross_entropies([t]) for t in texts]
    assert letters.tolist() == [5, 7, 2, 4, 0, 4, 1] == [int(n[0]) for _, n in alone]
    assert np.allclose(got, np.concatenate([h for h, _ in alone]))
    codes = [li._codes(c).tolist() for c in ("\U00010000", "\U00020000", "\U00030000", "\U00020020", "\U00010428", "\u4e00")]
    assert len(set(map(tuple, codes))) == 6 and li._codes("\U00010400").tolist() == codes[4]
    counts = {}
    for lang, c in (("xx", "\U00020000"), ("yy", "\U00030000")):
        ((_, _, own, _, _),) = li.coded_groups([c * 20])
        counts[lang] = np.unique(li.keyed(own)[own != 0], return_counts=True)
    h, _ = li.Model(counts).cross_entropies(["\U00020000" * 5, "\U00030000" * 5])
    assert h.argmin(axis=1).tolist() == [0, 1]


def test_odd_rows(spark, odd_documents):
    got = li.language_id(odd_documents, sample=50).collect()
    assert len(got) == odd_documents.count()
    for r in got:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert r.held_out == held and 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "fr", "und")
    und = {(r.doc_id, r.score, r.accepted) for r in got if r.lang_pred == "und"}
    assert und == {(3, 0.0, False), (4, 0.0, False), (None, 0.0, False)}
    assert li.language_id(odd_documents.limit(0)).count() == 0
    unlabelled = odd_documents.withColumn("lang", odd_documents["lang"].substr(1, 0)).selectExpr("* except(lang)", "nullif(lang, '') as lang")
    assert {r.lang_pred for r in li.language_id(unlabelled).collect()} == {"und"}
    kept = li.keep_accepted(odd_documents, sample=50)
    assert kept.columns == odd_documents.columns


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = li.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in got)
    assert len(got) > 250 and right >= 0.99 * len(got)
    assert sum(r.accepted for r in got) >= 0.99 * len(got)


def test_other_scripts_score_low(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(-1, "これは日本語の文章です " * 20, None)], docs.schema)
    got = {r.doc_id: r for r in li.language_id(docs.union(strange)).collect()}
    assert not got[-1].accepted and got[-1].lang_pred != "und"
