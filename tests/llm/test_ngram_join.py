import re

import numpy as np
import pytest

from gleanstar.llm import ngram_join as nj
from gleanstar.llm.graph import UnionFind, components
from gleanstar.llm.registry import table


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def shingles(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, percent=90, words=3):
    sets = [shingles(t, words) for _, t in rows]
    links = UnionFind()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links.union(i, j)
    out, groups = [], {}
    for i in range(len(rows)):
        groups.setdefault(links.find(i), []).append(rows[i][0])
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in groups[links.find(i)] if x is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(map(repr, out))


def got(df, **kw):
    return sorted(repr(tuple(r)) for r in nj.ngram_jaccard_join(df, **kw).collect())


@pytest.fixture(scope="module")
def families(spark):
    """Near copies around the threshold, chains, a passage shared by many, short texts."""
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary, 40))
    texts = []
    for _ in range(25):
        base = list(rng.choice(vocabulary, int(rng.integers(4, 160))))
        chain = list(base)
        for _ in range(int(rng.integers(1, 9))):
            copy = list(chain if rng.random() < 0.5 else base)
            for _ in range(int(rng.integers(0, max(2, len(copy) // 40)))):
                copy[int(rng.integers(len(copy)))] = str(rng.choice(vocabulary))
            chain = copy
            texts.append(" ".join(copy))
    texts += [passage + " " + " ".join(rng.choice(vocabulary, int(rng.integers(0, 60)))) for _ in range(60)]
    texts += [passage] * 3 + ["one", "ONE", "one two", "two one", "", "  \n", "one two three", "One  two\tthree"]
    order = rng.permutation(len(texts))
    return spark.createDataFrame([(int(k), texts[int(i)]) for k, i in enumerate(order)], "doc_id long, text string").repartition(5)


@pytest.mark.parametrize(("percent", "reach"), [(90, 100), (90, 230), (80, 100), (80, 25), (50, 0)])
def test_join_equals_all_pairs(families, percent, reach):
    assert got(families, percent=percent, reach=reach) == brute([tuple(r) for r in families.collect()], percent)


def test_other_shingles(families):
    assert got(families, percent=80, words=5, reach=25) == brute([tuple(r) for r in families.collect()], 80, 5)


def test_sliced_blocks_find_the_same(families, monkeypatch):
    monkeypatch.setattr(nj, "SLICE", 2)
    monkeypatch.setattr(nj, "LENGTHS", 4)
    assert got(families) == brute([tuple(r) for r in families.collect()])


def test_no_task_gets_a_whole_family(spark, monkeypatch):
    """A family of near copies is sent a few times over, in slices."""
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join([*base[: 3 + k % 290], f"x{k}", *base[3 + k % 290 :]]) for k in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    per_task = []
    searched = nj.searched

    def counted(rows, percent):
        per_task.extend(r["count"] for r in rows.groupBy("block", "left", "right").count().collect())
        return searched(rows, percent)

    monkeypatch.setattr(nj, "searched", counted)
    for name, size in (("SLICE", 40), ("SLICE_BYTES", 40 * 8 * 300)):
        per_task.clear()
        with monkeypatch.context() as m:
            m.setattr(nj, name, size)
            assert {r.component_id for r in nj.ngram_jaccard_join(df).collect()} == {0}
        assert len(per_task) > 10 and max(per_task) < 4 * 40 and sum(per_task) < 3 * 400


def test_slices_out_of_reach_by_size_do_not_meet(spark, monkeypatch):
    """Overlapping texts of 40 to 330 words: one block, of which each size meets its neighbours."""
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(700)]
    texts = []
    for i in range(192):
        n = int(40 * 1.1 ** (i // 8))
        start = int(rng.integers(0, 700 - n))
        texts.append(" ".join(words[start : start + n]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sent = []
    searched = nj.searched

    def counted(rows, percent):
        sent.append(rows.count())
        return searched(rows, percent)

    monkeypatch.setattr(nj, "searched", counted)
    monkeypatch.setattr(nj, "SLICE", 5)
    assert got(df) == brute(list(enumerate(texts)))
    assert len(sent) > 1 and sent[-1] < 192 * 12, sent


def test_on_odd_rows(odd_documents):
    assert got(odd_documents) == brute([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert nj.ngram_jaccard_join(odd_documents.limit(0)).count() == 0


def test_one_document_of_each_group_stays(odd_documents, families):
    stays = nj.drop_near_copies(odd_documents)
    assert stays.columns == odd_documents.columns
    ids = sorted(repr((r.doc_id, (r.text or "")[:5])) for r in stays.collect())
    assert ids == sorted(map(repr, [(1, "alpha"), (3, ""), (4, ""), (5, "wort0"), (None, ""), (7, "  \n\n "), (8, "Don't"), (7, "anoth")]))
    rows = nj.ngram_jaccard_join(families)
    assert nj.drop_near_copies(families).count() == rows.filter("doc_id = component_id").count()


def test_near_copies_cost_no_pairs():
    """A query is not compared with sets it is already linked with."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**60, 200).astype(np.uint64)
    sets = []
    for _ in range(400):
        own = base.copy()
        own[rng.integers(0, 200, 5)] = rng.integers(0, 2**60, 5).astype(np.uint64)
        sets.append(np.unique(own))

    class Counting(UnionFind):
        calls = 0

        def union(self, a, b):
            Counting.calls += 1
            super().union(a, b)

    links = Counting()
    nj.divide_skip(sets, range(400), 90, links)
    assert Counting.calls == 399 and len({links.find(k) for k in range(400)}) == 1


def test_merged_lists():
    rng = np.random.default_rng(5)
    for _ in range(300):
        lists = [sorted(rng.choice(40, int(rng.integers(1, 25)), replace=False).tolist()) for _ in range(int(rng.integers(1, 12)))]
        for least in range(1, len(lists) + 2):
            met = {v: sum(v in x for x in lists) for v in range(40)}
            assert list(nj.merge_skip(lists, least)) == [(v, k) for v, k in met.items() if k >= least]


def test_search_in_memory_equals_all_pairs():
    """Families, unlike sets that share much, two-sided searches, known components."""
    rng = np.random.default_rng(9)
    for trial in range(60):
        pool = rng.integers(0, 2**63, 60).astype(np.uint64)
        sets = [np.unique(rng.choice(pool, int(rng.integers(1, 60)))) for _ in range(12)]
        for s in list(sets):
            sets += [np.unique(np.append(s[rng.random(len(s)) > 0.06], rng.choice(pool))) for _ in range(3)]
        percent = (90, 80, 50)[trial % 3]
        sides = rng.integers(0, 3, len(sets)) if trial % 2 else np.zeros(len(sets), int)
        known = [k // 2 for k in range(len(sets))] if trial % 4 == 3 else None
        want, links = UnionFind(), UnionFind()
        for k in range(1, len(sets)):
            for tree in (want, links):
                if known and known[k] == known[k - 1]:
                    tree.union(k, k - 1)
        queries = [k for k, side in enumerate(sides) if side != nj.DATA]
        data = [k for k, side in enumerate(sides) if side != nj.QUERY]
        for a in queries:
            for b in data:
                both = len(np.intersect1d(sets[a], sets[b]))
                if a != b and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    want.union(a, b)
        nj.divide_skip(sets, queries, percent, links, data, known)
        assert [links.find(k) for k in range(len(sets))] == [want.find(k) for k in range(len(sets))]


def test_components(spark):
    chain = [(bytes([k // 256, k % 256]), bytes([(k + 1) // 256, (k + 1) % 256])) for k in range(300) if k != 150]
    star = [(b"z", b"z" + bytes([k])) for k in range(50)]
    parts = {bytes(r.node): bytes(r.component) for r in components(spark.createDataFrame(chain + star, "a binary, b binary")).collect()}
    assert len(set(parts.values())) == 3 and parts[b"\x00\x00"] == parts[bytes([0, 150])] != parts[bytes([0, 151])]
    assert components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_shared_data(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
