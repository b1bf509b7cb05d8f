import numpy as np
import pytest

from gleanstar.llm import whitening as wh
from gleanstar.llm.registry import table


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 64])
@pytest.mark.parametrize("kind", ["random", "steep", "close", "multiple", "low rank", "diagonal", "zero"])
def test_spectral_division_equals_eigh(n, kind):
    rng = np.random.default_rng(n)
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    e = {
        "random": rng.random(n) * 100, "steep": 10.0 ** -np.linspace(0, 12, n), "close": 1 + np.arange(n) * 1e-9,
        "multiple": np.repeat([5.0, 2.0], n)[:n], "low rank": np.where(np.arange(n) < n // 2, 3.0 + np.arange(n), 0),
        "diagonal": np.arange(n) + 1.0, "zero": np.zeros(n),
    }[kind]
    a = np.diag(e) if kind == "diagonal" else q @ np.diag(e) @ q.T
    values, v = wh.components((a + a.T) / 2)
    assert np.abs(v.T @ v - np.eye(n)).max() < 1e-12
    assert np.abs(a @ v - v * values).max() < 1e-12 * n * max(1, np.abs(e).max())
    assert np.abs(values - np.sort(e)[::-1]).max() < 1e-11 * max(1, np.abs(e).max())


def test_polar_factor():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.abs(wh.qdwh(a) - v @ np.diag(np.sign(e)) @ v.T).max() < 1e-12


def brute(vectors):
    x = np.floor(np.array(vectors, float) * 64) + 1_000_000
    n, s = len(x), [int(t) for t in x.astype(np.int64).sum(axis=0)]
    c = x - np.array([t / n for t in s])
    e, v = np.linalg.eigh(c.T @ c / n)
    deviation = [sum((n * int(a) - t) ** 2 for a, t in zip(row, s, strict=True)) for row in x]
    return deviation, c @ v[:, ::-1] / np.sqrt(e[::-1]), e[::-1] / e.sum()


def test_whitening_equals_brute_force(spark):
    rows = table(spark, "/root/testdata/sf0.001", "embeddings")
    data = {r.vec_id: r.embedding for r in rows.collect()}
    deviation, whitened, explained = brute([data[k] for k in sorted(data)])
    got = wh.whitened_components(rows).collect()
    assert len(got) == 32 * len(data)
    place = {k: i for i, k in enumerate(sorted(data))}
    sign = {}
    for r in got:
        i, k = place[r.vec_id], r.component - 1
        assert r.n == len(data) and r.deviation == deviation[i] and r.explained == pytest.approx(explained[k], rel=1e-9)
        s = sign.setdefault(k, np.sign(r.whitened * whitened[i, k]))
        assert r.whitened * s == pytest.approx(whitened[i, k], abs=1e-8)
        assert r.identity_error < 1e-10


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 0.5], 7), (2, [0.0, 1.0, -1.0], None), (2, [0.0, 1.0, -1.0], None), (None, [3.0, 3.0, 3.0], 1),
        (4, None, 1), (5, [1.0, None, 2.0], 1), (6, [nan, 1.0, 1.0], 1), (7, [1.0, inf, 1.0], 1), (8, [], 1), (9, [1.0, 2.0], 1), (10, [1e30, 0.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int").selectExpr("*", "vec_id as row", "x as n")
    out = wh.whitened_components(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    kept = [r for r in rows if r[0] in (1, 2, None)]
    deviation, whitened, _ = brute([r[1] for r in kept])
    assert sorted({(repr(r.vec_id), r.deviation) for r in got}) == sorted({(repr(k[0]), d) for k, d in zip(kept, deviation, strict=True)})
    # three different vectors span two directions
    assert {r.component for r in got} == {1, 2} and len(got) == 8 and {r.n for r in got} == {4}
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")
    assert wh.whitened_components(same).count() == 0
    out, model, error = wh.whiten(same)
    plain = out.collect()
    assert model.n == 3 and error == 0
    assert [(r.row.vec_id, r.deviation, r.whitened) for r in plain] == [(1, 0, [])] * 3
    assert wh.whitened_components(df.limit(0)).count() == 0
    whole, model, error = wh.whiten(df)
    assert {r.row.x for r in whole.collect()} == {7, None, 1} and whole.schema["row"].dataType.names == df.columns
    assert model.n == 4 and error < 1e-10


def test_deviation_beyond_a_long():
    x = np.array([[2**40, 5], [1, 1]])
    assert wh._deviation(x, 2**20, np.array([0, 0])) == [None, 2**41]
    assert wh._deviation(x, 2, np.array([1, 1])) == [None, 2]
    assert wh._deviation(x // 2**20, 2, np.array([1, 1])) == [(2**21 - 1) ** 2 + 1, 2]


def test_directions_without_variance(spark):
    # one direction without variance is no component
    flat = spark.createDataFrame([(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(30)], "vec_id long, embedding array<float>")
    assert {r.component for r in wh.whitened_components(flat).collect()} == {1, 2}
