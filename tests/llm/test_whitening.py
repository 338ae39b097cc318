import math

import numpy as np
import pytest

from listwise.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, x string, d int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in vectors], SCHEMA)


def brute(vectors, k=4):
    rows = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in rows}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    return n, {i: sum((n * int(c) - int(s)) ** 2 for c, s in zip(x, sums)) for i, x in rows}, values, vecs, {
        i: (np.array(x) - sums / n) @ vecs[:, :k] / np.sqrt(values[:k]) for i, x in rows}


def check(got, vectors, k=4):
    n, deviation, values, _, want = brute(vectors, k)
    assert len(got) == k * len(want) and {r.n for r in got} == {n}
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(k):
        sign = 1 if all(abs(by[i, c + 1].whitened - w[c]) < 1e-6 for i, w in want.items()) else -1
        for i, w in want.items():
            r = by[i, c + 1]
            assert abs(r.whitened - sign * w[c]) < 1e-6 and r.deviation == deviation[i]
            assert abs(r.explained - values[c] / values.sum()) < 1e-9 and r.identity_error < 1e-9


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    check(wh.whiten(df.repartition(5)).collect(), vectors)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(c) for c in rng.normal(0, [3, 1, .5, .4, .3, .2])]) for i in range(200)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(500)]  # one vector again and again counts once in the fit
    odd = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5), (2004, []), (2005, [1.0, 2.0])]
    got = wh.whiten(table(spark, vectors + odd)).collect()
    check(got, vectors)
    assert not any(2000 <= r.vec_id < 2006 for r in got)
    again = wh.whiten(table(spark, vectors + vectors[:3])).collect()
    assert len(again) == len(got) + 12


def test_empty_and_flat(spark):
    assert wh.whiten(table(spark, [])).collect() == []
    assert wh.whiten(table(spark, [(1, None)])).collect() == []
    assert wh.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    line = wh.whiten(table(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(50)])).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)


def test_greatest_numbers_stay_exact(spark):
    vectors = [(i, [(-1.0) ** i * 2.0 ** 30 * (i + 1), float(i)]) for i in range(4)]
    got = {(r.vec_id, r.component): r for r in wh.whiten(table(spark, vectors)).collect()}
    assert got[0, 1].deviation is None and got[0, 1].n == 4
    near = [(i, [2.0 ** 18 * (i + 1), float(i)]) for i in range(4)]
    rows = [[math.floor(256 * c) for c in v] for _, v in near]
    want = [sum((4 * x - s) ** 2 for x, s in zip(row, map(sum, zip(*rows)))) for row in rows]
    assert [r.deviation for r in wh.whiten(table(spark, near)).where("component = 1").orderBy("vec_id").collect()] == want


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for d in (1, 2, 3, 10, 40):
        for _ in range(20):
            a = rng.normal(size=(d, d))
            a = a + a.T
            if rng.random() < .5:
                np.fill_diagonal(a, 0)
            w = np.linalg.eigvalsh(a)
            assert wh.inertia(a) == ((w > 1e-12).sum(), (w < -1e-12).sum())
    assert wh.inertia([[0, 1], [1, 0]]) == (1, 1) and wh.inertia(np.zeros((3, 3))) == (0, 0)


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1, 0.5], [3, 3, 3, 1, 1, 0], [1, 1 - 1e-13, 1 - 2e-13, 0.5, 0, 0], [1e8, 1, 1e-3, 1e-6, 0, 0], [2, 0, 0, 0, 0, 0],
                                    [1 + 1e-9, 1, 1 - 1e-9, 1e-2, 1e-2, 1e-2]])
def test_close_and_equal_eigenvalues(values):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    got, vectors = wh.leading(a, 4)
    want = [v for v in values[:4] if v > 6 * 2.3e-16 * values[0] * 3]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-9, atol=1e-13 * values[0])
    assert np.allclose(vectors @ vectors.T, np.eye(len(want)), atol=1e-10)
    assert np.linalg.norm(a @ vectors.T - vectors.T * got) < 1e-12 * values[0] * 6
