import numpy as np
import pytest

from playmart.llm import whiten as W
from tests.conftest import tuples

DDL = "vec_id bigint, embedding array<double>"


def matrices():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 33, 64):
        a = rng.normal(size=(n, n))
        yield a + a.T
        yield a @ a.T
        q = np.linalg.qr(a)[0]
        b = (q * rng.integers(0, 3, n)) @ q.T          # repeated eigenvalues
        yield (b + b.T) / 2
        yield (lambda b: b @ b.T)(rng.normal(size=(n, 2)))   # rank two
    yield np.eye(7) * 3.5
    yield np.zeros((3, 3))
    yield np.diag([1.0, 1.0 + 1e-9, 1.0 + 2e-9, 5.0])


@pytest.mark.parametrize("a", list(matrices()), ids=lambda a: str(len(a)))
def test_leading_pairs(a):
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    scale = max(1.0, np.abs(want).max())
    pairs = W.leading(a, 4)
    got = np.array([value for value, _ in pairs])
    u = np.stack([v for _, v in pairs], axis=1)
    assert np.allclose(got, want[:4], atol=1e-12 * scale, rtol=0) and (np.diff(got) <= 0).all()
    assert np.abs(a @ u - u * got).max() < 1e-11 * scale
    assert np.allclose(u.T @ u, np.eye(u.shape[1]), atol=1e-10)


def test_inertia_counts_equal_the_spectrum():
    rng = np.random.default_rng(2)
    for n in (1, 4, 20):
        a = rng.normal(size=(n, n))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in rng.uniform(values.min() - 1, values.max() + 1, 30):
            shifted = W.Shifted(a, shift)
            assert shifted.below() == (values < shift).sum()
            b = rng.normal(size=n)
            assert np.allclose((a - shift * np.eye(n)) @ shifted.solve(b), b, atol=1e-6)
    # zero diagonals need pivots of two rows
    assert W.Shifted(np.array([[0.0, 1], [1, 0]]), 0.0).below() == 1


def brute(rows, components=4):
    x = {i: tuple(int(np.floor(256 * float(c))) for c in v) for i, v in rows}
    fit = np.array(sorted(set(x.values())), float)
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return x, n, s, values, vectors, np.trace(v)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(1000 + k, rows[0][1]) for k in range(150)]  # copies do not weigh
    x, n, s, values, vectors, trace = brute(rows)
    got = tuples(W.whiten(spark.createDataFrame(rows, DDL).repartition(7)))
    assert len(got) == 4 * len(rows) and {r[2] for r in got} == {n} and n == 400
    w = {(r[0], r[1]): r for r in got}
    for c in range(4):
        sign = None
        for i, v in x.items():
            r = w[i, c + 1]
            want = (np.array(v) - s / n) @ vectors[:, c] / np.sqrt(values[c])
            sign = sign or (1 if want * r[4] > 0 else -1)
            assert abs(r[4] - sign * want) < 1e-9
            assert r[3] == sum((n * a - int(b)) ** 2 for a, b in zip(v, s))
            assert abs(r[5] - values[c] / trace) < 1e-9 and r[6] < 1e-9


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, -1.0]), (2, None), (3, [nan, 1.0]),
            (4, [inf, 1.0]), (5, [None, 1.0]), (6, [0.5]), (7, [-0.0, 0.0])]
    df = spark.createDataFrame([r + (1.0, 2) for r in rows], DDL + ", x double, component int")
    got = tuples(W.whiten(df))
    assert sorted((r[0] is None, r[0] or 0, r[1]) for r in got) == sorted(
        (k is None, k or 0, c) for k in (1, 1, None, 6, 7) for c in (1, 2))
    assert {r[2] for r in got} == {4}          # (0.5, 1), (0.25, -1), (0.5, 0) and (0, 0)
    assert W.whiten(df.limit(0)).count() == 0
    one = tuples(W.whiten(df.where("vec_id = 1")))  # a single vector has no variance
    assert len(one) == 4 and all(r[3] == 0 and r[4] is None for r in one)
    huge = tuples(W.whiten(spark.createDataFrame([(1, [1e9]), (2, [-1e9])], DDL)))
    assert {r[3] for r in huge} == {None} and {round(abs(r[4]), 9) for r in huge} == {1.0}
