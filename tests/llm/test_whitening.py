import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening


def frame(spark, vectors, kind="array<float>"):
    rows = [(i, v, "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}, c0 string")


def usable(vectors, d):
    return [(i, [math.floor(64 * np.float32(c).astype(float)) + 1_000_000 for c in v]) for i, v in enumerate(vectors)
            if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]


def plain_cov(xs):
    n, d = len(xs), len(xs[0])
    mean = [Fraction(sum(x[i] for x in xs), n) for i in range(d)]
    return np.array([[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in xs) / n) for j in range(d)] for i in range(d)])


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    mixed = rng.normal(size=(6, 6)) * np.array([9, 5, 3, 2, 1, 0.5])
    out = [r.tolist() for r in rng.normal(size=(300, 6)) @ mixed + 40]
    out += [out[0], out[0], None, [], [1.0] * 5, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5]
    return out


def test_matches_exact_arithmetic(spark, vectors):
    df = frame(spark, vectors)
    model = whitening.fit(df, components=4)
    xs = usable(vectors, 6)
    cov = plain_cov([x for _, x in xs])
    assert model.n == len(xs) == 302 and model.sums == [sum(x[i] for _, x in xs) for i in range(6)]
    assert np.array_equal(model.cov, cov)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    assert np.allclose(model.variances, values) and np.allclose(np.abs((model.axes * axes).sum(axis=0)), 1)
    got = {r.vec_id: r for r in whitening.whiten(df, model).collect()}
    assert set(got) == {i for i, _ in xs} and all(r.c0 == "x" for r in got.values())
    mean = [Fraction(s, model.n) for s in model.sums]
    white = []
    for i, x in xs:
        assert got[i].deviation == sum((model.n * c - s) ** 2 for c, s in zip(x, model.sums))
        want = [sum(float(c - m) * a for c, m, a in zip(x, mean, model.axes[:, k])) / math.sqrt(values[k]) for k in range(4)]
        assert np.allclose(got[i].whitened, want, atol=1e-9)
        white.append(got[i].whitened)
    error = np.abs(np.cov(np.array(white).T, bias=True) - np.eye(4)).max()
    assert abs(whitening.identity_error(df, model) - error) < 1e-9 and error < 1e-8


def test_rows_by_component(spark, vectors):
    df = frame(spark, vectors, "array<double>")
    model = whitening.fit(df)
    rows = whitening.components(df, model, "vec_id").collect()
    assert len(rows) == 6 * 302 and {r.component for r in rows} == set(range(1, 7))
    assert {r.n for r in rows} == {302} and len({r.identity_error for r in rows}) == 1
    assert math.isclose(sum(r.explained for r in rows if r.vec_id == 0), 1)


@pytest.mark.parametrize("vectors", [[], [None, []], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[float("nan")]]])
def test_no_direction_without_variance(spark, vectors):
    df = frame(spark, vectors)
    model = whitening.fit(df)
    assert len(model.variances) == 0
    assert whitening.components(df, model, "vec_id").count() == 0


def test_fewer_directions_than_asked_for(spark):
    df = frame(spark, [[float(i), 2.0 * i, 7.0] for i in range(50)])
    model = whitening.fit(df)
    assert len(model.variances) == 1 and model.explained[0] > 0.999
    assert whitening.identity_error(df, model) < 1e-9


def test_far_values_stay_exact(spark):
    far = [[1e300, 1.0], [-1e300, 2.0], [1e12, 3.0], [5.0, -1e9]]
    df = frame(spark, far, "array<double>")
    model = whitening.fit(df)
    xs = [[int(min(max(math.floor(64 * c), -whitening.FAR), whitening.FAR)) + 1_000_000 for c in v] for v in far]
    assert model.sums == [sum(x[i] for x in xs) for i in range(2)]
    assert np.array_equal(model.cov, plain_cov(xs))
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(df, model).collect()}
    assert got == {i: sum((4 * c - s) ** 2 for c, s in zip(x, model.sums)) for i, x in enumerate(xs)}


def test_square_sums_are_exact():
    rng = np.random.default_rng(1)
    for most in (3, 1 << 20, 1 << 29, 1 << 40):
        x = rng.integers(-most, most, (5000 if most < 1 << 30 else 20, 3))
        rows = x.astype(object)
        got = whitening.square_sums(x)
        for i in range(3):
            for j in range(i, 3):
                pair = rows[:, i] if i == j else rows[:, i] + rows[:, j]
                assert got[i, j] == (pair * pair).sum()
