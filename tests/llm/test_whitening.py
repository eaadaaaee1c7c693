"""Spectral divide and conquer and whitening, against plain arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from pagequarry.llm import queries, spectral, whitening

SCHEMA = "vec_id long, embedding array<double>, x string"


def symmetric(seed, values):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    return q * values @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [3.0, 1.0],
        [2.0, 2.0, 2.0],
        [5.0, 5.0, 1.0, 1.0, 1.0, 0.0],
        [0.0] * 4,
        [1.0, 0.0, -1.0],
        [-99.0] + [1.0] * 99,
        list(np.linspace(1, 2, 64)),
        list(np.logspace(0, -14, 30)),
        list(np.random.default_rng(1).normal(size=130)),
        [1.0, 1.0 + 1e-9, 1.0 + 2e-9, 4.0],
    ],
)
def test_eigen(values):
    values = np.array(values)
    a = symmetric(len(values), values)
    found, vectors = spectral.eigen(a)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-13 * scale


def test_polar_factor():
    a = np.random.default_rng(2).normal(size=(40, 40))
    u = spectral.polar_factor(a)
    left, _, right = np.linalg.svd(a)
    assert np.abs(u - left @ right).max() < 1e-12


def plain_whitening(rows, most=4):
    """Whole numbers and fractions where they are exact, the library's eigenvectors else."""
    kept = [(i, v) for i, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in kept]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    total = (centred**2).sum() / n
    found = []
    for i, x in kept:
        own = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        for k, e in enumerate(values):
            found.append((i, k + 1, n, deviation, own @ vectors[:, k] / math.sqrt(e), e / total))
    return found


def assert_same(got, want):
    got = sorted(got, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component, abs(r.whitened)))
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4])))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [r[:4] for r in want]
    for k in {r.component for r in got}:
        one = np.array([r.whitened for r in got if r.component == k])
        two = np.array([r[4] for r in want if r[1] == k])
        assert min(np.abs(one - two).max(), np.abs(one + two).max()) < 1e-9
    assert all(abs(r.explained - w[5]) < 1e-12 for r, w in zip(got, want, strict=True))
    assert all(r.identity_error < 1e-9 for r in got)


def run(spark, rows, schema=SCHEMA, parts=3):
    vectors = whitening.on_lattice(spark.createDataFrame(rows, schema).repartition(parts))
    return whitening.whiten(vectors, whitening.fit(vectors, components=4)).collect()


def test_query_equals_plain_whitening(spark, testdata):
    rows = [tuple(r) for r in spark.read.parquet(f"{testdata}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op13_whitening(spark, testdata).collect()
    assert len(got) == 4 * len(rows)
    assert_same(got, plain_whitening(rows))


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist(), "a") for i in range(40)]
    rows += [(7, rows[7][1], "a"), (99, rows[7][1], "b"), (None, rows[8][1], None)]
    rows += [(50, None, "a"), (51, [1.0, None, 0.0, 0.0, 0.0, 0.0], "a"), (52, [math.nan] * 6, "a")]
    rows += [(53, [math.inf] + [0.0] * 5, "a"), (54, [-0.0] * 6, "a"), (55, [-math.inf] * 6, "a")]
    want = plain_whitening(rows)
    assert_same(run(spark, rows), want)
    assert_same(run(spark, rows + [(60, [1.0, 2.0], "a"), (61, [], "a")]), want)


def test_few_dimensions_and_equal_vectors(spark):
    rows = [(i, [float(i % 5), 1.0], "") for i in range(50)]
    got = run(spark, rows)
    assert len(got) == 50 and {r.component for r in got} == {1} and {r.n for r in got} == {5}
    assert all(abs(r.explained - 1) < 1e-12 for r in got)
    assert run(spark, [(i, [0.5, 0.25], "") for i in range(9)]) == []
    assert run(spark, []) == []
    assert run(spark, [(1, None, ""), (2, [], "")]) == []


def test_deviations_beyond_and_below_a_long(spark):
    rows = [(1, [2.0**40, 0.0], ""), (2, [-(2.0**40), 1.0], ""), (3, [1e300, 1.0], ""), (4, [1.0, 2.0], "")]
    assert {r.deviation for r in run(spark, rows) if r.vec_id != 4} == {None}
    model = whitening.Whitening(3, [2**62, 5], np.eye(2), [], 0.0)
    x = np.array([[2**62 // 3, 1], [1, 2], [2**62 // 3 + 10**9, -4]])
    want = [sum((3 * a - s) ** 2 for a, s in zip(r, model.sums, strict=True)) for r in x.tolist()]
    assert model.deviations(x) == [v if v < 2**63 else None for v in want]


def test_all_components_whiten(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=5) @ np.diag([9, 3, 1, 1, 0.3])).tolist(), "") for i in range(300)]
    vectors = whitening.on_lattice(spark.createDataFrame(rows, SCHEMA))
    model = whitening.fit(vectors)
    got = whitening.whiten(vectors, model).toPandas().pivot(index="vec_id", columns="component", values="whitened")
    assert got.shape == (300, 5) and np.abs(np.cov(got.T, bias=True) - np.eye(5)).max() < 1e-9
    assert abs(sum(model.explained) - 1) < 1e-12
