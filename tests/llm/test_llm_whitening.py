"""Whitening against a full eigendecomposition."""

import numpy as np
import pytest

from dialogue_engine.llm import whitening
from dialogue_engine.scratch import written

SCHEMA = "vec_id long, embedding array<float>, label int, `x` string, `Deviation` int, `a.b` int"


def table(spark, vectors, kind="float"):
    rows = [(i, v, 1, "x", 2, 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA.replace("float", kind))


def check(got, vectors, components=8):
    """Rows of the operator against numpy, up to the sign of each component."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)) + 100_000
    n = len(x)
    centred = x - x.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(components, (values > 1e-13 * values.sum()).sum())
    assert sorted({r.component for r in got}) == list(range(1, count + 1))
    assert len(got) == n * count and {r.n for r in got} == {n}
    points = np.zeros((n, count))
    for r in got:
        points[r.vec_id, r.component - 1] = r.whitened
    wanted = centred @ axes[:, :count] / np.sqrt(values[:count])
    assert np.abs(points * np.sign((points * wanted).sum(0)) - wanted).max() < 1e-8
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(0))) for row in x]
    assert all(int(r.deviation) == exact[r.vec_id] for r in got)
    for r in got[: 3 * count]:
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    (error,) = {r.identity_error for r in got}
    covariance = (points - points.mean(0)).T @ (points - points.mean(0)) / n
    assert error < 1e-9 and abs(np.abs(covariance - np.eye(count)).max() - error) < 1e-12


@pytest.mark.parametrize("d, n", [(3, 40), (64, 300), (100, 150)])
def test_against_numpy(spark, d, n):
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((n, d)) * (0.1 + rng.random(d))).astype(np.float32).tolist()
    check(whitening.whitened_embeddings(table(spark, vectors)).collect(), vectors)


def test_one_vector_in_a_third_of_all_rows(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((60, 70)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 30
    check(whitening.whitened_embeddings(table(spark, vectors).repartition(7)).collect(), vectors)


def test_filter_certifies_a_flat_spectrum(spark):
    """No gap helps here, and the block is a small part of the space."""
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((500, 90)).astype(np.float32).tolist()
    rows = written(whitening.usable(table(spark, vectors)))
    found = whitening.fit(rows, components=3, guard=5)
    assert found.residual <= 1e-12 and found.passes > 8
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float))
    exact = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1][:3]
    assert np.abs(found.values / exact - 1).max() < 1e-12


def test_equal_eigenvalues(spark):
    vectors = [[(1.0 if j == i % 12 else 0.0) * (1 if i < 12 else -1) for j in range(12)] for i in range(24)]
    got = whitening.whitened_embeddings(table(spark, vectors)).collect()
    assert {r.component for r in got} == set(range(1, 9))
    assert all(abs(r.explained - 1 / 12) < 1e-12 for r in got) and got[0].identity_error < 1e-10


def test_dropped_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [2.5, -1.0], [0.25, 0.5], [1.0, 2.0]]
    bad = [None, [], [None, 1.0], [nan, 1.0], [1.0, inf], [-inf, 0.0], [1e30, 1.0], [1.0, 2.0, 3.0]]
    got = whitening.whitened_embeddings(table(spark, good + bad)).collect()
    check(got, good)


def test_nothing_to_whiten(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5):
        got = whitening.whitened_embeddings(table(spark, vectors))
        assert got.collect() == []
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_components_than_asked(spark):
    line = [[float(i), 2.0 * i, 0.0] for i in range(6)]
    check(whitening.whitened_embeddings(table(spark, line)).collect(), line)


def test_deviation_beyond_a_long(spark):
    vectors = [[float(2**39) * i, 1.0 * i] for i in range(6)]
    got = whitening.whitened_embeddings(table(spark, vectors, "double")).collect()
    x = [[int(c * 1024) + 100_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((6 * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert exact[0] > 2**63 and all(int(r.deviation) == exact[r.vec_id] for r in got)


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (1, [2.0, 5.0]), (1, [3.0, 1.0])], "vec_id long, embedding array<float>")
    got = whitening.whitened_embeddings(df, components=2).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == [("1", 1), ("1", 1), ("1", 2), ("1", 2), ("None", 1), ("None", 2)]
