import math

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.runtime import materialize
from tidemark.llm.whitening import fit, identity_error, op11_whitening, quantized, square_sums, whiten


def exact(vectors):
    """n, S and V of the distinct rows, V from whole numbers."""
    xs = sorted({tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors})
    n, sums = len(xs), [sum(c) for c in zip(*xs)]
    d = [[n * c - s for c, s in zip(x, sums)] for x in xs]
    size = len(sums)
    return n, sums, np.array([[sum(r[i] * r[j] for r in d) / n**3 for j in range(size)] for i in range(size)])


def check(rows, given, components=16):
    """rows of whiten against plain sums, for {id: vector}."""
    n, sums, v = exact(given.values())
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, len(sums))
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, c + 1) for i in given for c in range(k))
    signs = {}
    for r in rows:
        x = np.array([math.floor(64 * float(c)) + 1_000_000 for c in given[r.vec_id]], object)
        d = [n * int(c) - s for c, s in zip(x, sums)]
        assert r.n == n and r.deviation == sum(c * c for c in d)
        want = float(np.dot(np.array(d, float) / n, vectors[:, r.component - 1]) / math.sqrt(values[r.component - 1]))
        if abs(want) > 1e-6:
            assert signs.setdefault(r.component, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
        assert abs(abs(r.whitened) - abs(want)) < 1e-7
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(v), rel_tol=1e-9) and r.identity_error < 1e-8


def table(spark, rows):
    """With columns that clash."""
    return spark.createDataFrame([(*r, 1, 2.0, 3) for r in rows], "vec_id long, embedding array<float>, component int, x double, n int")


def test_query(spark, sf):
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    check(op11_whitening(spark, sf).collect(), given)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(40, 5)) * [9, 4, 2, 1, 0.5]).astype(np.float32).tolist()
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [math.nan] * 5), (103, [math.inf, 1.0, 1.0, 1.0, 1.0])]
    rows = [*enumerate(vectors), *[(200 + i, vectors[0]) for i in range(60)], (None, vectors[1]), (7, vectors[7]), *bad]
    out = whiten(table(spark, rows)).collect()
    assert len(out) == (40 + 60 + 1 + 1) * 5
    once = {i: v for i, v in rows[:100] if i != 7}
    assert {r.n for r in out} == {40}  # each distinct vector once
    kept = [r for r in out if r.vec_id is not None and r.vec_id != 7]
    assert {r.vec_id for r in kept} == set(once)
    check(whiten(table(spark, list(enumerate(vectors)))).collect(), dict(enumerate(vectors)))
    by = {(r.vec_id, r.component): (r.whitened, r.deviation) for r in kept}
    assert all(by[200 + i, c] == by[0, c] for i in range(60) for c in range(1, 6))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_no_variance_no_rows(spark, rows):
    out = whiten(table(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.collect() == []


def test_directions_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    out = whiten(table(spark, rows)).collect()
    assert {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-9 and out[0].identity_error < 1e-9


def test_lengths_that_differ_are_refused(spark):
    with pytest.raises(ValueError):
        whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_squares_are_exact():
    rng = np.random.default_rng(4)
    for top in (1 << 10, 1 << 40, 1 << 45, 1 << 60):
        values = rng.integers(-top, top, size=(300, 3))
        assert square_sums(values) == [sum(int(v) ** 2 for v in c) for c in values.T]
    assert square_sums(np.zeros((0, 2), np.int64)) == [0, 0]


def test_cross_terms_come_from_squares_alone(spark, monkeypatch):
    """Entries so large that products in doubles would lose digits."""
    rng = np.random.default_rng(5)
    vectors = (rng.integers(-(1 << 30), 1 << 30, size=(50, 3)) * 1.0).tolist()
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    written = materialize(quantized(rows, "embedding").select("x").distinct())
    found = fit(written)
    n, sums, v = exact(vectors)
    assert found.n == n and found.sums.tolist() == sums and (found.covariance == v).all()
    assert identity_error(written, found) < 1e-9
    monkeypatch.setattr(whitening, "MANY", 1)
    assert (fit(written).covariance == v).all()
