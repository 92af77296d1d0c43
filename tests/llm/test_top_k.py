import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import rows, twin
from tidemark.llm import top_k as t
from tidemark.llm.registry import QUERIES, SQL


def brute(vectors, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(v, w)), i) for i, w in vectors if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.integers(1, 6), st.integers(1, 7), st.integers(0, 2**32), st.integers(1, 4))
def test_aggregation_keeps_the_best(n, dims, k, seed, spread):
    rng = np.random.default_rng(seed)
    vectors, queries = rng.integers(-spread, spread + 1, (n, dims)), rng.integers(-spread, spread + 1, (5, dims))
    for q, left in zip(queries, t.aggregate(queries, t.Lists(vectors), k)[0]):
        scores = vectors @ q
        bar = np.sort(scores)[-min(k, n)]
        assert set(np.flatnonzero(scores >= bar)) <= set(left.tolist())


def test_reading_stops_early():
    rng = np.random.default_rng(0)
    vectors = rng.integers(0, 50, (2000, 2))
    left, read = t.aggregate(rng.integers(1, 9, (10, 2)), t.Lists(vectors), 3)
    assert all(len(x) < 200 for x in left) and read < 10 * 2 * 2000 / 2


@pytest.mark.parametrize("n", [1000, 8000])
def test_entries_read_on_skewed_vectors(n):
    """A few large components decide: the lists are read to a small part, whatever their length."""
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.pareto(1.2, (n, 8)) * 10).astype(np.int64)
    queries = rng.integers(1, 20, (16, 8))
    left, read = t.aggregate(queries, t.Lists(vectors), 5)
    for q, x in zip(queries, left):
        scores = vectors @ q
        assert set(np.flatnonzero(scores >= np.sort(scores)[-5])) <= set(x.tolist())
    assert read <= 0.1 * 16 * 8 * n


def test_large_components_are_exact_or_an_error():
    vectors = np.array([[1 << 40, 1], [1 << 40, 2], [3, 4]])
    assert t.aggregate(np.array([[1 << 20, 1]]), t.Lists(vectors), 1)[0][0].tolist() == [0, 1, 2]
    with pytest.raises(OverflowError):
        t.aggregate(np.array([[1 << 40, 1]]), t.Lists(vectors), 1)


def test_components_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, [1e30]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit"):
        t.top_k(df, df).collect()


def test_extra_columns_and_several_lots(spark, monkeypatch):
    monkeypatch.setattr(t, "LOT", 3)
    monkeypatch.setattr(t, "SHARD", 6)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3)], "id", 1, 2, "v", 7, 0) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, shard int, lot int, v string, size int, role int")
    got = sorted(tuple(r) for r in t.top_k(df, df, 4).collect())
    whole = [(r[0], [math.floor(256 * x) for x in r[1]]) for r in rows]
    assert got == brute(whole, whole, 4)


@pytest.mark.parametrize(("shard", "block"), [(8192, 128), (7, 3)])
def test_against_all_pairs(spark, shard, block, monkeypatch):
    monkeypatch.setattr(t, "SHARD", shard)
    monkeypatch.setattr(t, "BLOCK", block)
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(80)] + [(i, [0.5, 0.5, 0.25, 1.0]) for i in range(80, 110)]
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [math.nan, 0.0, 0.0, 0.0]), (203, [math.inf, 0.0, 0.0, 0.0]), (204, []), (None, [1.0] * 4), (205, [9.0]), (210, [8.0])]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in t.top_k(df, df.filter(F.col("vec_id") % 5 == 0), 5).collect())
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in [*vectors, (205, [9.0]), (210, [8.0])]]
    assert got == brute(whole, [x for x in whole if x[0] % 5 == 0], 5)
    assert t.top_k(df.limit(0), df.limit(0)).count() == 0


def test_ids_that_repeat(spark):
    df = spark.createDataFrame([(1, [1.0]), (1, [1.0]), (2, [1.0]), (3, [2.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in t.top_k(df, df.filter("vec_id = 2"), 5).collect())
    assert [(r[1], r[2]) for r in got] == [(1, 3), (2, 1), (3, 1)]


def test_query_is_that_of_sql(spark, sf):
    assert rows(QUERIES["op8_top_k"](spark, sf).toPandas()) == rows(twin(SQL["op8_top_k"], sf))
