"""Metrics of a stream of bars: equal to the batch form, late bars included, with bounded state."""

import datetime as dt
import random

import numpy as np
import pytest

from tidemark.operators import prices
from tidemark.schemas import BARS, METRICS
from tidemark.sources import tables
from tidemark.streaming import metrics, streams

T0 = dt.datetime(2024, 1, 1)


def bars(spark, rows):
    """rows: series, minute, close"""
    at = lambda m: T0 + dt.timedelta(minutes=m)
    return spark.createDataFrame([(s, "src", "USD", at(m), at(m + 1), at(m).date(), c, c, c, c, c, 1) for s, m, c in rows], BARS)


def as_rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*METRICS.fieldNames()).collect())


def run(spark, folder, parts, **how):
    for part in parts:
        bars(spark, part).coalesce(1).write.mode("append").parquet(f"{folder}/bars")
        query = metrics.start_metrics(spark, streams.table_source(spark, f"{folder}/bars", BARS), f"{folder}/metrics", f"{folder}/c", **how)
        query.awaitTermination(120)
        assert query.exception() is None
    return tables.read(spark, f"{folder}/metrics")


def made(n, seed):
    rng = random.Random(seed)
    return [(s, m, rng.choice([0.0, 1.5, 2.0, 7.0, 100.0])) for s in ("A", "B") for m in sorted(rng.sample(range(2 * n), n))]


@pytest.mark.parametrize("n", [1, 2, 75, 300])
def test_prices_in_order(spark, n):
    closes = [c for _, _, c in made(n, 4)][:n]
    want = [r for r in as_rows(prices.price_metrics(bars(spark, [("A", m, c) for m, c in enumerate(closes)])))]
    got = metrics.metrics_of(np.array(closes))
    for w, g in zip(sorted(want, key=lambda r: r[3]), got.itertuples(index=False), strict=True):
        assert [None if isinstance(v, float) and np.isnan(v) else round(v, 9) if isinstance(v, float) else bool(v) for v in g] == list(w[4:])


def test_batches_and_late_bars_give_the_batch_form(spark, folder):
    rows = made(220, 1)
    late = [r for r in rows if 300 < r[1] < 380 and r[1] % 3 == 0]
    rest = [r for r in rows if r not in late]
    parts = [[r for r in rest if r[1] < 150], [r for r in rest if r[1] >= 150], late]
    got = run(spark, folder, parts)
    assert late and as_rows(got) == as_rows(prices.price_metrics(bars(spark, rows)))


def test_a_price_that_changes_and_a_bar_too_old(spark, folder):
    rows = [("A", m, float(m % 7 + 1)) for m in range(400)]
    got = run(spark, folder, [rows, [("A", 350, 99.0), ("A", 399, 4.0)], [("A", -5, 3.0)]], late=0)
    want = [("A", m, {350: 99.0, 399: 4.0}.get(m, c)) for _, m, c in rows]
    assert as_rows(got) == as_rows(prices.price_metrics(bars(spark, want)))
