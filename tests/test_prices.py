import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import prices
from tidemark.plans import price_pipeline
from tidemark.plans.price_pipeline import Paths, add_increment, ingest, run_increment, run_new_files, run_price_pipeline
from tidemark.schemas import BARS, BRONZE_PRICES
from tidemark.sources import files, tables

T0 = dt.datetime(2024, 1, 1, 0, 0)


def bronze(spark, rows):
    """rows: id, minutes, price, seconds of arrival, status"""
    full = [(i, "S", "src", None if m is None else T0 + dt.timedelta(minutes=m), T0 + dt.timedelta(seconds=s), p, "USD", "{}", st) for i, m, p, s, st in rows]
    return spark.createDataFrame(full, BRONZE_PRICES)


def bars(spark, closes, minutes=None):
    rows = []
    for i, c in enumerate(closes):
        at = T0 + dt.timedelta(minutes=(minutes or range(len(closes)))[i])
        rows.append(("S", "src", "USD", at, at + dt.timedelta(minutes=1), at.date(), c, c, c, c, c, 1))
    return spark.createDataFrame(rows, BARS)


def test_flags(spark):
    rows = bronze(spark, [("a", None, 1.0, 0, "OK"), ("b", 1, None, 0, "OK"), ("c", 1, 0.0, 0, "OK"), ("d", 1, math.nan, 0, "OK"), ("e", 1, 1.0, 0, "ERROR"), ("f", None, None, 0, "OK")])
    flags = {r.event_id: r.quality_flag for r in prices.with_quality_flag(rows).collect()}
    assert flags == {"a": "NULL_EVENT_TS", "b": "NULL_PRICE", "c": "NEGATIVE_PRICE", "d": "OK", "f": "NULL_EVENT_TS"}


@pytest.mark.parametrize("order", [1, -1])
def test_earliest_arrival_wins_and_ties_are_settled(spark, order):
    rows = [("a", 1, 5.0, 9, "OK"), ("a", 1, 7.0, 3, "OK"), ("b", 2, 8.0, 3, "OK"), ("b", 2, 6.0, 3, "OK")][::order]
    got = {r.event_id: r.price_usd for r in prices.clean_ticks(bronze(spark, rows)).collect()}
    assert got == {"a": 7.0, "b": 6.0}


def test_returns_and_frames(spark):
    got = prices.price_metrics(bars(spark, [1.0, 2.0, 0.0, 3.0, 4.0], [0, 1, 2, 30, 31])).orderBy("metric_ts").collect()
    assert [r.return_1m for r in got] == [None, 1.0, -1.0, None, pytest.approx(1 / 3)]  # after a close of 0 there is none; gaps don't matter
    assert got[0].ma_60 == 1.0 and got[1].volatility_15 is None and got[2].volatility_15 is not None


def test_constant_prices_are_no_anomaly(spark):
    got = prices.price_metrics(bars(spark, [2.0] * 70)).collect()
    assert all(r.zscore_60 is None and r.is_anomaly is False for r in got)


def test_no_anomaly_before_the_eleventh_bar(spark):
    for n, possible in ((10, False), (11, True)):
        last = prices.price_metrics(bars(spark, [1.0] * (n - 1) + [1000.0])).orderBy(F.desc("metric_ts")).first()
        assert last.is_anomaly is possible and abs(last.zscore_60) <= (n - 1) / math.sqrt(n) + 1e-9


def test_metrics_since_equals_full(spark):
    closes = [float(10 + (i * 37) % 11) for i in range(150)]
    table = bars(spark, closes)
    changed = table.filter("bar_start_ts = TIMESTAMP '2024-01-01 01:40:00'")
    part = prices.metrics_since(table, changed)
    full = prices.price_metrics(table).filter("metric_ts >= TIMESTAMP '2024-01-01 01:40:00'")
    near = lambda df: [[round(v, 9) if isinstance(v, float) else v for v in r] for r in df.orderBy("metric_ts").collect()]
    assert near(part) == near(full) and part.count() == 50


def test_metrics_since_over_days(spark):
    """Days of few bars, so that the 60 bars before a day lie in several; another series has no change."""
    table = bars(spark, [float(10 + (i * 37) % 11) for i in range(200)], [60 * i for i in range(200)])
    table = table.unionByName(table.withColumn("symbol", F.lit("other")))
    assert table.select("trade_date").distinct().count() > 5
    since = "TIMESTAMP '2024-01-06 05:00:00'"
    part = prices.metrics_since(table, table.filter(f"bar_start_ts >= {since} and symbol <> 'other'"))
    full = prices.price_metrics(table).filter(f"metric_ts >= {since} and symbol <> 'other'")
    near = lambda df: [[round(v, 9) if isinstance(v, float) else v for v in r] for r in df.orderBy("metric_ts").collect()]
    assert near(part) == near(full) and part.count() > 60 and part.columns == full.columns


def test_quotes(spark):
    rows = [('{"updatedAt":"2024-01-01T00:00:00Z","price":10.5}',), ('{"price":10.5, "updatedAt":"2024-01-01T00:00:00Z"}',), ("[1]",), (None,), ("{bad",), ('{"symbol":"","price":"x"}',)]
    got = prices.normalize_quotes(spark.createDataFrame(rows, "payload string").withColumn("ingestion_ts", F.current_timestamp()), "s", "p").collect()
    assert got[0].event_id == got[1].event_id and got[0].symbol == "XAU" and got[0].price_usd == 10.5 and got[0].source_event_ts == T0
    assert [r.api_status for r in got] == ["OK", "OK", "ERROR", "ERROR", "ERROR", "OK"] and got[5].price_usd is None
    assert got[0].payload_json == '{"provider":"p","raw_payload":{"price":10.5,"updatedAt":"2024-01-01T00:00:00Z"}}'


def test_pipeline_is_idempotent_and_late_ticks_count(spark, folder):
    paths = Paths.under(folder)
    first = [(f"e{m}", m, 10.0 + m % 7, m * 60, "OK") for m in range(0, 90)]
    run_price_pipeline(spark, bronze(spark, first), paths)
    before = sorted(map(tuple, tables.read(spark, paths.metrics).collect()), key=str)
    run_price_pipeline(spark, bronze(spark, first), paths)
    assert sorted(map(tuple, tables.read(spark, paths.metrics).collect()), key=str) == before
    run_price_pipeline(spark, bronze(spark, [("late", 20, 99.0, 99999, "OK"), ("e5", 5, 1.0, 99999, "OK")]), paths)
    assert tables.read(spark, paths.bars).count() == 90
    assert tables.read(spark, paths.bars).filter("high_price = 99").first().tick_count == 2
    assert tables.read(spark, paths.silver).filter("event_id = 'e5'").first().price_usd == 15.0  # the first write stays


def test_pipeline_since_a_day(spark, folder):
    rows = [(f"e{m}", m, 10.0 + m % 7, m * 60, "OK") for m in range(0, 5000, 7)]
    both = [Paths.under(f"{folder}/{n}") for n in "ab"]
    for paths in both:
        run_price_pipeline(spark, bronze(spark, rows[:-20]), paths)
    run_price_pipeline(spark, bronze(spark, rows[-20:]), both[0])
    run_price_pipeline(spark, bronze(spark, rows[-20:]), both[1], since="2024-01-04")
    full, part = (sorted((r.metric_ts, round(r.ma_60, 9), r.tick) for r in tables.read(spark, p.metrics).selectExpr("metric_ts", "ma_60", "round(volatility_60, 9) tick").collect()) for p in both)
    assert full == part and len(full) == len(rows)


def test_empty_pipeline(spark, folder):
    assert run_price_pipeline(spark, bronze(spark, []), Paths.under(folder)).count() == 0


def many_ticks(spark, n=400):
    """Ticks of a few bars, equal times and prices among them, in no order."""
    rng = random.Random(8)
    return [(f"e{i}", rng.choice([0, 0, 1, 1, 2, 700, 1500]) + rng.choice([0, 0.25, 0.5]), rng.choice([1.0, 2.5, 3.0]), rng.randrange(9), "OK") for i in range(n)]


def as_rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_states_add_up_in_any_grouping(spark):
    ticks = prices.clean_ticks(bronze(spark, many_ticks(spark)))
    want = as_rows(prices.ohlc_bars(ticks))
    part = [prices.bar_states(ticks.filter(F.abs(F.hash("event_id")) % 3 == i)) for i in range(3)]
    one = prices.merge_states(prices.merge_states(part[0], part[1]), part[2])
    other = prices.merge_states(part[2], prices.merge_states(part[1], part[0].limit(0), part[0]))
    assert as_rows(prices.bars_of_states(one)) == as_rows(prices.bars_of_states(other)) == want


def test_increments_give_the_bars_of_a_full_run(spark, folder, monkeypatch):
    """Late, repeated, retried and empty increments; a crash between the states and silver; silver is not read for bars."""
    rows, paths = many_ticks(spark), Paths.under(folder)
    parts = [rows[0::3], rows[1::3], rows[0:60:3], [], rows[2::3]]
    want = as_rows(prices.ohlc_bars(prices.clean_ticks(bronze(spark, rows))))
    append = tables.append

    def dies(df, path, *how):
        if path == paths.silver:
            raise RuntimeError("killed")
        append(df, path, *how)

    for n, part in enumerate(parts):
        if n == 1:
            monkeypatch.setattr(tables, "append", dies)
            with pytest.raises(RuntimeError):
                add_increment(spark, bronze(spark, part), paths, n)
            monkeypatch.setattr(tables, "append", append)
        for _ in range(1 + (n == 0)):
            days = add_increment(spark, bronze(spark, part), paths, n)
        assert (days == []) == (n in (2, 3))
    assert as_rows(tables.read(spark, paths.bars).select(*BARS.fieldNames())) == want
    assert tables.read(spark, paths.silver).count() == len(rows)
    merged = prices.bars_of_states(prices.merge_states(tables.read(spark, paths.states)))
    assert as_rows(merged) == want and all("/bar_states/" in f for f in merged.inputFiles())


def test_increments_carry_on_to_metrics(spark, folder):
    rows, paths = many_ticks(spark, 200), Paths.under(folder)
    for n, part in enumerate((rows[0::2], rows[1::2])):
        out = run_increment(spark, bronze(spark, part), paths, n)
    assert as_rows(out) == as_rows(prices.price_metrics(prices.ohlc_bars(prices.clean_ticks(bronze(spark, rows)))))


def test_new_files_are_found_and_read_once(spark, folder, monkeypatch):
    """A first run, one with nothing new, one that dies half way through its append and is taken up again beside newer files, a late file."""
    rows, paths = many_ticks(spark, 240), Paths.under(folder)
    assert run_new_files(spark, paths).count() == 0
    days = []
    add = price_pipeline.add_increment
    monkeypatch.setattr(price_pipeline, "add_increment", lambda *a: days.append(add(*a)) or days[-1])
    ingest(bronze(spark, rows[0::4]), paths.bronze)
    run_new_files(spark, paths)
    assert files.unread(spark, paths.bronze, f"{paths.bronze}.files").count() == 0
    monkeypatch.setattr(price_pipeline, "run_increment", None)  # nothing is read
    run_new_files(spark, paths)
    monkeypatch.setattr(price_pipeline, "run_increment", run_increment)

    append = tables.append

    def dies(df, path, *how):
        append(df.filter("hash(event_id) % 2 = 0") if path == paths.silver else df, path, *how)
        if path == paths.silver:
            raise RuntimeError("killed")

    ingest(bronze(spark, rows[1::4]), paths.bronze)
    monkeypatch.setattr(tables, "append", dies)
    with pytest.raises(RuntimeError):
        run_new_files(spark, paths)
    monkeypatch.setattr(tables, "append", append)
    ingest(bronze(spark, rows[2::4]), paths.bronze)
    run_new_files(spark, paths)
    late = [(i, None if m is None else m - 5 * 1440, p, s, st) for i, m, p, s, st in rows[3::4]]
    ingest(bronze(spark, late), paths.bronze)
    out = run_new_files(spark, paths)
    assert len(days) == 4 and {str(d) for d in days[-1]} == {"2023-12-27", "2023-12-28"}
    whole = prices.clean_ticks(bronze(spark, [r for k in range(3) for r in rows[k::4]] + late))
    assert as_rows(tables.read(spark, paths.bars).select(*BARS.fieldNames())) == as_rows(prices.ohlc_bars(whole))
    assert as_rows(out) == as_rows(prices.price_metrics(prices.ohlc_bars(whole)))
    assert tables.read(spark, paths.silver).count() == len(rows)
