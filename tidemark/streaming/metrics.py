"""Rolling price metrics as a stream: each series keeps its last bars, and a bar gives its own metrics and, if it comes late, those after it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.prices import LOOKBACK, METRIC_KEY, SERIES
from tidemark.schemas import METRICS
from tidemark.sources import tables

#: Keeps state in RocksDB, which stateful processors need.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

#: Bars that may lie after a late one without its being lost, beyond the LOOKBACK bars whose metrics it changes.
LATE = 60


def _windows(values: np.ndarray, size: int) -> np.ndarray:
    """For each value a row with it and the size - 1 before it; NaN where there is none."""
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(size - 1, np.nan), values]), size)


def _mean(values: np.ndarray, size: int) -> np.ndarray:
    w = _windows(values, size)
    return np.nansum(w, axis=1) / (~np.isnan(w)).sum(axis=1)


def _deviation(values: np.ndarray, size: int) -> np.ndarray:
    """The sample deviation of each window, NaN for fewer than two values."""
    w = _windows(values, size)
    n = (~np.isnan(w)).sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        centred = w - (np.nansum(w, axis=1) / n)[:, None]
        return np.where(n > 1, np.sqrt(np.nansum(centred**2, axis=1) / (n - 1)), np.nan)


def _change(price: np.ndarray, back: int) -> np.ndarray:
    """(now - before) / before; NaN if there is nothing before, or zero."""
    before = np.concatenate([np.full(min(back, len(price)), np.nan), price[:-back]])
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(before == 0, np.nan, (price - before) / before)


def metrics_of(price: np.ndarray, z_threshold: float = 3.0) -> pd.DataFrame:
    """The metrics of one series' prices in order, as price_metrics defines them."""
    change, spread, mean = _change(price, 1), _deviation(price, 60), _mean(price, 60)
    with np.errstate(invalid="ignore", divide="ignore"):
        z = np.where(spread == 0, np.nan, (price - mean) / spread)
    return pd.DataFrame({
        "price_usd": price, "return_1m": change, "return_5m": _change(price, 5), "ma_5": _mean(price, 5), "ma_15": _mean(price, 15), "ma_60": mean,
        "volatility_15": _deviation(change, 15), "volatility_60": _deviation(change, 60), "zscore_60": z, "is_anomaly": np.abs(np.nan_to_num(z)) >= z_threshold,
    })


class RollingMetrics(StatefulProcessor):
    """State of a series: its last bars, 2 * LOOKBACK + LATE + 1 at most, and whether older ones have been let go.

    A bar that comes late, or again with another price, gives the metrics of up to LOOKBACK bars after it once more. One that is older than
    what is kept is left out, as its metrics could not be told. A series without bars for `idle` is forgotten, by a timer in event time.
    """

    def __init__(self, z_threshold: float = 3.0, late: int = LATE, idle: dt.timedelta = dt.timedelta(days=7)):
        self.z_threshold, self.keep, self.idle = z_threshold, 2 * LOOKBACK + late + 1, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bars", "at array<long>, price array<double>, cut boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.state.get() if self.state.exists() else ([], [], False)
        old, cut = dict(zip(held[0], held[1])), held[2]
        given = pd.concat(list(rows)).sort_values("bar_start_ts", kind="stable")
        times = given["bar_start_ts"].to_numpy("datetime64[us]").astype(np.int64).tolist()
        new = dict(zip(times, given["close_price"].astype(float).tolist()))
        if cut:
            new = {t: p for t, p in new.items() if t >= held[0][0]}
        bars = old | new
        at = np.array(sorted(bars), np.int64)
        price = np.array([bars[t] for t in at.tolist()])
        changed = np.searchsorted(at, sorted(t for t, p in new.items() if old.get(t) != p))
        touched = np.zeros(len(at) + 1, np.int64)
        np.add.at(touched, changed, 1)
        np.add.at(touched, np.minimum(changed + LOOKBACK + 1, len(at)), -1)
        give = np.flatnonzero(np.cumsum(touched[:-1]) > 0)
        give = give[give >= LOOKBACK] if cut else give
        if len(at):
            cut = cut or len(at) > self.keep
            self.state.update((at[-self.keep :].tolist(), price[-self.keep :].tolist(), bool(cut)))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(at[-1]) // 1000 + int(self.idle.total_seconds() * 1000))
        if len(give):
            out = metrics_of(price, self.z_threshold).iloc[give]
            for i, name in enumerate(SERIES):
                out.insert(i, name, key[i])
            out.insert(len(SERIES), "metric_ts", pd.to_datetime(at[give], unit="us"))
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_metrics(bars: DataFrame, late_by: str = "1 day", z_threshold: float = 3.0, late: int = LATE, idle: dt.timedelta = dt.timedelta(days=7)) -> DataFrame:
    """A stream of METRICS rows from a stream of bars; of rows with one key the last counts.

    Equal to price_metrics once all bars have come, if none is later than late_by or than `late` bars. A series is one task's, as its bars are
    ordered; what the task holds of it is bounded.
    """
    rows = bars.select(*SERIES, "bar_start_ts", "close_price").filter("bar_start_ts is not null and close_price is not null").withWatermark("bar_start_ts", late_by)
    processor = RollingMetrics(z_threshold, late, idle)
    return rows.groupBy(*SERIES).transformWithStateInPandas(processor, outputStructType=METRICS, outputMode="Append", timeMode="EventTime")


def start_metrics(spark: SparkSession, bars: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str = "metrics", **how) -> StreamingQuery:
    """Keep a table of metrics up to date with a stream of bars: each batch is merged into the days it touches, so one that comes again changes nothing."""
    for key, value in STORE.items():
        spark.conf.set(key, value)

    def work(batch: DataFrame, batch_id: int) -> None:
        tables.merge_upsert(batch.sparkSession, path, batch.selectExpr("*", "to_date(metric_ts) as metric_date"), METRIC_KEY, "metric_date")

    writer = stream_metrics(bars, **how).writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(work)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
