"""Data-quality aggregates of each layer: one pass over the table for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What counts as wrong (or is only counted) in each layer: name and condition.
BRONZE = {
    "null_event_id": "event_id is null", "ok_rows": "api_status = 'OK'", "ok_with_null_source_event_ts": "api_status = 'OK' and source_event_ts is null",
    "ok_with_null_price": "api_status = 'OK' and price_usd is null",
}
SILVER = {
    "null_event_ts_utc": "event_ts_utc is null", "null_price_usd": "price_usd is null", "non_positive_price": "price_usd <= 0",
    "non_ok_quality_flag": "quality_flag <> 'OK'",
}
BARS = {
    "null_open": "open_price is null", "null_high": "high_price is null", "null_low": "low_price is null", "null_close": "close_price is null",
    "non_positive_tick_count": "tick_count <= 0", "high_lt_low": "high_price < low_price", "open_gt_high": "open_price > high_price",
    "open_lt_low": "open_price < low_price", "close_gt_high": "close_price > high_price", "close_lt_low": "close_price < low_price",
}
METRICS = {
    "null_metric_ts": "metric_ts is null", "null_price_usd": "price_usd is null", "null_return_1m": "return_1m is null", "null_ma_5": "ma_5 is null",
    "null_ma_15": "ma_15 is null", "null_ma_60": "ma_60 is null", "anomaly_count": "is_anomaly",
}


def check(df: DataFrame, checks: dict[str, str], key: str | None = None) -> DataFrame:
    """One row: the rows, the distinct keys if a key is given, and for each check how many rows meet it (null for no rows at all)."""
    distinct = [F.count_distinct(key).alias(f"distinct_{key}")] if key else []
    return df.agg(F.count("*").alias("row_count"), *distinct, *[F.sum(F.when(F.expr(c), 1).otherwise(0)).alias(n) for n, c in checks.items()])


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows less distinct keys; null keys count as rows only."""
    return df.agg((F.count("*") - F.count_distinct(key)).alias("duplicate_count"))


def summary(bronze: DataFrame, silver: DataFrame, bars: DataFrame, metrics: DataFrame) -> DataFrame:
    """(metric, value): the rows of four layers, and the duplicate ids of the first two; one aggregation for each layer."""
    out = None
    for name, df, dated in (("bronze", bronze, True), ("silver", silver, True), ("bar", bars, False), ("metric", metrics, False)):
        duplicates = [(F.count("*") - F.count_distinct("event_id")).alias(f"{name}_duplicates")] if dated else []
        row = df.agg(F.count("*").alias(f"{name}_rows"), *duplicates)
        part = row.unpivot([], row.columns, "metric", "value")
        out = part if out is None else out.unionByName(part)
    return out


def latest(df: DataFrame, ts: str, ties: list[str], n: int = 20) -> DataFrame:
    """The latest n rows; ties are settled by further columns."""
    return df.orderBy(F.desc(ts), *ties).limit(n)
