"""The price chain: quotes or bronze rows to silver ticks, bars and metrics, each step from table to table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.prices import (
    BAR_KEY, METRIC_KEY, bar_states, bars_of_states, clean_ticks, merge_states, metrics_since, ohlc_bars, price_metrics_sliced, with_calendar,
)
from tidemark.schemas import BAR_STATES, BARS, BRONZE_PRICES, METRICS, SILVER_TICKS
from tidemark.sources import files, tables


@dataclass
class Paths:
    bronze: str
    silver: str
    bars: str
    metrics: str
    states: str = ""

    @classmethod
    def under(cls, root: str) -> Paths:
        return cls(*(f"{root}/{name}" for name in ("bronze", "silver", "bars", "metrics", "bar_states")))


def ingest(bronze: DataFrame, path: str, fmt: str = "parquet") -> None:
    tables.append(with_calendar(bronze), path, ["ingest_year", "ingest_month", "ingest_day", "ingest_hour"], fmt)


def to_silver(spark: SparkSession, paths: Paths, since: str | None = None, fmt: str = "parquet") -> None:
    """since: only bronze rows that arrived from that day on are read; the partitions before are passed over.

    A tick is kept as it first came, so an id that was there before stays as it is. Of the silver table only the days are read that may hold
    one of the new ids, as filters beside it tell.
    """
    bronze = tables.read_or_empty(spark, paths.bronze, BRONZE_PRICES, fmt)
    if since and "ingest_year" in bronze.columns:
        day = [F.lit(int(x)) for x in since.split("-")]
        bronze = bronze.filter(F.struct("ingest_year", "ingest_month", "ingest_day") >= F.struct(*day))
    ticks = clean_ticks(bronze).select(*SILVER_TICKS.fieldNames())
    tables.merge_insert_only(spark, paths.silver, ticks, ["event_id"], ["processing_date"], fmt, filters=fmt != "delta")


def to_bars(spark: SparkSession, paths: Paths, width: str = "1 minute", since: str | None = None, fmt: str = "parquet") -> None:
    """since: only days from then on are read and written; the partitions before are not touched."""
    ticks = tables.read_or_empty(spark, paths.silver, SILVER_TICKS, fmt)
    if since:
        ticks = ticks.filter(F.col("processing_date") >= F.lit(since).cast("date"))
    tables.merge_upsert(spark, paths.bars, ohlc_bars(ticks, width), BAR_KEY, "trade_date", fmt)


def to_metrics(spark: SparkSession, paths: Paths, since: str | None = None, fmt: str = "parquet") -> None:
    """since: only what bars from that day on can have changed. The table is partitioned by day; other days are not rewritten."""
    bars = tables.read_or_empty(spark, paths.bars, BARS, fmt)
    if since:
        rows = metrics_since(bars, bars.filter(F.col("trade_date") >= F.lit(since).cast("date")))
    else:
        # by days of a series, as one series may be too long for a task
        rows = price_metrics_sliced(bars)
    rows = rows.withColumn("metric_date", F.to_date("metric_ts"))
    tables.merge_upsert(spark, paths.metrics, rows, METRIC_KEY, "metric_date", fmt)


def add_increment(spark: SparkSession, bronze: DataFrame, paths: Paths, number: int, width: str = "1 minute") -> list:
    """Bring silver and bars up to date with the bronze rows of one numbered increment; returns the days it touched.

    What the new ticks add to each bar is stored under the increment's number before they go to silver, so that neither an increment that comes
    again nor one that is tried again after a crash counts twice. Bars of touched days are then added up from their states, of which there
    is one for each bar and increment: silver is not read again, and ticks may come late by any time.
    """
    ticks = clean_ticks(bronze).select(*SILVER_TICKS.fieldNames())

    def store(fresh: DataFrame) -> None:
        new = bar_states(fresh, width).withColumn("increment", F.lit(number).cast("long"))
        total = lambda states: states.agg(F.sum("ticks")).first()[0] or 0
        had = tables.read_or_empty(spark, paths.states, BAR_STATES).filter(F.col("increment") == number)
        # an attempt that died while it appended to silver has stored all of its states before: what is new now is a part of them
        if total(had) < total(new):
            tables.overwrite(new, paths.states, ["trade_date", "increment"], partitions_only=True)

    tables.merge_insert_only(spark, paths.silver, ticks, ["event_id"], ["processing_date"], filters=True, first=store)
    states = tables.read_or_empty(spark, paths.states, BAR_STATES)
    # a row for each day that the increment has bars of
    days = [r[0] for r in states.filter(F.col("increment") == number).select("trade_date").distinct().collect()]
    if days:
        merged = merge_states(states.filter(F.col("trade_date").isin(days)))
        tables.merge_upsert(spark, paths.bars, bars_of_states(merged, width), BAR_KEY, "trade_date")
    return sorted(days)


def run_increment(spark: SparkSession, bronze: DataFrame, paths: Paths, number: int, width: str = "1 minute") -> DataFrame:
    """One increment through silver, bars and metrics. Its days are found by itself; metrics follow from the first of them on."""
    days = add_increment(spark, bronze, paths, number, width)
    if days:
        to_metrics(spark, paths, since=str(days[0]))
    return tables.read_or_empty(spark, paths.metrics, METRICS).select(*METRICS.fieldNames())


def run_new_files(spark: SparkSession, paths: Paths, width: str = "1 minute") -> DataFrame:
    """Bring all tables up to date with the bronze files that no run has read yet; which those are is found by itself.

    A ledger beside the bronze table says which files make up which increment. It is written before an increment is worked on, and a run
    finishes what an earlier one has begun, with the same files, before it begins anything. Without new files no table is read.
    """
    ledger = f"{paths.bronze.rstrip('/')}.files"
    while (found := files.next_increment(spark, paths.bronze, ledger)) is not None:
        number, names = found
        rows = spark.read.schema(BRONZE_PRICES).option("basePath", paths.bronze).parquet(*names)
        run_increment(spark, rows, paths, number, width)
        files.finish(spark, ledger, number)
    return tables.read_or_empty(spark, paths.metrics, METRICS).select(*METRICS.fieldNames())


def run_price_pipeline(spark: SparkSession, bronze: DataFrame | None, paths: Paths, width: str = "1 minute", since: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Append bronze rows, if any, and bring the three tables behind them up to date. Running it again changes nothing.

    since: the first day on which new rows have arrived and that they touch, if it is known; older bronze rows and bars are then left alone.
    """
    if bronze is not None:
        ingest(bronze, paths.bronze, fmt)
    to_silver(spark, paths, since, fmt)
    to_bars(spark, paths, width, since, fmt)
    to_metrics(spark, paths, since, fmt)
    return tables.read_or_empty(spark, paths.metrics, METRICS, fmt).select(*METRICS.fieldNames())
