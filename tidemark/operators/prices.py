"""From quotes to ticks, bars and rolling metrics. Every function takes and gives a DataFrame and runs nothing."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import content_id, filled, instant, relative_change
from tidemark.schemas import BARS, METRICS

SERIES = ["symbol", "source_name", "currency"]
BAR_KEY = [*SERIES, "bar_start_ts"]
METRIC_KEY = [*SERIES, "metric_ts"]

def normalize_quotes(payloads: DataFrame, source_name: str, provider: str, symbol: str = "XAU", currency: str = "USD") -> DataFrame:
    """Bronze rows from landed quote payloads (payload: JSON text, ingestion_ts).

    The id is a hash of source, symbol, time and the envelope, whose keys are in sorted order, so that a quote that is polled again
    unchanged has the same id. A payload that is no JSON object is kept with status ERROR.
    """
    rows = payloads.withColumn("_v", F.try_parse_json("payload"))
    rows = rows.withColumn("_v", F.when(F.schema_of_variant("_v").startswith("OBJECT"), F.col("_v")))
    sound = F.col("_v").isNotNull()
    field = lambda path, kind: F.try_variant_get("_v", f"$.{path}", kind)
    provided = F.to_json(F.struct(F.lit(provider).alias("provider")))
    envelope = F.when(sound, F.concat(F.regexp_replace(provided, r"\}$", ',"raw_payload":'), F.to_json("_v"), F.lit("}")))
    rows = rows.select(
        F.coalesce(filled(field("symbol", "string")), F.lit(symbol)).alias("symbol"),
        F.lit(source_name).alias("source_name"),
        instant(field("updatedAt", "string")).alias("source_event_ts"),
        F.col("ingestion_ts"),
        field("price", "double").alias("price_usd"),
        F.lit(currency).alias("currency"),
        F.coalesce(envelope, F.to_json(F.struct(F.lit(provider).alias("provider"), F.col("payload").alias("raw_payload")))).alias("payload_json"),
        F.when(sound, "OK").otherwise("ERROR").alias("api_status"),
        field("updatedAt", "string").alias("_at"),
    )
    event_id = content_id(F.col("source_name"), F.col("symbol"), F.col("_at"), F.col("payload_json"))
    return rows.select(event_id.alias("event_id"), *[c for c in rows.columns if c != "_at"])


def with_calendar(bronze: DataFrame, ts: str = "ingestion_ts") -> DataFrame:
    """The four calendar columns by which bronze prices are partitioned."""
    parts = {"ingest_year": F.year(ts), "ingest_month": F.month(ts), "ingest_day": F.dayofmonth(ts), "ingest_hour": F.hour(ts)}
    return bronze.withColumns(parts)


def with_quality_flag(bronze: DataFrame) -> DataFrame:
    """Ticks of rows with status OK, flagged. Zero counts as negative; NaN passes, as it is not below zero."""
    # fixed values: the flags and the columns of the silver table
    flag = (
        F.when(F.col("source_event_ts").isNull(), "NULL_EVENT_TS")
        .when(F.col("price_usd").isNull(), "NULL_PRICE")
        .when((F.col("price_usd") <= 0) & ~F.isnan("price_usd"), "NEGATIVE_PRICE")
        .otherwise("OK")
    )
    return bronze.filter(F.col("api_status") == "OK").select(
        "event_id", "symbol", "source_name", F.col("source_event_ts").alias("event_ts_utc"), "ingestion_ts", "price_usd", "currency",
        flag.alias("quality_flag"), F.to_date("source_event_ts").alias("processing_date"),
    )


def clean_ticks(bronze: DataFrame) -> DataFrame:
    """Sound ticks, the earliest row of each event_id; ties by event time, price and the other columns."""
    order = Window.partitionBy("event_id").orderBy("ingestion_ts", "event_ts_utc", "price_usd", *SERIES)
    sound = with_quality_flag(bronze).filter(F.col("quality_flag") == "OK")
    return sound.withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")


def _bucketed(ticks: DataFrame, width: str) -> DataFrame:
    """Ticks that have a time and a price, with the start of their bar."""
    unit = width.split()[-1]
    kept = ticks.select("event_id", *SERIES, "event_ts_utc", "ingestion_ts", "price_usd").filter("event_ts_utc is not null and price_usd is not null")
    start = F.date_trunc(unit, "event_ts_utc") if width.split()[0] == "1" else F.window("event_ts_utc", width)["start"]
    return kept.withColumn("bar_start_ts", start)


def _canonical(bars: DataFrame, width: str) -> DataFrame:
    bars = bars.withColumns({"bar_end_ts": F.expr(f"bar_start_ts + INTERVAL {width}"), "trade_date": F.to_date("bar_start_ts")})
    return bars.select(*BARS.fieldNames())


def ohlc_bars(ticks: DataFrame, width: str = "1 minute") -> DataFrame:
    """Open, high, low, close, mean and count for each series and bar, in one aggregation over one shuffle.

    Open is the price of the first tick by (event time, ingestion time, id), close that of the last.
    """
    order = F.struct("event_ts_utc", "ingestion_ts", "event_id")
    bars = _bucketed(ticks, width).groupBy(*BAR_KEY).agg(
        F.min_by("price_usd", order).alias("open_price"), F.max("price_usd").alias("high_price"), F.min("price_usd").alias("low_price"),
        F.max_by("price_usd", order).alias("close_price"), F.avg("price_usd").alias("avg_price"), F.count(F.lit(1)).alias("tick_count"),
    )
    return _canonical(bars, width)


def bar_states(ticks: DataFrame, width: str = "1 minute") -> DataFrame:
    """What ticks add to each bar, in a form that can be added up: (BAR_KEY, trade_date, first, last, high, low, total, ticks).

    first and last are (order, price) of the earliest and latest tick; an order is (event time, ingestion time, id).
    """
    at = F.struct(F.struct("event_ts_utc", "ingestion_ts", "event_id").alias("order"), F.col("price_usd").alias("price"))
    states = _bucketed(ticks, width).withColumn("at", at).groupBy(*BAR_KEY).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.max("price_usd").alias("high"), F.min("price_usd").alias("low"),
        F.sum("price_usd").alias("total"), F.count(F.lit(1)).alias("ticks"),
    )
    return states.withColumn("trade_date", F.to_date("bar_start_ts"))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state for each bar, of any number of them in any order and grouping: all parts but the total are exactly associative."""
    rows = functools.reduce(DataFrame.unionByName, [s.select(*BAR_KEY, "trade_date", "first", "last", "high", "low", "total", "ticks") for s in states])
    return rows.groupBy(*BAR_KEY, "trade_date").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("total").alias("total"), F.sum("ticks").alias("ticks"),
    )


def bars_of_states(states: DataFrame, width: str = "1 minute") -> DataFrame:
    """The bars that merged states stand for: those of ohlc_bars over all ticks that went into them."""
    return _canonical(states.select(
        *BAR_KEY, F.col("first.price").alias("open_price"), F.col("high").alias("high_price"), F.col("low").alias("low_price"),
        F.col("last.price").alias("close_price"), (F.col("total") / F.col("ticks")).alias("avg_price"), F.col("ticks").alias("tick_count"),
    ), width)


def ohlc_bars_join_form(ticks: DataFrame, width: str = "1 minute") -> DataFrame:
    """The same bars by two ranked windows and two joins: the long form, kept as a check on the short one."""
    rows = _bucketed(ticks, width)
    order = ["event_ts_utc", "ingestion_ts", "event_id"]

    def ranked(columns: list[Column], name: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*BAR_KEY).orderBy(*columns))
        return rows.withColumn("rn", rank).filter("rn = 1").select(*BAR_KEY, F.col("price_usd").alias(name))

    bars = rows.groupBy(*BAR_KEY).agg(
        F.max("price_usd").alias("high_price"), F.min("price_usd").alias("low_price"), F.avg("price_usd").alias("avg_price"), F.count(F.lit(1)).alias("tick_count")
    )
    bars = bars.join(ranked([F.asc(c) for c in order], "open_price"), BAR_KEY, "inner")
    return _canonical(bars.join(ranked([F.desc(c) for c in order], "close_price"), BAR_KEY, "inner"), width)


def price_metrics(bars: DataFrame, z_threshold: float = 3.0, by: tuple[str, ...] = ()) -> DataFrame:
    """Returns against 1 and 5 bars before, means of 5, 15 and 60 bars, volatility of the return, z-score and anomaly flag.

    Frames count bars, not minutes: gaps are not filled, and frames at the start of a series are as long as it is. Mean and
    deviation of the z-score include the bar itself. by: further columns that keep rows of a series apart.
    """
    series = Window.partitionBy(*SERIES, *by).orderBy("metric_ts")
    last = lambda n: series.rowsBetween(1 - n, Window.currentRow)
    price = F.col("price_usd")
    rows = bars.select(*SERIES, *by, F.col("bar_start_ts").alias("metric_ts"), F.col("close_price").alias("price_usd"))
    rows = rows.withColumns({
        "return_1m": relative_change(price, F.lag("price_usd", 1).over(series)), "return_5m": relative_change(price, F.lag("price_usd", 5).over(series)),
        "ma_5": F.avg("price_usd").over(last(5)), "ma_15": F.avg("price_usd").over(last(15)), "ma_60": F.avg("price_usd").over(last(60)),
        "_std": F.stddev_samp("price_usd").over(last(60)),
    })
    rows = rows.withColumns({"volatility_15": F.stddev_samp("return_1m").over(last(15)), "volatility_60": F.stddev_samp("return_1m").over(last(60))})
    z = F.when(F.col("_std").isNull() | (F.col("_std") == 0), None).otherwise((price - F.col("ma_60")) / F.col("_std"))
    rows = rows.withColumn("zscore_60", z).withColumn("is_anomaly", F.coalesce(F.abs("zscore_60") >= z_threshold, F.lit(False)))
    return rows.select(*METRICS.fieldNames(), *by)


#: Bars before a changed one that its metrics and those of the 60 bars after it can depend on.
LOOKBACK = 60


def metrics_since(bars: DataFrame, changed: DataFrame, z_threshold: float = 3.0) -> DataFrame:
    """The metrics that a change of bars can have altered: for each series those from its first changed bar on, computed by days.

    changed: SERIES and bar_start_ts of the bars that were written. Before the first changed day only the days are read that hold the 60 bars
    before it; a late bar shifts the metrics of up to 60 later bars, all of which are given again.
    """
    first = changed.groupBy(*SERIES).agg(F.min("bar_start_ts").alias("_from"))
    metrics = price_metrics_sliced(bars, z_threshold, first)
    return metrics.join(first, SERIES).filter("metric_ts >= _from").select(*METRICS.fieldNames())


def price_metrics_sliced(bars: DataFrame, z_threshold: float = 3.0, first: DataFrame | None = None) -> DataFrame:
    """The same rows as price_metrics, with each day of a series computed by itself: for series too long for one task.

    A day needs the 60 bars before it. As each day that is there has a bar at least, they lie in the 60 days before it that are
    there; counts of bars by day tell in which of them. Those days' bars are read once more and dropped at the end. first: SERIES and a
    time _from; only series that it has are computed, from the day of that time on.
    """
    days = bars.groupBy(*SERIES, "trade_date").agg(F.count("*").alias("_bars"))
    order = Window.partitionBy(*SERIES).orderBy("trade_date")
    days = days.withColumn("_through", F.sum("_bars").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.collect_list(F.struct("trade_date", "_through")).over(order.rowsBetween(-LOOKBACK, -1))
    days = days.withColumn("_days", F.filter(before, lambda d: d["_through"] > F.col("_through") - F.col("_bars") - LOOKBACK))
    if first is not None:
        days = days.join(first, SERIES).filter(F.col("trade_date") >= F.to_date("_from"))
    own = F.array(F.col("trade_date"))
    days = days.select(*SERIES, F.col("trade_date").alias("_slice"), F.explode(F.concat(own, F.col("_days.trade_date"))).alias("trade_date"))
    metrics = price_metrics(bars.join(days, [*SERIES, "trade_date"]), z_threshold, by=("_slice",))
    return metrics.filter(F.to_date("metric_ts") == F.col("_slice")).drop("_slice")
