"""Streams from the event log to bronze, and from bronze to silver and quarantine."""

from __future__ import annotations

import contextlib
from collections import deque
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tidemark.operators.events import decode_records, invalid_events, parse_events, to_bronze, valid_events
from tidemark.schemas import AUDIT, BRONZE_EVENTS, LOG_RECORD, PROGRESS, SILVER_EVENTS
from tidemark.sources import compaction, key_filters, tables


def kafka_options(place: str, topic: str, starting: str = "latest") -> dict[str, str]:
    """Spark's options for reading a topic: fixed names."""
    return {"kafka.bootstrap.servers": place, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "false"}


def log_source(spark: SparkSession, place: str, topic: str | None = None, starting: str = "latest", fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of log records. With a topic, place names Kafka brokers (its jar must be there); else a folder of record files.

    Files are always read from the start, as a new checkpoint makes them.
    """
    if topic:
        return spark.readStream.format("kafka").options(**kafka_options(place, topic, starting)).load()
    return table_source(spark, place, LOG_RECORD, fmt, files_per_batch)


def table_source(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """What is appended to a table, as a stream."""
    reader = spark.readStream.format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (reader.schema(schema) if fmt != "delta" else reader).load(path)


def log_sink(df: DataFrame, place: str, topic: str | None = None) -> None:
    """Write (key, value) rows to a topic, or as files if no topic is given."""
    rows = df.select(F.col("key").cast("string"), F.col("value").cast("string"))
    if topic:
        rows.write.format("kafka").option("kafka.bootstrap.servers", place).option("topic", topic).save()
    else:
        tables.append(rows, place)


def record(spark: SparkSession, path: str, query: str, batch_id: int, rows: tuple[int, int, int], error: str | None = None) -> None:
    """One audit row for a micro-batch; a batch that is tried again replaces its row."""
    row = [(query, batch_id, *rows, "error" if error else "ok", error)]
    df = spark.createDataFrame(row, StructType(AUDIT.fields[:-1])).withColumn("ts", F.current_timestamp()).coalesce(1)
    tables.overwrite(df, path, ["query", "batch_id"], partitions_only=True)


def audited(name: str, audit: str | None, work: Callable[[DataFrame, int], tuple[int, int, int]]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the batch for as long as work needs it, and records how it went. Errors are raised again."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            rows = work(batch, batch_id)
            if audit:
                record(spark, audit, name, batch_id, rows)
        except Exception as e:
            if audit:
                record(spark, audit, name, batch_id, (0, 0, 0), str(e)[:500])
            raise
        finally:
            batch.unpersist()

    return run


def finished(spark: SparkSession, audit: str, query: str) -> int:
    """The last batch of a query that is written whole, -1 if there is none. A batch begins only once all before it are."""
    ok = tables.read_or_empty(spark, audit, AUDIT).filter((F.col("query") == query) & (F.col("status") == "ok"))
    last = ok.agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last


def visible(spark: SparkSession, path: str, schema: StructType, audit: str, query: str = "events_silver") -> DataFrame:
    """The rows of a table that whole batches have written, without batch_id: the audit table is the ledger.

    A batch writes several tables, and its audit row after them. Whoever reads all of them through here sees a batch in each or in none,
    also after a crash between two writes; the number of the last whole batch prunes the partitions. Rows that `pack_closed` has moved are there too.
    """
    rows = compaction.rows(spark, path, schema)
    return rows.filter(F.col("batch_id") <= finished(spark, audit, query)).select(*schema.fieldNames())


def pack_closed(spark: SparkSession, path: str, schema: StructType, audit: str, query: str = "events_silver", by: str | None = "event_date", before: str | None = None) -> int:
    """Pack the whole batches of the dates before a day into files of about one size (compaction.pack); `compaction.clean` deletes the small ones later."""
    return compaction.pack(spark, path, schema, finished(spark, audit, query), by, before)


def write_batch(df: DataFrame, path: str, by: list[str], batch_id: int) -> int:
    """Write a batch under its own number, and how many rows that were, as observed by the write itself.

    One that is tried again replaces what it wrote before. A batch without rows leaves no files.
    """
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("batch_id", F.lit(batch_id).cast("long"))
    tables.overwrite(rows, path, ["batch_id", *by], partitions_only=True)
    return seen.get["rows"]


def bronze_batch(path: str) -> Callable[[DataFrame, int], tuple[int, int, int]]:
    def work(batch: DataFrame, batch_id: int) -> tuple[int, int, int]:
        n = write_batch(batch, path, ["event_date"], batch_id)
        return n, n, 0

    return work


def silver_batch(silver: str, quarantine: str, dedupe: str = "batch") -> Callable[[DataFrame, int], tuple[int, int, int]]:
    """dedupe: `batch` keeps one row of an event_id in each batch; `table` also leaves out what earlier batches have written, whose ids
    are remembered beside the table. Each table is one write, which counts its rows as they pass; nothing else is run over the batch."""

    def work(batch: DataFrame, batch_id: int) -> tuple[int, int, int]:
        spark, seen = batch.sparkSession, Observation()
        good = valid_events(batch.observe(seen, F.count(F.lit(1)).alias("rows")))
        with _unseen(spark, good, silver, batch_id) if dedupe == "table" else contextlib.nullcontext(good) as fresh:
            n_good = write_batch(fresh, silver, ["event_date"], batch_id)
        n_bad = write_batch(invalid_events(batch), quarantine, [], batch_id)
        return seen.get["rows"], n_good, n_bad

    return work


@contextlib.contextmanager
def _unseen(spark: SparkSession, good: DataFrame, silver: str, batch_id: int) -> Iterator[DataFrame]:
    """The events whose ids no earlier batch has written. Only dates that may hold them are read; the ids are remembered before they are
    written, so that a crash in between leaves an id too many, which costs a look, and none too few."""
    old = compaction.rows(spark, silver, SILVER_EVENTS).filter(F.col("batch_id") < batch_id)
    with key_filters.unseen(old, good, silver, ["event_id"], "event_date") as fresh:
        key_filters.remember(good, silver, ["event_id"], "event_date", batch_id)
        yield fresh


class Progress(StreamingQueryListener):
    """Keeps what queries report of their batches: one row for each, the last `most` of them. Spark calls it; no job is run for it.

    Counts that a stream observes (DataFrame.observe with a name) come along as `observed`, {name.metric: value}.
    """

    def __init__(self, most: int = 10_000):
        self.rows: deque[tuple] = deque(maxlen=most)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        observed = {f"{name}.{metric}": int(v) for name, row in p.observedMetrics.items() for metric, v in row.asDict().items() if isinstance(v, int)}
        self.rows.append((p.name, p.batchId, p.numInputRows, p.durationMs.get("triggerExecution"), p.eventTime.get("watermark"), observed, None))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self.rows.append((None, None, None, None, None, {}, event.exception[:500]))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), PROGRESS)


def start(df: DataFrame, name: str, work: Callable[[DataFrame, int], tuple[int, int, int]], checkpoint: str, audit: str | None = None, every: str | None = None) -> StreamingQuery:
    """Run a stream through a batch function: every so often, or until all that is there has been read."""
    writer = df.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(audited(name, audit, work))
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_bronze(records: DataFrame, path: str, checkpoint: str, audit: str | None = None, every: str | None = None, name: str = "events_bronze") -> StreamingQuery:
    return start(to_bronze(decode_records(records)), name, bronze_batch(path), checkpoint, audit, every)


def start_silver(
    spark: SparkSession, bronze: str, silver: str, quarantine: str, checkpoint: str, audit: str | None = None, every: str | None = None,
    dedupe: str = "batch", files_per_batch: int | None = None, name: str = "events_silver",
) -> StreamingQuery:
    rows = table_source(spark, bronze, BRONZE_EVENTS, files_per_batch=files_per_batch)
    return start(parse_events(rows), name, silver_batch(silver, quarantine, dedupe), checkpoint, audit, every)


def preview(df: DataFrame, checkpoint: str | None = None, fmt: str = "console", name: str = "preview") -> StreamingQuery:
    """Print a stream, untruncated, until all that is there has been read."""
    writer = df.writeStream.queryName(name).outputMode("append").format(fmt).trigger(availableNow=True)
    writer = writer.option("truncate", "false") if fmt == "console" else writer
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()


def windowed_bars(ticks: DataFrame, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Bars of a stream of ticks, each given once its time is over by `late`. An extension: later ticks are left out."""
    order = F.struct("event_ts_utc", "ingestion_ts", "event_id")
    sound = ticks.filter("event_ts_utc is not null and price_usd is not null").withWatermark("event_ts_utc", late)
    bars = sound.groupBy(F.window("event_ts_utc", width), "symbol", "source_name", "currency").agg(
        F.min_by("price_usd", order).alias("open_price"), F.max("price_usd").alias("high_price"), F.min("price_usd").alias("low_price"),
        F.max_by("price_usd", order).alias("close_price"), F.avg("price_usd").alias("avg_price"), F.count(F.lit(1)).alias("tick_count"),
    )
    return bars.withColumns({"bar_start_ts": F.col("window.start"), "bar_end_ts": F.col("window.end")}).drop("window")


def deduplicated(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """One row of each event_id among those that arrive within `late` of each other, with bounded state. An extension."""
    return events.withWatermark("event_ts", late).dropDuplicatesWithinWatermark(["event_id"])
