import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import events
from tidemark.schemas import BRONZE_EVENTS, LOG_RECORD, QUARANTINE, SILVER_EVENTS
from tidemark.sources import tables
from tidemark.streaming import streams

AT = dt.datetime(2024, 1, 5, 10, 0)


def event(n, **change):
    e = {"event_id": f"e{n}", "event_ts": "2024-01-05T12:00:00Z", "event_type": "click", "source": "frontend", "anonymous_id": "a", "session_id": "s"} | change
    return {k: v for k, v in e.items() if v is not None}


def land(spark, path, items, first=0):
    rows = [(b"k", (x if isinstance(x, str) else json.dumps(x)).encode(), "t", 0, first + i, AT, 0) for i, x in enumerate(items)]
    spark.createDataFrame(rows, LOG_RECORD).coalesce(1).write.mode("append").parquet(path)


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def chain(spark, folder, **how):
    run(streams.start_bronze(streams.log_source(spark, f"{folder}/log", files_per_batch=1), f"{folder}/bronze", f"{folder}/c1", f"{folder}/audit"))
    run(streams.start_silver(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/bad", f"{folder}/c2", f"{folder}/audit", files_per_batch=1, **how))


def test_all_events_go_somewhere(spark, folder):
    items = [event(1), event(1, page_url="/late"), event(2, source=None), event(3, source="mobile"), event(4, event_ts="bad"), "{bad", event(5, session_id=None)]
    land(spark, f"{folder}/log", items)
    chain(spark, folder)
    silver, bad = tables.read(spark, f"{folder}/silver"), tables.read(spark, f"{folder}/bad")
    assert [(r.event_id, r.page_url) for r in silver.collect()] == [("e1", None)]
    assert bad.count() == 5 and {r.quarantine_reason for r in bad.collect()} == {events.REASON}
    bronze = tables.read(spark, f"{folder}/bronze")
    assert {str(r.event_date) for r in bronze.collect()} == {"2024-01-05"} and bronze.count() == 7
    audit = {r["query"]: r for r in tables.read(spark, f"{folder}/audit").collect()}
    assert (audit["events_silver"].rows_in, audit["events_silver"].rows_valid, audit["events_silver"].rows_invalid) == (7, 1, 5)


def test_restart_reads_nothing_twice_and_batches_dedupe_alone(spark, folder):
    land(spark, f"{folder}/log", [event(1)])
    chain(spark, folder)
    chain(spark, folder)
    assert tables.read(spark, f"{folder}/silver").count() == 1
    land(spark, f"{folder}/log", [event(1), event(2)], first=10)
    chain(spark, folder)
    assert sorted(r.event_id for r in tables.read(spark, f"{folder}/silver").collect()) == ["e1", "e1", "e2"]


def test_dedupe_against_the_table(spark, folder):
    for first in (0, 10):
        land(spark, f"{folder}/log", [event(1), event(first + 2)], first)
        chain(spark, folder, dedupe="table")
    assert sorted(r.event_id for r in tables.read(spark, f"{folder}/silver").collect()) == ["e1", "e12", "e2"]


def test_a_batch_that_is_retried_replaces_itself(spark, folder):
    land(spark, f"{folder}/log", [event(1), event(2, source=None)])
    parsed = events.parse_events(events.to_bronze(events.decode_records(spark.read.schema(LOG_RECORD).parquet(f"{folder}/log"))))
    work = streams.audited("q", f"{folder}/audit", streams.silver_batch(f"{folder}/silver", f"{folder}/bad"))
    for _ in range(2):
        work(parsed, 7)
    assert [tables.read(spark, f"{folder}/{t}").count() for t in ("silver", "bad", "audit")] == [1, 1, 1]


def executions(spark):
    """The ids of the queries that were run last."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {found.apply(i).executionId() for i in range(max(0, found.size() - 20), found.size())}


def test_counts_come_from_the_writes_themselves(spark, folder):
    """Two tables and the audit row: three writes, and nothing else is run over a batch."""
    land(spark, f"{folder}/log", [event(1), event(1), event(2), event(3, source=None)])
    parsed = events.parse_events(events.to_bronze(events.decode_records(spark.read.schema(LOG_RECORD).parquet(f"{folder}/log"))))
    work = streams.audited("q", f"{folder}/audit", streams.silver_batch(f"{folder}/silver", f"{folder}/bad"))
    before = executions(spark)
    work(parsed, 0)
    assert len(executions(spark) - before) == 3
    row = tables.read(spark, f"{folder}/audit").first()
    assert (row.rows_in, row.rows_valid, row.rows_invalid, row.status) == (4, 2, 1, "ok")
    before = executions(spark)
    streams.audited("b", f"{folder}/audit", streams.bronze_batch(f"{folder}/bronze"))(spark.read.schema(LOG_RECORD).parquet(f"{folder}/log").withColumn("event_date", F.to_date("timestamp")), 0)
    assert len(executions(spark) - before) == 2


def test_a_batch_of_one_kind_or_none_leaves_no_files_of_the_other(spark, folder):
    parsed = events.parse_events(events.to_bronze(events.decode_records(spark.createDataFrame([], LOG_RECORD))))
    work = streams.silver_batch(f"{folder}/silver", f"{folder}/bad")
    assert work(parsed, 0) == (0, 0, 0)
    assert not tables.exists(spark, f"{folder}/silver") and not tables.exists(spark, f"{folder}/bad")


def test_both_tables_show_whole_batches_only(spark, folder, monkeypatch):
    """A crash between the two writes: readers see neither; the retry leaves one copy."""
    def batch(items, n):
        land(spark, f"{folder}/log{n}", items)
        return events.parse_events(events.to_bronze(events.decode_records(spark.read.schema(LOG_RECORD).parquet(f"{folder}/log{n}"))))

    silver, bad, audit = (f"{folder}/{t}" for t in ("silver", "bad", "audit"))
    work = streams.audited("events_silver", audit, streams.silver_batch(silver, bad))
    seen = lambda: tuple(streams.visible(spark, p, s, audit).count() for p, s in ((silver, SILVER_EVENTS), (bad, QUARANTINE)))
    assert seen() == (0, 0)
    work(batch([event(1), event(2, source=None)], 0), 0)
    assert seen() == (1, 1)
    write, later = streams.write_batch, batch([event(3), event(4), event(5, source=None)], 1)

    def dies(df, path, by, n):
        if path == bad:
            raise RuntimeError("killed")
        return write(df, path, by, n)

    monkeypatch.setattr(streams, "write_batch", dies)
    with pytest.raises(RuntimeError):
        work(later, 1)
    assert tables.read(spark, silver).count() == 3 and seen() == (1, 1) and streams.finished(spark, audit, "events_silver") == 0
    monkeypatch.setattr(streams, "write_batch", write)
    work(later, 1)
    assert seen() == (3, 2) and tables.read(spark, silver).count() == 3
    plan = streams.visible(spark, silver, SILVER_EVENTS, audit)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "<= 1)" in plan


def test_progress_is_kept_without_jobs(spark, folder):
    listener = streams.Progress()
    spark.streams.addListener(listener)
    try:
        land(spark, f"{folder}/log", [event(1), event(2)])
        records = streams.log_source(spark, f"{folder}/log").observe("records", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("key").isNull()).alias("without_key"))
        run(streams.start_bronze(records, f"{folder}/bronze", f"{folder}/c", name="watched"))
        for _ in range(100):
            if any(r[0] == "watched" and r[2] for r in listener.rows):
                break
            time.sleep(0.1)
        (row,) = listener.table(spark).filter("query = 'watched' and rows_in > 0").collect()
        assert (row.batch_id, row.observed["records.rows"], row.observed["records.without_key"]) == (0, 2, 0) and row.took_ms > 0
    finally:
        spark.streams.removeListener(listener)


def test_errors_are_recorded_and_raised(spark, folder):
    def fail(batch, n):
        raise RuntimeError("broken")

    try:
        streams.audited("q", f"{folder}/audit", fail)(spark.range(1), 3)
        raise AssertionError
    except RuntimeError:
        row = tables.read(spark, f"{folder}/audit").first()
        assert (row.status, row.error, row.batch_id) == ("error", "broken", 3)


def test_keys(spark):
    rows = [(json.dumps(event(1, user_id="")), "ip", "ua"), (json.dumps(event(2, user_id="u")), "ip", "ua"), (json.dumps(event(3, event_type="")), "ip", "ua"), ("[1]", "ip", "ua")]
    got = events.enrich(spark.createDataFrame(rows, "raw_json string, client_ip string, user_agent string")).collect()
    assert [r.key for r in got] == ["a", "u"] and json.loads(got[0].value)["collector_client_ip"] == "ip"
    parsed = events.parse_events(spark.createDataFrame([(r[0],) for r in rows[:2]], "raw_json string").select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE_EVENTS if f.name != "raw_json"]))
    assert [r.canonical_user_key for r in parsed.collect()] == ["", "u"]


def test_preview_and_windows(spark, folder):
    land(spark, f"{folder}/log", [event(1)])
    run(streams.preview(events.decode_records(streams.log_source(spark, f"{folder}/log")), fmt="memory", name="seen"))
    assert spark.table("seen").count() == 1
    ticks = spark.createDataFrame([("S", "x", "USD", AT + dt.timedelta(seconds=s), AT, float(s), f"e{s}") for s in (0, 30, 3000)], "symbol string, source_name string, currency string, event_ts_utc timestamp, ingestion_ts timestamp, price_usd double, event_id string")
    ticks.write.parquet(f"{folder}/ticks")
    bars = streams.windowed_bars(streams.table_source(spark, f"{folder}/ticks", ticks.schema))
    run(bars.writeStream.format("memory").queryName("bars").outputMode("append").trigger(availableNow=True).start())
    got = spark.table("bars").collect()
    assert len(got) == 1 and (got[0].open_price, got[0].close_price, got[0].tick_count) == (0.0, 30.0, 2)
    once = streams.deduplicated(streams.table_source(spark, f"{folder}/ticks", ticks.schema).withColumn("event_ts", F.col("event_ts_utc")))
    run(once.writeStream.format("memory").queryName("once").outputMode("append").trigger(availableNow=True).start())
    assert spark.table("once").count() == 3


def test_requests_go_to_the_log_and_come_back(spark, folder):
    requests = spark.createDataFrame([(json.dumps(event(1, user_id="u")), "1.2.3.4", "agent"), ("{bad", "1.2.3.4", "agent")], "raw_json string, client_ip string, user_agent string")
    streams.log_sink(events.enrich(requests), f"{folder}/sent")
    (row,) = spark.read.parquet(f"{folder}/sent").collect()
    assert row.key == "u" and json.loads(row.value)["collector_client_ip"] == "1.2.3.4"


def test_processing_time_trigger(spark, folder):
    land(spark, f"{folder}/log", [event(1), event(2)])
    query = streams.start_bronze(streams.log_source(spark, f"{folder}/log"), f"{folder}/bronze", f"{folder}/c", every="1 second")
    try:
        query.processAllAvailable()
        land(spark, f"{folder}/log", [event(3)], first=5)
        query.processAllAvailable()
        assert query.isActive and tables.read(spark, f"{folder}/bronze").count() == 3
    finally:
        query.stop()
        query.awaitTermination(60)
    assert not query.isActive


def test_options_of_a_topic():
    assert streams.kafka_options("h:9092", "t", "earliest") == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false"}


def at(minute):
    return dt.datetime(2024, 1, 5) + dt.timedelta(minutes=minute)


EVENTS = "event_id string, source string, session_id string, item_id string, event_type string, anonymous_id string, event_ts timestamp"


def made_events(spark, rows):
    """rows: id, source, session, item, minute"""
    return spark.createDataFrame([(i, s, x, item, "view", x, at(m)) for i, s, x, item, m in rows], EVENTS)


def in_batches(spark, folder, make, parts):
    """What a stream gives over parts that land one after the other, one batch each, and once more with nothing new."""
    for n, part in enumerate(parts):
        made_events(spark, part).coalesce(1).write.mode("append").parquet(f"{folder}/events")
        rows = streams.table_source(spark, f"{folder}/events", made_events(spark, []).schema)
        run(make(rows).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").outputMode("append").trigger(availableNow=True).start())
    return spark.read.parquet(f"{folder}/out")


def test_confirmations_as_they_happen(spark, folder):
    parts = [
        [("f1", "frontend", "s", "i", 0), ("f2", "frontend", "s", "j", 5), ("b1", "backend", "s", "i", 3), ("f0", "frontend", None, "i", 2)],
        [("b2", "backend", "s", "i", 30), ("b3", "backend", "s", "i", 31), ("b4", "backend", "t", "j", 6), ("f3", "frontend", "t", "j", 6)],
        [("b5", "backend", "s", "j", 28), ("f9", "frontend", "z", "z", 200), ("b9", "backend", "z", "z", 400)],
        [("f10", "frontend", "y", "y", 600), ("b10", "backend", "y", "y", 600)],
        [("f4", "frontend", "s", "i", 1), ("b11", "backend", "s", "i", 4), ("f11", "frontend", "y", "y", 700), ("b12", "backend", "y", "y", 700)],
    ]
    got = in_batches(spark, folder, lambda rows: events.confirmed_as_it_happens(rows, rows), parts)
    whole = events.confirmed(made_events(spark, [r for p in parts[:4] for r in p]))
    # what is over by the watermark is as in the batch form; f4 came after its time was over, f11 is not over yet
    want = sorted((r.event_id, r.confirmations) for r in whole.collect())
    assert sorted((r.event_id, r.confirmations) for r in got.collect()) == want and ("f1", 2) in want


def test_a_late_event_bridges_two_sessions(spark, folder):
    parts = [[("a", "frontend", "s", "i", 0), ("b", "frontend", "s", "i", 50)], [("c", "frontend", "s", "i", 25), ("d", "frontend", "u", "i", 0)], [("e", "frontend", "v", "i", 1000)], [("g", "frontend", "v", "i", 2000)]]
    got = in_batches(spark, folder, lambda rows: events.sessions(rows, late="1 hour"), parts)
    rows = {(r.anonymous_id, r.session_start, r.last_ts, r.events) for r in got.collect()}
    assert {("s", at(0), at(50), 3), ("u", at(0), at(0), 1)} <= rows and len(rows) <= 3
    batch = events.sessions(made_events(spark, [r for p in parts for r in p] + [("n", "frontend", None, "i", 3)]))
    assert rows <= {(r.anonymous_id, r.session_start, r.last_ts, r.events) for r in batch.collect()} and batch.count() == 4


def test_what_the_schema_lacks_is_kept_and_told(spark):
    texts = [json.dumps(event(1, extra={"a": 1}, user_id=7)), json.dumps(event(2)), "{bad", "[1]", "null", None, '{"properties": {"item_id": null, "size": [1]}}']
    rows = spark.createDataFrame([(t,) for t in texts], "raw_json string")
    got = {(r.path, r.kind): (r.records, r.status) for r in events.drift(rows).collect()}
    assert got["extra", "OBJECT"] == (1, "unknown") and got["user_id", "BIGINT"] == (1, "wrong type") and got["event_id", "STRING"] == (2, "known")
    assert got["properties.size", "ARRAY"] == (1, "unknown") and got["properties.item_id", "VOID"] == (1, "known") and got["properties", "OBJECT"] == (1, "known")
    kept = [r.u for r in events.with_unknown(rows).select(F.to_json("unknown").alias("u")).collect()]
    assert kept == ['{"extra":{"a":1}}', "{}", None, None, None, None, "{}"]
    assert "extra" in events.observed_schema(rows.limit(2)).first().observed
    assert events.drift(rows.limit(0)).collect() == []
