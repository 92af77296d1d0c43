"""Dirty inputs made from the events table: the same text for Spark and for the SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import utc

TICKS_RAW = """
WITH base AS (
  SELECT event_id AS n, concat('evt_', CAST(event_id AS STRING)) AS event_id,
         event_type AS symbol, concat('src', CAST(user_id % 2 AS STRING)) AS source_name, 'USD' AS currency,
         CASE WHEN event_id % 23 = 5 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS source_event_ts,
         CAST(ts AS TIMESTAMP) + (event_id % 5) * INTERVAL 1 SECOND AS ingestion_ts,
         CASE WHEN event_id % 17 = 3 THEN NULL WHEN event_id % 19 = 4 THEN -value
              WHEN event_id % 31 = 6 THEN 0.0 ELSE value END AS price_usd,
         CASE WHEN event_id % 29 = 7 THEN 'ERROR' ELSE 'OK' END AS api_status
  FROM @events)
SELECT event_id, symbol, source_name, currency, source_event_ts, ingestion_ts, price_usd, api_status FROM base
UNION ALL
SELECT event_id, symbol, source_name, currency, source_event_ts, ingestion_ts + INTERVAL 60 SECOND, price_usd + 1.0, api_status
FROM base WHERE n % 10 = 0
"""

EVENTS_RAW = """
WITH base AS (
  SELECT event_id AS n, CAST(user_id AS STRING) AS u, event_type AS et, CAST(ts AS TIMESTAMP) AS t FROM @events),
j AS (
  SELECT n, u, t, CASE WHEN n % 41 = 0 THEN '{bad' ELSE concat(
    '{"event_id":"evt_', CAST(n AS STRING), '"',
    CASE WHEN n % 37 = 1 THEN ',"event_ts":"not-a-time"' WHEN n % 37 = 2 THEN ''
         ELSE concat(',"event_ts":"', CAST(CAST(t AS DATE) AS STRING), 'T12:00:00Z"') END,
    CASE WHEN n % 31 = 3 THEN '' ELSE concat(',"event_type":"', et, '"') END,
    CASE WHEN n % 13 = 4 THEN '' WHEN n % 11 = 5 THEN ',"source":"mobile"' WHEN n % 2 = 0 THEN ',"source":"frontend"' ELSE ',"source":"backend"' END,
    CASE WHEN n % 3 = 0 THEN concat(',"user_id":"u', u, '"') ELSE '' END,
    CASE WHEN n % 5 = 0 THEN '' ELSE concat(',"anonymous_id":"anon_', u, '"') END,
    CASE WHEN n % 19 = 6 THEN '' ELSE concat(',"session_id":"sess_', u, '"') END,
    ',"page_url":"/p","properties":{"item_id":"sku_', CAST(n % 7 AS STRING), '","item_title":"t","user_agent":"x"}}') END AS raw_json
  FROM base)
SELECT concat('anon_', u) AS kafka_key, raw_json, 'user_events' AS kafka_topic, CAST(n % 3 AS INT) AS kafka_partition, n AS kafka_offset,
       t AS kafka_timestamp, 0 AS kafka_timestamp_type FROM j
UNION ALL
SELECT concat('anon_', u), raw_json, 'user_events', CAST(n % 3 AS INT), n + 1000000, t, 0 FROM j WHERE n % 10 = 1
"""

#: Events whose producers changed: a field that is new, ids that are numbers, properties that are text or hold more.
EVENTS_DRIFTED = """
SELECT event_id AS n, CASE WHEN event_id % 29 = 0 THEN '{bad' WHEN event_id % 31 = 0 THEN '[1,2]' ELSE concat('{"event_id":',
    CASE WHEN event_id % 7 = 0 THEN CAST(event_id AS STRING) ELSE concat('"evt_', CAST(event_id AS STRING), '"') END,
    ',"event_type":"', event_type, '"',
    CASE WHEN event_id % 5 = 0 THEN ',"referrer":"mail"' WHEN event_id % 5 = 1 THEN ',"referrer":{"kind":"mail"}' ELSE '' END,
    CASE WHEN event_id % 3 = 0 THEN ',"source":null' ELSE ',"source":"frontend"' END,
    CASE WHEN event_id % 11 = 0 THEN ',"properties":"none"' WHEN event_id % 11 = 1 THEN ',"properties":{"item_id":7,"colour":"red"}'
         ELSE ',"properties":{"item_id":"sku","message":"m"}' END, '}') END AS raw_json
FROM @events
"""

QUOTES_RAW = """
SELECT CAST(ts AS TIMESTAMP) AS ingestion_ts,
       CASE WHEN event_id % 41 = 0 THEN '{bad' WHEN event_id % 43 = 1 THEN '[1]' ELSE concat('{',
         CASE WHEN event_id % 17 = 2 THEN '' ELSE concat('"price":', CAST(event_id AS STRING), ',') END,
         '"symbol":"', CASE WHEN event_id % 13 = 0 THEN '' ELSE event_type END, '","updatedAt":"',
         CASE WHEN event_id % 19 = 3 THEN 'soon' ELSE concat(CAST(CAST(ts AS DATE) AS STRING), 'T08:00:00Z') END, '"}') END AS payload
FROM @events
"""

LINES_RAW = """
SELECT event_id AS position,
       CASE WHEN event_id % 7 = 0 THEN '   ' WHEN event_id % 11 = 0 THEN '{broken'
            ELSE concat('  {"event_id":"evt_', CAST(event_id AS STRING), '","event_type":"', event_type, '"}') END AS value
FROM @events
"""


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A view's rows, over the events table of sf_dir."""
    name = f"events_{uuid.uuid4().hex}"
    utc(spark).read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView(name)
    return spark.sql(text.replace("@events", name))


def ticks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, TICKS_RAW)


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, EVENTS_RAW)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, with its time as an instant."""
    return utc(spark).read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
