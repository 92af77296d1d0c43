"""Registered queries over the given tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import checks, prices
from tidemark.operators import events as clicks
from tidemark.plans import views
from tidemark.plans.price_pipeline import Paths, add_increment, run_increment, run_price_pipeline
from tidemark.schemas import BRONZE_EVENTS
from tidemark.session import utc, workspace
from tidemark.sources import compaction, tables
from tidemark.sources.log_files import log_lines
from tidemark.streaming.streams import write_batch

#: Clock columns are this instant, so that both sides agree.
NOW = "2024-02-01 00:00:00"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql.strip().replace("@events", "events")
        return f

    return add


def rounded(df: DataFrame, *more: str) -> DataFrame:
    """Doubles to 9 places: engines add up in different orders."""
    return df.select(*[F.round(c, 9).alias(c) if kind == "double" else c for c, kind in df.dtypes], *more)


# ---- prices -------------------------------------------------------------------------------------------------------------

FLAGGED = f"""ticks_raw AS ({views.TICKS_RAW}),
flagged AS (
  SELECT event_id, symbol, source_name, source_event_ts AS event_ts_utc, ingestion_ts, price_usd, currency,
         CASE WHEN source_event_ts IS NULL THEN 'NULL_EVENT_TS' WHEN price_usd IS NULL THEN 'NULL_PRICE'
              WHEN price_usd <= 0 THEN 'NEGATIVE_PRICE' ELSE 'OK' END AS quality_flag,
         CAST(source_event_ts AS DATE) AS processing_date
  FROM ticks_raw WHERE api_status = 'OK')"""

SILVER = f"""{FLAGGED},
silver AS (
  SELECT event_id, symbol, source_name, event_ts_utc, ingestion_ts, price_usd, currency, quality_flag, processing_date
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_ts, event_ts_utc, price_usd, symbol, source_name, currency) AS rn
        FROM flagged WHERE quality_flag = 'OK') WHERE rn = 1)"""


def bars_sql(unit: str, source: str = "silver", name: str = "bars") -> str:
    return f"""{name} AS (
  SELECT symbol, source_name, currency, date_trunc('{unit}', event_ts_utc) AS bar_start_ts,
         date_trunc('{unit}', event_ts_utc) + INTERVAL 1 {unit.upper()} AS bar_end_ts,
         CAST(date_trunc('{unit}', event_ts_utc) AS DATE) AS trade_date,
         first(price_usd ORDER BY event_ts_utc, ingestion_ts, event_id) AS open_price, max(price_usd) AS high_price, min(price_usd) AS low_price,
         last(price_usd ORDER BY event_ts_utc, ingestion_ts, event_id) AS close_price, avg(price_usd) AS avg_price, count(*) AS tick_count
  FROM {source} GROUP BY ALL)"""


BAR_COLUMNS = """symbol, source_name, currency, bar_start_ts, bar_end_ts, trade_date, open_price, high_price, low_price, close_price,
  round(avg_price, 9) AS avg_price, tick_count"""

METRICS_CTE = """r AS (
  SELECT symbol, source_name, currency, bar_start_ts AS metric_ts, close_price AS price_usd,
         (close_price - lag(close_price, 1) OVER s) / nullif(lag(close_price, 1) OVER s, 0) AS return_1m,
         (close_price - lag(close_price, 5) OVER s) / nullif(lag(close_price, 5) OVER s, 0) AS return_5m
  FROM bars WINDOW s AS (PARTITION BY symbol, source_name, currency ORDER BY bar_start_ts)),
m AS (
  SELECT *, avg(price_usd) OVER (s ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_5,
         avg(price_usd) OVER (s ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS ma_15,
         avg(price_usd) OVER (s ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS ma_60,
         stddev_samp(return_1m) OVER (s ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS volatility_15,
         stddev_samp(return_1m) OVER (s ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS volatility_60,
         stddev_samp(price_usd) OVER (s ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS sd
  FROM r WINDOW s AS (PARTITION BY symbol, source_name, currency ORDER BY metric_ts)),
z AS (SELECT * EXCLUDE sd, (price_usd - ma_60) / nullif(sd, 0) AS zscore_60 FROM m),
metrics AS (SELECT *, coalesce(abs(zscore_60) >= 3.0, false) AS is_anomaly FROM z)"""

METRIC_COLUMNS = """symbol, source_name, currency, metric_ts, price_usd, round(return_1m, 9) AS return_1m, round(return_5m, 9) AS return_5m,
  round(ma_5, 9) AS ma_5, round(ma_15, 9) AS ma_15, round(ma_60, 9) AS ma_60, round(volatility_15, 9) AS volatility_15,
  round(volatility_60, 9) AS volatility_60, round(zscore_60, 9) AS zscore_60, is_anomaly"""


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.clean_ticks(views.ticks_raw(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.ohlc_bars(silver(spark, sf_dir), "1 hour")


@query(f"WITH {SILVER} SELECT * FROM silver")
def silver_ticks(spark, sf_dir):
    return silver(spark, sf_dir)


@query(f"WITH {FLAGGED} SELECT quality_flag, count(*) AS ticks FROM flagged GROUP BY quality_flag")
def quality_flags(spark, sf_dir):
    return prices.with_quality_flag(views.ticks_raw(spark, sf_dir)).groupBy("quality_flag").agg(F.count("*").alias("ticks"))


@query(f"WITH {SILVER}, {bars_sql('minute')} SELECT {BAR_COLUMNS} FROM bars")
def bars_1m(spark, sf_dir):
    return rounded(prices.ohlc_bars(silver(spark, sf_dir)))


@query(f"WITH {SILVER}, {bars_sql('hour')} SELECT {BAR_COLUMNS} FROM bars")
def bars_1h(spark, sf_dir):
    return rounded(hourly(spark, sf_dir))


@query(f"WITH {SILVER}, {bars_sql('hour')} SELECT {BAR_COLUMNS} FROM bars")
def bars_join_form(spark, sf_dir):
    return rounded(prices.ohlc_bars_join_form(silver(spark, sf_dir), "1 hour"))


@query(f"WITH {SILVER}, {bars_sql('hour')}, {METRICS_CTE} SELECT {METRIC_COLUMNS} FROM metrics")
def price_metrics(spark, sf_dir):
    return rounded(prices.price_metrics(hourly(spark, sf_dir)))


@query(f"WITH {SILVER}, {bars_sql('hour')}, {METRICS_CTE} SELECT {METRIC_COLUMNS} FROM metrics")
def price_metrics_sliced(spark, sf_dir):
    return rounded(prices.price_metrics_sliced(hourly(spark, sf_dir)))


@query(f"WITH {SILVER}, {bars_sql('hour')}, {METRICS_CTE} SELECT symbol, source_name, currency, metric_ts, price_usd, round(zscore_60, 9) AS zscore_60 FROM metrics WHERE abs(zscore_60) >= 2.5")
def anomalies(spark, sf_dir):
    found = prices.price_metrics(hourly(spark, sf_dir), z_threshold=2.5).filter("is_anomaly")
    return rounded(found.select(*prices.METRIC_KEY, "price_usd", "zscore_60"))


@query(f"""
WITH q AS ({views.QUOTES_RAW}),
p AS (SELECT *, payload LIKE '{{"%' AS sound FROM q),
f AS (
  SELECT ingestion_ts, payload, sound, CASE WHEN sound THEN json_extract_string(payload, '$.symbol') END AS s,
         CASE WHEN sound THEN json_extract_string(payload, '$.updatedAt') END AS updated,
         CASE WHEN sound THEN try_cast(json_extract_string(payload, '$.price') AS DOUBLE) END AS price_usd
  FROM p),
g AS (
  SELECT *, coalesce(nullif(s, ''), 'XAU') AS symbol, try_cast(updated AS TIMESTAMP) AS source_event_ts,
         CASE WHEN sound THEN concat('{{"provider":"demo","raw_payload":', payload, '}}') ELSE concat('{{"provider":"demo","raw_payload":"', payload, '"}}') END AS payload_json
  FROM f)
SELECT sha256(concat_ws('|', 'gold_api', symbol, coalesce(updated, 'None'), payload_json)) AS event_id, symbol, 'gold_api' AS source_name, source_event_ts,
       ingestion_ts, price_usd, 'USD' AS currency, payload_json, CASE WHEN sound THEN 'OK' ELSE 'ERROR' END AS api_status FROM g""")
def normalize_quotes(spark, sf_dir):
    return prices.normalize_quotes(views.view(spark, sf_dir, views.QUOTES_RAW), "gold_api", "demo")


@query(f"""WITH t AS ({views.TICKS_RAW})
SELECT event_id, ingestion_ts, CAST(year(ingestion_ts) AS INT) AS ingest_year, CAST(month(ingestion_ts) AS INT) AS ingest_month,
       CAST(day(ingestion_ts) AS INT) AS ingest_day, CAST(hour(ingestion_ts) AS INT) AS ingest_hour FROM t""")
def bronze_calendar(spark, sf_dir):
    rows = prices.with_calendar(views.ticks_raw(spark, sf_dir))
    return rows.select("event_id", "ingestion_ts", "ingest_year", "ingest_month", "ingest_day", "ingest_hour")


@query(f"WITH {SILVER} SELECT event_id, symbol, source_name, event_ts_utc, price_usd, quality_flag FROM silver ORDER BY event_ts_utc DESC, event_id LIMIT 20")
def latest_ticks(spark, sf_dir):
    return checks.latest(silver(spark, sf_dir), "event_ts_utc", ["event_id"]).select("event_id", "symbol", "source_name", "event_ts_utc", "price_usd", "quality_flag")


@query(f"WITH {SILVER}, {bars_sql('hour')} SELECT {BAR_COLUMNS} FROM bars ORDER BY bar_start_ts DESC, symbol, source_name, currency LIMIT 20")
def latest_bars(spark, sf_dir):
    return rounded(checks.latest(hourly(spark, sf_dir), "bar_start_ts", prices.SERIES))


def check_sql(ctes: str, table: str, of: dict[str, str], key: str | None = None) -> str:
    distinct = f"count(DISTINCT {key}) AS distinct_{key}, " if key else ""
    sums = ", ".join(f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, c in of.items())
    return f"WITH {ctes} SELECT count(*) AS row_count, {distinct}{sums} FROM {table}"


@query(check_sql(FLAGGED, "ticks_raw", checks.BRONZE, "event_id"))
def check_bronze(spark, sf_dir):
    return checks.check(views.ticks_raw(spark, sf_dir), checks.BRONZE, "event_id")


@query(check_sql(SILVER, "silver", checks.SILVER, "event_id"))
def check_silver(spark, sf_dir):
    return checks.check(silver(spark, sf_dir), checks.SILVER, "event_id")


@query(check_sql(f"{SILVER}, {bars_sql('hour')}", "bars", checks.BARS))
def check_bars(spark, sf_dir):
    return checks.check(hourly(spark, sf_dir), checks.BARS)


@query(check_sql(f"{SILVER}, {bars_sql('hour')}, {METRICS_CTE}", "metrics", checks.METRICS))
def check_metrics(spark, sf_dir):
    return checks.check(prices.price_metrics(hourly(spark, sf_dir)), checks.METRICS)


@query(f"WITH t AS ({views.TICKS_RAW}) SELECT count(*) - count(DISTINCT event_id) AS duplicate_count FROM t")
def duplicate_count(spark, sf_dir):
    return checks.duplicate_count(views.ticks_raw(spark, sf_dir), "event_id")


@query(f"""WITH {SILVER}, {bars_sql('hour')}
SELECT 'bronze_rows' AS metric, count(*) AS value FROM ticks_raw UNION ALL SELECT 'silver_rows', count(*) FROM silver
UNION ALL SELECT 'bar_rows', count(*) FROM bars UNION ALL SELECT 'metric_rows', count(*) FROM bars
UNION ALL SELECT 'bronze_duplicates', count(*) - count(DISTINCT event_id) FROM ticks_raw
UNION ALL SELECT 'silver_duplicates', count(*) - count(DISTINCT event_id) FROM silver""")
def pipeline_summary(spark, sf_dir):
    bars = hourly(spark, sf_dir)
    return checks.summary(views.ticks_raw(spark, sf_dir), silver(spark, sf_dir), bars, prices.price_metrics(bars))


# ---- tables -------------------------------------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n, round(sum(value), 6) AS total FROM events WHERE value > 50 GROUP BY event_type")
def scan_table(spark, sf_dir):
    rows = tables.read(utc(spark), f"{sf_dir}/events.parquet").filter("value > 50")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def sql_path_scan(spark, sf_dir):
    return tables.query_path(utc(spark), f"{sf_dir}/events.parquet", "user_id").groupBy("user_id").agg(F.count("*").alias("n"))


def committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in two commits, the even ids first."""
    rows, path = views.events(spark, sf_dir).select("event_id", "event_type", "value"), workspace(spark)
    for version in (0, 1):
        at = F.lit(NOW).cast("timestamp") + F.expr(f"INTERVAL {version} DAY")
        tables.commit(spark, rows.filter(F.col("event_id") % 2 == version), path, version, at)
    return tables.read(spark, path)


@query("SELECT event_id, event_type, value FROM events WHERE event_id % 2 = 0")
def version_as_of(spark, sf_dir):
    return tables.version_as_of(committed(spark, sf_dir), 0)


@query(f"SELECT CAST(event_id % 2 AS INT) AS version, count(*) AS rows_added, TIMESTAMP '{NOW}' + CAST(event_id % 2 AS INT) * INTERVAL 1 DAY AS committed_at FROM events GROUP BY ALL")
def table_history(spark, sf_dir):
    return tables.history(committed(spark, sf_dir))


def number() -> str:
    return "CAST(substr(event_id, 5) AS BIGINT)"


@query(f"WITH {SILVER} SELECT event_id, symbol, source_name, event_ts_utc, round(CASE WHEN {number()} % 3 <> 0 THEN price_usd ELSE price_usd + 5 END, 9) AS price_usd, processing_date FROM silver")
def merge_insert_only(spark, sf_dir):
    ticks, path = silver(spark, sf_dir), workspace(spark)
    old = ticks.filter(f"{number()} % 3 <> 0")
    for rows in (old, ticks.withColumn("price_usd", F.col("price_usd") + 5)):
        tables.merge_insert_only(spark, path, rows, ["event_id"], ["processing_date"])
    return rounded(tables.read(spark, path).select("event_id", "symbol", "source_name", "event_ts_utc", "price_usd", "processing_date"))


@query(f"""WITH {SILVER}, early AS (SELECT * FROM silver WHERE {number()} % 3 <> 0), {bars_sql('hour', 'early', 'old')},
late AS (SELECT * FROM silver WHERE processing_date >= DATE '2024-01-15'), {bars_sql('hour', 'late', 'new')}
SELECT {BAR_COLUMNS} FROM new UNION ALL SELECT {BAR_COLUMNS} FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n
  WHERE n.symbol = o.symbol AND n.source_name = o.source_name AND n.currency = o.currency AND n.bar_start_ts = o.bar_start_ts)""")
def merge_upsert(spark, sf_dir):
    ticks, path = silver(spark, sf_dir), workspace(spark)
    for rows in (ticks.filter(f"{number()} % 3 <> 0"), ticks.filter("processing_date >= DATE '2024-01-15'")):
        tables.merge_upsert(spark, path, prices.ohlc_bars(rows, "1 hour"), prices.BAR_KEY, "trade_date")
    return rounded(tables.read(spark, path).select(*prices.BARS.fieldNames()))


@query(f"WITH {SILVER}, {bars_sql('minute')}, {METRICS_CTE} SELECT {METRIC_COLUMNS} FROM metrics")
def pipeline_end_to_end(spark, sf_dir):
    bronze = views.ticks_raw(spark, sf_dir).withColumn("payload_json", F.lit("{}"))
    return rounded(run_price_pipeline(spark, bronze, Paths.under(workspace(spark))))


def increments(spark: SparkSession, sf_dir: str):
    """Bronze rows in four parts: two thirds, the rest, which falls late into bars that are there, the first part once more, and again under its own number."""
    rows = views.ticks_raw(spark, sf_dir)
    early, late = rows.filter(f"{number()} % 3 <> 0"), rows.filter(f"{number()} % 3 = 0")
    return (0, early), (1, late), (2, early), (1, late)


@query(f"WITH {SILVER}, {bars_sql('hour')} SELECT {BAR_COLUMNS} FROM bars")
def bars_incremental(spark, sf_dir):
    paths = Paths.under(workspace(spark))
    for n, rows in increments(spark, sf_dir):
        add_increment(spark, rows, paths, n, "1 hour")
    return rounded(tables.read(spark, paths.bars).select(*prices.BARS.fieldNames()))


@query(f"WITH {SILVER}, {bars_sql('hour')}, {METRICS_CTE} SELECT {METRIC_COLUMNS} FROM metrics")
def metrics_incremental(spark, sf_dir):
    paths = Paths.under(workspace(spark))
    for n, rows in increments(spark, sf_dir)[:2]:
        out = run_increment(spark, rows, paths, n, "1 hour")
    return rounded(out)


# ---- events -------------------------------------------------------------------------------------------------------------

BRONZE = f"""raw AS ({views.EVENTS_RAW}),
bronze AS (
  SELECT kafka_key, raw_json, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, kafka_timestamp_type,
         TIMESTAMP '{NOW}' AS bronze_ingest_ts, json_valid(raw_json) AS ok,
         CASE WHEN json_valid(raw_json) THEN raw_json END AS doc FROM raw)"""


def json_field(name: str) -> str:
    return f"json_extract_string(doc, '$.{name}')"


PARSED = f"""{BRONZE},
parsed AS (
  SELECT raw_json, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, bronze_ingest_ts, {json_field('event_id')} AS event_id,
         try_cast({json_field('event_ts')} AS TIMESTAMP) AS event_ts, {json_field('event_type')} AS event_type, {json_field('source')} AS source,
         {json_field('user_id')} AS user_id, {json_field('anonymous_id')} AS anonymous_id, {json_field('session_id')} AS session_id,
         {json_field('page_url')} AS page_url, CAST(try_cast({json_field('event_ts')} AS TIMESTAMP) AS DATE) AS event_date,
         coalesce({json_field('user_id')}, {json_field('anonymous_id')}) AS canonical_user_key, {json_field('properties.item_id')} AS item_id,
         {json_field('properties.item_title')} AS item_title, {json_field('properties.backend_event_name')} AS backend_event_name
  FROM bronze),
judged AS (
  SELECT *, coalesce(source IN ('frontend', 'backend'), false) AND event_id IS NOT NULL AND event_ts IS NOT NULL AND event_type IS NOT NULL
            AND anonymous_id IS NOT NULL AND session_id IS NOT NULL AS valid FROM parsed),
good AS (
  SELECT * EXCLUDE (rn, valid) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) AS rn FROM judged WHERE valid)
  WHERE rn = 1)"""


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.to_bronze(views.events_raw(spark, sf_dir), F.lit(NOW).cast("timestamp"))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.parse_events(bronze_events(spark, sf_dir))


@query(f"""WITH {BRONZE}
SELECT kafka_key, raw_json, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, kafka_timestamp_type, bronze_ingest_ts,
       {json_field('event_type')} AS event_type, {json_field('anonymous_id')} AS anonymous_id, {json_field('session_id')} AS session_id,
       try_cast({json_field('event_ts')} AS TIMESTAMP) AS event_ts,
       coalesce(CAST(try_cast({json_field('event_ts')} AS TIMESTAMP) AS DATE), CAST(kafka_timestamp AS DATE)) AS event_date FROM bronze""")
def events_bronze(spark, sf_dir):
    return bronze_events(spark, sf_dir)


@query(SQL["events_bronze"])
def events_packed(spark, sf_dir):
    """Bronze written in four batches, of which the first three are packed up to a day, cleaned, and followed by a late one."""
    path = workspace(spark)
    for n in range(4):
        if n == 3:
            compaction.pack(spark, path, BRONZE_EVENTS, 2, "event_date", "2024-01-20")
            compaction.clean(spark, path)
        write_batch(bronze_events(spark, sf_dir).filter(F.col("kafka_offset") % 4 == n), path, ["event_date"], n)
    return compaction.rows(spark, path, BRONZE_EVENTS).drop("batch_id")


@query(f"WITH {PARSED} SELECT * FROM parsed")
def events_parsed(spark, sf_dir):
    return parsed_events(spark, sf_dir).drop("properties")


@query(f"WITH {PARSED} SELECT * FROM good")
def events_valid(spark, sf_dir):
    return clicks.valid_events(parsed_events(spark, sf_dir)).drop("properties")


@query(f"WITH {PARSED} SELECT * EXCLUDE valid, '{clicks.REASON}' AS quarantine_reason, TIMESTAMP '{NOW}' AS quarantine_ts FROM judged WHERE NOT valid")
def events_quarantine(spark, sf_dir):
    return clicks.invalid_events(parsed_events(spark, sf_dir), F.lit(NOW).cast("timestamp")).drop("properties")


@query(f"""WITH raw AS ({views.EVENTS_RAW}), r AS (SELECT *, raw_json AS doc FROM raw WHERE json_valid(raw_json))
SELECT coalesce(nullif({json_field('user_id')}, ''), nullif({json_field('anonymous_id')}, ''), nullif({json_field('session_id')}, ''), {json_field('event_type')}) AS key,
       concat(left(raw_json, length(raw_json) - 1), ',"collector_received_at":"{NOW}","collector_client_ip":"10.0.0.1","collector_user_agent":"', kafka_key, '"}}') AS value,
       '{NOW}' AS collector_received_at, '10.0.0.1' AS collector_client_ip, kafka_key AS collector_user_agent
FROM r WHERE coalesce({json_field('event_type')}, '') <> ''""")
def collector_enrich(spark, sf_dir):
    got = views.events_raw(spark, sf_dir).select("raw_json", F.lit("10.0.0.1").alias("client_ip"), F.col("kafka_key").alias("user_agent"))
    return clicks.enrich(got, F.lit(NOW).cast("timestamp"))


@query(f"""WITH l AS ({views.LINES_RAW}), k AS (SELECT position, trim(value) AS value FROM l WHERE trim(value) <> '')
SELECT position, value, (SELECT count(*) FROM k WHERE NOT json_valid(value)) AS malformed_lines
FROM k WHERE json_valid(value) ORDER BY position DESC LIMIT 20""")
def jsonl_tail(spark, sf_dir):
    return clicks.tail(views.view(spark, sf_dir, views.LINES_RAW))


@query(f"WITH l AS ({views.LINES_RAW}) SELECT trim(value) AS value, NOT json_valid(value) AS malformed FROM l WHERE trim(value) <> ''")
def log_files(spark, sf_dir):
    """The lines as a log on disk, read back in ranges of 64 KB."""
    path = workspace(spark)
    views.view(spark, sf_dir, views.LINES_RAW).select("value").write.text(path)
    return clicks.split_lines(log_lines(spark, path, range_bytes=1 << 16)).select("value", "malformed")


@query("""SELECT CASE event_type WHEN 'view' THEN 'navigation' WHEN 'click' THEN 'discovery' WHEN 'purchase' THEN 'checkout'
  WHEN 'signup' THEN 'post_purchase' WHEN 'error' THEN 'post_purchase' ELSE 'other' END AS stage, count(*) AS events, count(DISTINCT user_id) AS visitors
FROM events GROUP BY 1""")
def ext_lifecycle(spark, sf_dir):
    return clicks.lifecycle(views.events(spark, sf_dir))


@query(f"""WITH {PARSED} SELECT event_id, CASE
  WHEN row_number() OVER (PARTITION BY anonymous_id ORDER BY event_ts, event_id) = 1 THEN 'new_visitor'
  WHEN row_number() OVER (PARTITION BY anonymous_id, session_id ORDER BY event_ts, event_id) = 1 THEN 'new_session' ELSE 'repeated_interaction' END AS visit_kind
FROM good""")
def ext_visit_kind(spark, sf_dir):
    return clicks.visit_kind(clicks.valid_events(parsed_events(spark, sf_dir))).select("event_id", "visit_kind")


@query(f"""WITH {PARSED}, known AS (SELECT anonymous_id, last(user_id ORDER BY event_ts, event_id) AS k FROM good WHERE user_id IS NOT NULL GROUP BY 1)
SELECT event_id, coalesce(user_id, k, g.anonymous_id) AS stitched_user FROM good g LEFT JOIN known USING (anonymous_id)""")
def ext_stitch(spark, sf_dir):
    return clicks.stitch(clicks.valid_events(parsed_events(spark, sf_dir))).select("event_id", "stitched_user")


@query(f"""WITH {PARSED}
SELECT f.event_id, f.session_id, f.item_id, count(b.event_id) AS confirmations FROM good f LEFT JOIN good b
  ON b.source = 'backend' AND b.session_id = f.session_id AND b.item_id = f.item_id AND b.event_ts BETWEEN f.event_ts AND f.event_ts + INTERVAL 30 MINUTE
WHERE f.source = 'frontend' GROUP BY ALL""")
def ext_confirmed(spark, sf_dir):
    return clicks.confirmed(clicks.valid_events(parsed_events(spark, sf_dir)))


@query("""WITH e AS (SELECT user_id, event_type, CAST(ts AS TIMESTAMP) AS event_ts FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
m AS (SELECT *, CASE WHEN event_ts < lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts) + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens FROM e),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_ts) AS k FROM m)
SELECT user_id, min(event_ts) AS session_start, max(event_ts) AS last_ts, max(event_ts) + INTERVAL 12 HOUR AS session_end, count(*) AS events,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM s GROUP BY user_id, k""")
def ext_sessions(spark, sf_dir):
    return clicks.sessions(views.events(spark, sf_dir).withColumnRenamed("ts", "event_ts"), "12 hours", by="user_id")


@query(f"""WITH raw AS ({views.EVENTS_DRIFTED}), o AS (SELECT raw_json FROM raw WHERE json_valid(raw_json) AND json_type(raw_json) = 'OBJECT'),
f AS (SELECT k AS path, json_type(raw_json, '$.' || k) AS t FROM (SELECT raw_json, unnest(json_keys(raw_json)) AS k FROM o)
  UNION ALL SELECT 'properties.' || k, json_type(raw_json, '$.properties.' || k)
  FROM (SELECT raw_json, unnest(json_keys(raw_json, '$.properties')) AS k FROM o WHERE json_type(raw_json, '$.properties') = 'OBJECT')),
k AS (SELECT path, CASE t WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'NULL' THEN 'VOID' ELSE t END AS kind, count(*) AS records FROM f GROUP BY ALL)
SELECT path, kind, records, CASE
  WHEN path NOT IN ('event_id', 'event_ts', 'event_type', 'source', 'user_id', 'anonymous_id', 'session_id', 'page_url', 'properties', 'properties.item_id',
    'properties.item_title', 'properties.backend_event_name', 'properties.message') THEN 'unknown'
  WHEN kind = 'VOID' OR kind = CASE WHEN path = 'properties' THEN 'OBJECT' ELSE 'STRING' END THEN 'known' ELSE 'wrong type' END AS status FROM k""")
def event_drift(spark, sf_dir):
    return clicks.drift(views.view(spark, sf_dir, views.EVENTS_DRIFTED))
