"""Declared schemas at every layer's border; `!` fields are not null."""

from __future__ import annotations

from pyspark.sql import types as T

KINDS = {
    "str": T.StringType(), "ts": T.TimestampType(), "dbl": T.DoubleType(), "date": T.DateType(), "long": T.LongType(), "int": T.IntegerType(),
    "bool": T.BooleanType(), "bin": T.BinaryType(),
}


def declare(text: str) -> T.StructType:
    """A struct from words like `symbol!:str`; `!` marks a field that is never null."""
    out = T.StructType()
    for word in text.split():
        name, _, kind = word.partition(":")
        out = out.add(name.rstrip("!"), KINDS[kind], not name.endswith("!"))
    return out


BRONZE_PRICES = declare(
    "event_id!:str symbol!:str source_name!:str source_event_ts:ts ingestion_ts!:ts price_usd:dbl currency!:str payload_json!:str api_status!:str"
)
SILVER_TICKS = declare(
    "event_id!:str symbol!:str source_name!:str event_ts_utc:ts ingestion_ts!:ts price_usd:dbl currency!:str quality_flag!:str processing_date!:date"
)
BARS = declare(
    "symbol!:str source_name!:str currency!:str bar_start_ts!:ts bar_end_ts!:ts trade_date!:date"
    " open_price:dbl high_price:dbl low_price:dbl close_price:dbl avg_price:dbl tick_count!:long"
)
#: A bar as far as it is known: the earliest and the latest tick, and what can be added up; written by numbered increments.
TICK = T.StructType().add("order", declare("event_ts_utc:ts ingestion_ts:ts event_id:str")).add("price", T.DoubleType())
BAR_STATES = T.StructType([
    *declare("symbol!:str source_name!:str currency!:str bar_start_ts!:ts").fields, T.StructField("first", TICK), T.StructField("last", TICK),
    *declare("high:dbl low:dbl total:dbl ticks:long trade_date:date increment:long").fields,
])
METRICS = declare(
    "symbol!:str source_name!:str currency!:str metric_ts!:ts price_usd:dbl return_1m:dbl return_5m:dbl ma_5:dbl ma_15:dbl ma_60:dbl"
    " volatility_15:dbl volatility_60:dbl zscore_60:dbl is_anomaly!:bool"
)

#: A record of the log that events come from.
LOG_RECORD = declare("key:bin value:bin topic:str partition:int offset:long timestamp:ts timestampType:int")

PROPERTIES = declare("item_id:str item_title:str backend_event_name:str message:str")
EVENT = declare("event_id:str event_ts:str event_type:str source:str user_id:str anonymous_id:str session_id:str page_url:str").add("properties", PROPERTIES)

BRONZE_EVENTS = declare(
    "kafka_key:str raw_json:str kafka_topic:str kafka_partition:int kafka_offset:long kafka_timestamp:ts kafka_timestamp_type:int bronze_ingest_ts:ts"
    " event_type:str anonymous_id:str session_id:str event_ts:ts event_date:date"
)
SILVER_EVENTS = T.StructType([
    *declare("raw_json:str kafka_topic:str kafka_partition:int kafka_offset:long kafka_timestamp:ts bronze_ingest_ts:ts event_id:str event_ts:ts").fields,
    *EVENT.fields[2:],
    *declare("event_date:date canonical_user_key:str item_id:str item_title:str backend_event_name:str").fields,
])
QUARANTINE = T.StructType([*SILVER_EVENTS.fields, *declare("quarantine_reason:str quarantine_ts:ts").fields])

AUDIT = declare("query!:str batch_id!:long rows_in:long rows_valid:long rows_invalid:long status!:str error:str ts!:ts")
#: The batch that wrote a row of a streamed table.
BATCH = declare("batch_id!:long")
#: What a listener keeps of each batch.
PROGRESS = declare("query:str batch_id:long rows_in:long took_ms:long watermark:str").add("observed", T.MapType(T.StringType(), T.LongType())).add("error", T.StringType())
