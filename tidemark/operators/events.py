"""Clickstream records: from the log to bronze, typed parsing, validation, enrichment, and logs of JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.text import filled, instant
from tidemark.schemas import BRONZE_EVENTS, EVENT, SILVER_EVENTS

SOURCES = ("frontend", "backend")
REQUIRED = ("event_id", "event_ts", "event_type", "anonymous_id", "session_id")
REASON = "schema_or_required_field_validation_failed"


def decode_records(records: DataFrame) -> DataFrame:
    """Log records with key and value as text, under the names of the bronze table."""
    # fixed values: the log's columns and the table's
    return records.selectExpr(
        "CAST(key AS STRING) AS kafka_key", "CAST(value AS STRING) AS raw_json", "topic AS kafka_topic", "partition AS kafka_partition",
        "offset AS kafka_offset", "timestamp AS kafka_timestamp", "timestampType AS kafka_timestamp_type",
    )


def to_bronze(decoded: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Raw text with four fields lifted out of it. A record without a readable time goes by the log's own for its date."""
    field = lambda name: F.get_json_object("raw_json", f"$.{name}")
    rows = decoded.withColumns({
        "bronze_ingest_ts": F.current_timestamp() if ingested_at is None else ingested_at,
        "event_type": field("event_type"), "anonymous_id": field("anonymous_id"), "session_id": field("session_id"), "event_ts": instant(field("event_ts")),
    })
    rows = rows.withColumn("event_date", F.coalesce(F.to_date("event_ts"), F.to_date("kafka_timestamp")))
    return rows.select(*BRONZE_EVENTS.fieldNames())


def parse_events(bronze: DataFrame) -> DataFrame:
    """Typed silver columns from the raw text. What can't be read is null; nothing fails.

    The parsed record is laid out by inline_outer, one row for each: filters on its fields stay above that, so that it is parsed once.
    """
    kept = ["raw_json", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "bronze_ingest_ts"]
    rows = bronze.select(*kept, F.inline_outer(F.array(F.from_json("raw_json", EVENT))))
    rows = rows.withColumn("event_ts", instant(F.col("event_ts"))).withColumns({
        "event_date": F.to_date("event_ts"), "canonical_user_key": F.coalesce("user_id", "anonymous_id"), "item_id": F.col("properties.item_id"),
        "item_title": F.col("properties.item_title"), "backend_event_name": F.col("properties.backend_event_name"),
    })
    return rows.select(*SILVER_EVENTS.fieldNames())


def is_valid() -> Column:
    """Never null, so that every event is either valid or not: one without a source is not."""
    sound = F.col("source").isin(*SOURCES)
    for c in REQUIRED:
        sound = sound & F.col(c).isNotNull()
    return F.coalesce(sound, F.lit(False))


def valid_events(parsed: DataFrame) -> DataFrame:
    """Valid events, one row of each event_id: that of the lowest log partition and offset."""
    order = Window.partitionBy("event_id").orderBy("kafka_partition", "kafka_offset")
    return parsed.filter(is_valid()).withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")


def invalid_events(parsed: DataFrame, at: Column | None = None) -> DataFrame:
    """All other events, with the reason and the time."""
    return parsed.filter(~is_valid()).withColumns({"quarantine_reason": F.lit(REASON), "quarantine_ts": F.current_timestamp() if at is None else at})


def enrich(requests: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Key and JSON value for the log from received objects (raw_json, client_ip, user_agent).

    Requests that are no JSON object, or have no event_type, are left out. The key is the first of user_id, anonymous_id,
    session_id and event_type that is not empty. The value has the object's own fields and the three of the collector.
    """
    got = F.from_json("raw_json", "map<string,string>")
    field = lambda name: F.get_json_object("raw_json", f"$.{name}")
    rows = requests.filter(F.trim("raw_json").startswith("{") & F.get_json_object("raw_json", "$").isNotNull() & (F.coalesce(field("event_type"), F.lit("")) != ""))
    extra = {
        "collector_received_at": (F.current_timestamp() if received_at is None else received_at).cast("string"),
        "collector_client_ip": F.col("client_ip"),
        "collector_user_agent": F.col("user_agent"),
    }
    rows = rows.withColumns(extra).withColumn("key", filled(*[field(c) for c in ("user_id", "anonymous_id", "session_id", "event_type")]))
    # the object's text stays as it came; the new fields go in before its closing brace
    body = F.regexp_replace(F.rtrim("raw_json"), r"\}\s*$", "")
    added = F.regexp_replace(F.to_json(F.struct(*extra)), r"^\{", ",")
    return rows.select("key", F.concat(body, added).alias("value"), *extra)


def split_lines(lines: DataFrame, schema: str = "event_id string, event_type string") -> DataFrame:
    """(position, value, parsed, malformed) for the lines of a JSON log (position, value) that are not blank."""
    kept = lines.filter(F.trim("value") != "").withColumn("value", F.trim("value"))
    sound = F.get_json_object("value", "$").isNotNull()
    return kept.withColumns({"parsed": F.when(sound, F.from_json("value", schema)), "malformed": ~sound})


def tail(lines: DataFrame, limit: int = 20) -> DataFrame:
    """The last sound entries of a JSON log, the latest first, with the number of malformed lines in the whole log beside each."""
    rows = split_lines(lines)
    bad = rows.agg(F.count_if("malformed").alias("malformed_lines"))
    last = rows.filter("not malformed").orderBy(F.desc("position")).limit(limit)
    # one row: the count
    return last.select("position", "value").crossJoin(F.broadcast(bad))


#: Stages of a visit by type of event: fixed values.
STAGES = {
    "page_view": "navigation", "view": "navigation", "product_view": "evaluation", "click": "discovery", "add_to_cart": "cart", "purchase": "checkout",
    "signup": "post_purchase", "error": "post_purchase",
}


def lifecycle(events: DataFrame, stages: dict[str, str] = STAGES) -> DataFrame:
    """Events and visitors in each stage of a visit. An extension."""
    stage = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in stages.items()], F.lit("other"))
    return events.groupBy(stage.alias("stage")).agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("visitors"))


def visit_kind(events: DataFrame) -> DataFrame:
    """Each event as from a new visitor, in a new session of a known one, or a repeated interaction. An extension."""
    mine, session = Window.partitionBy("anonymous_id"), Window.partitionBy("anonymous_id", "session_id")
    order = F.struct("event_ts", "event_id")
    kind = (
        F.when(order == F.min(order).over(mine), "new_visitor").when(order == F.min(order).over(session), "new_session").otherwise("repeated_interaction")
    )
    return events.withColumn("visit_kind", kind)


def stitch(events: DataFrame) -> DataFrame:
    """stitched_user: the user that an anonymous visitor last logged in as, else the visitor. An extension."""
    known = events.filter("user_id is not null and anonymous_id is not null").groupBy("anonymous_id")
    known = known.agg(F.max_by("user_id", F.struct("event_ts", "event_id")).alias("_known"))
    return events.join(known, "anonymous_id", "left").withColumn("stitched_user", F.coalesce("user_id", "_known", "anonymous_id")).drop("_known")


def confirmed(events: DataFrame, within: str = "30 minutes") -> DataFrame:
    """Frontend events, and how many backend events of the same session and item follow within that time. An extension."""
    front = events.filter("source = 'frontend'").alias("f")
    back = events.filter("source = 'backend'").select("session_id", "item_id", F.col("event_ts").alias("at")).alias("b")
    near = (F.col("at") >= F.col("event_ts")) & (F.col("at") <= F.expr(f"event_ts + INTERVAL {within}"))
    both = front.join(back, (F.col("f.session_id") == F.col("b.session_id")) & (F.col("f.item_id") == F.col("b.item_id")) & near, "left")
    return both.groupBy("f.event_id", "f.session_id", "f.item_id").agg(F.count("at").alias("confirmations"))


def confirmed_as_it_happens(front: DataFrame, back: DataFrame, within: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """confirmed for two streams of events: each frontend event is given once, when no confirmation of it can come any more.

    That is once both streams are past its time by `within` and `late`; state is dropped then, and what is later is left out. An extension.
    """
    front = front.filter("source = 'frontend'").select("event_id", "session_id", "item_id", "event_ts").withWatermark("event_ts", late).alias("f")
    back = back.filter("source = 'backend'").select("session_id", "item_id", F.col("event_ts").alias("at")).withWatermark("at", late).alias("b")
    near = (F.col("b.at") >= F.col("f.event_ts")) & (F.col("b.at") <= F.col("f.event_ts") + F.expr(f"INTERVAL {within}"))
    both = front.join(back, (F.col("f.session_id") == F.col("b.session_id")) & (F.col("f.item_id") == F.col("b.item_id")) & near, "leftOuter")
    found = both.groupBy("f.event_ts", "f.event_id", "f.session_id", "f.item_id").agg(F.count("at").alias("confirmations"))
    return found.select("event_id", "session_id", "item_id", "confirmations")


def sessions(events: DataFrame, gap: str = "30 minutes", by: str = "anonymous_id", late: str | None = None) -> DataFrame:
    """Visits by time: a visitor's events of which each comes less than `gap` after one before it. An extension.

    late: for streams; a session is given once the watermark is past its end, and until then an event that lies between two sessions makes
    them one. Events without a visitor or time are left out. Counts and ends combine before the shuffle.
    """
    rows = events.filter(F.col(by).isNotNull() & F.col("event_ts").isNotNull())
    rows = rows.withWatermark("event_ts", late) if late else rows
    found = rows.groupBy(F.session_window("event_ts", gap).alias("_s"), by).agg(
        F.count(F.lit(1)).alias("events"), F.max("event_ts").alias("last_ts"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )
    return found.select(by, F.col("_s.start").alias("session_start"), "last_ts", F.col("_s.end").alias("session_end"), "events", "purchases")


#: What schema_of_variant calls the types that a field may have.
VARIANT_KINDS = {"string": ("STRING",), "struct": ("OBJECT",)}


def drift(records: DataFrame, schema: StructType = EVENT, raw: str = "raw_json") -> DataFrame:
    """(path, kind, records, status): each field that the records hold against the declared schema, down to its nested fields.

    status is `known`, `unknown` for a field that the schema lacks, or `wrong type` for one that typed parsing makes null or text of. A null
    is of any type. Records that are no JSON object hold no fields. One pass and one small aggregate, whatever the fields are.
    """
    parsed = records.select(F.try_parse_json(raw).alias("_v"))
    objects = parsed.filter(F.schema_of_variant("_v").startswith("OBJECT"))
    top = objects.select(F.explode(_object_entries("_v", None)).alias("e"))
    nested = [f.name for f in schema.fields if isinstance(f.dataType, StructType)]
    for name in nested:
        inner = F.try_variant_get("_v", f"$.{name}", "variant")
        of = objects.select(inner.alias("_v")).filter(F.schema_of_variant("_v").startswith("OBJECT"))
        top = top.unionByName(of.select(F.explode(_object_entries("_v", name)).alias("e")))
    found = top.select("e.path", "e.kind").groupBy("path", "kind").agg(F.count("*").alias("records"))
    declared = {p: k for f in schema.fields for p, k in [(f.name, f.dataType), *[(f"{f.name}.{g.name}", g.dataType) for g in getattr(f.dataType, "fields", [])]]}
    status = F.when(~F.col("path").isin(*declared), "unknown").when(F.col("kind") == "VOID", "known")
    for kind, names in VARIANT_KINDS.items():
        of_kind = [p for p, k in declared.items() if k.typeName() == kind]
        status = status.when(F.col("path").isin(*of_kind) & F.col("kind").isin(*names), "known")
    return found.withColumn("status", status.otherwise("wrong type"))


def _object_entries(value: str, under: str | None) -> Column:
    """(path, kind) of the entries of a variant object."""
    entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    path = (lambda k: F.concat(F.lit(f"{under}."), k)) if under else (lambda k: k)
    return F.transform(entries, lambda e: F.struct(path(e["key"]).alias("path"), F.coalesce(F.regexp_replace(F.schema_of_variant(e["value"]), "[<(].*", ""), F.lit("VOID")).alias("kind")))


def with_unknown(records: DataFrame, schema: StructType = EVENT, raw: str = "raw_json") -> DataFrame:
    """records with `unknown`: the top-level fields that the schema lacks, as a map of variants; null where the text is no JSON object."""
    fields = F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>")
    return records.withColumn("unknown", F.map_filter(fields, lambda k, _: ~k.isin(*schema.fieldNames())))


def observed_schema(records: DataFrame, raw: str = "raw_json") -> DataFrame:
    """One row: the schema that all records together have."""
    return records.agg(F.schema_of_variant_agg(F.try_parse_json(raw)).alias("observed"))
