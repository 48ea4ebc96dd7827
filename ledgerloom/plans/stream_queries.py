"""Streaming jobs run to the end of the given events; the resulting tables are compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import amount_sum
from ledgerloom.operators.shaping import case_map
from ledgerloom.plans.change_queries import CHANGE_TYPES, LATEST_STATE_SQL
from ledgerloom.plans.registry import Tables, query
from ledgerloom.session import scratch_path
from ledgerloom.sources import sinks
from ledgerloom.streaming import incremental as I


def raw_event_stream(t: Tables):
    return I.file_stream(t.spark, f"{t.folder}/event[s].parquet", t.events.schema)


def event_stream(t: Tables):
    """The events table as a stream, times as instants."""
    return raw_event_stream(t).withColumn("ts", F.col("ts").cast("timestamp"))


@query("st_file_arrival", "SELECT event_id, user_id, event_type, value FROM events")
def _(t: Tables):
    """Two deliveries arrive one after the other; each run loads only what is new."""
    inbox, table, checkpoint = (scratch_path(t.spark, x) for x in ("inbox", "loaded", "arrivals"))
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    for purchases in (True, False):
        part = rows.filter((F.col("event_type") == "purchase") == F.lit(purchases))
        part.write.mode("append").parquet(inbox)
        I.run_available(I.file_stream(t.spark, inbox, rows.schema), checkpoint, table)
    return t.spark.read.parquet(table)


@query("st_cdc_latest", LATEST_STATE_SQL)
def _(t: Tables):
    table, checkpoint = scratch_path(t.spark, "latest"), scratch_path(t.spark, "latest-cp")
    changes = raw_event_stream(t).select(
        "user_id", "event_id", "ts", "value", case_map("event_type", CHANGE_TYPES).alias("optype")
    )
    I.run_available(changes, checkpoint, I.keep_latest(table, ["user_id"], ["ts", "event_id"]))
    state = I.read_state(t.spark, table, ["user_id"], ["ts", "event_id"])
    return state.filter("optype <> 'D'").select("user_id", "event_id", "value", "optype")


@query("st_dedup_events", "SELECT event_id, user_id, event_type FROM events")
def _(t: Tables):
    """Every event is delivered twice and must come out once."""
    inbox, table, checkpoint = (scratch_path(t.spark, x) for x in ("twice", "once", "once-cp"))
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    rows.unionByName(rows).write.parquet(inbox)
    I.run_available(I.deduplicated(I.file_stream(t.spark, inbox, rows.schema), ["event_id"], "ts", "40 days"), checkpoint, table)
    return t.spark.read.parquet(table).select("event_id", "user_id", "event_type")


@query(
    "st_windowed_counts",
    """
    SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""",
)
def _(t: Tables):
    table, checkpoint = scratch_path(t.spark, "hourly"), scratch_path(t.spark, "hourly-cp")
    total = amount_sum("value")
    counts = I.windowed_counts(event_stream(t), "ts", "1 hour", "2 days", ["event_type"], total)
    I.run_available(counts, checkpoint, I.replace_by_key(table, ["bucket", "event_type"]), mode="update")
    state = I.read_state(t.spark, table, ["bucket", "event_type"])
    return state.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query(
    "st_missing_event_join",
    """
    WITH w AS (SELECT least(max(ts) FILTER (event_type = 'signup'), max(ts) FILTER (event_type = 'purchase')) - INTERVAL 1 HOUR AS watermark FROM events)
    SELECT event_id, user_id FROM events s, w WHERE event_type = 'signup' AND ts + INTERVAL 12 HOUR < watermark
      AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = s.user_id AND p.ts BETWEEN s.ts AND s.ts + INTERVAL 12 HOUR)""",
)
def _(t: Tables):
    table, checkpoint = scratch_path(t.spark, "missing"), scratch_path(t.spark, "missing-cp")
    issued = event_stream(t).filter("event_type = 'signup'").select("event_id", "user_id", F.col("ts").alias("issued_at"))
    bought = event_stream(t).filter("event_type = 'purchase'").select(F.col("user_id").alias("buyer"), F.col("ts").alias("bought_at"))
    missing = I.missing_events(issued, bought, "user_id", "issued_at", "buyer", "bought_at", "12 hours", "1 hour")
    I.run_available(missing, checkpoint, table)
    return t.spark.read.parquet(table).select("event_id", "user_id")


@query(
    "st_event_publish",
    """
    SELECT CAST(user_id AS VARCHAR) AS key, '{"eventId":' || CAST(event_id AS VARCHAR) || ',"user_id":' || CAST(user_id AS VARCHAR) || ',"kind":"' || event_type || '"}' AS value FROM events""",
)
def _(t: Tables):
    topic, checkpoint = scratch_path(t.spark, "topic"), scratch_path(t.spark, "topic-cp")
    stream = event_stream(t).select("event_id", "user_id", "event_type")
    messages = sinks.events(stream, "user_id", {"event_id": "eventId", "event_type": "kind"})
    I.run_available(messages, checkpoint, I.publish_each(topic))
    return t.spark.read.schema("key string, value string, batch int").json(topic).select("key", "value")
