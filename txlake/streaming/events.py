"""Topic messages as typed events, with those that cannot be read set aside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake import schemas
from txlake.functions.text import json_value
from txlake.functions.times import audited_event_time
from txlake.sources.files import decode_json
from txlake.streaming.sinks import write_batch

POSITION = ["_topic", "_partition", "_offset"]


def decode_events(topic: DataFrame, schema=schemas.STREAM_EVENT) -> DataFrame:
    """Typed rows of a topic: the fields of ``schema``, where each message came from, the event
    time and ``reject_reason`` (null for a good message).

    A message without a value, or whose text doesn't fit the schema, is rejected; unknown
    properties are ignored and missing ones are null. An event time that cannot be read is
    replaced by the message's own time, and ``time_is_fallback`` says so.
    """
    rows = decode_json(topic, F.col("value"), schema)
    reason = F.when(F.col("value").isNull(), "empty").when(F.col("_corrupt").isNotNull(), "malformed")
    time = audited_event_time(F.col("data.event_timestamp"), F.col("timestamp"))
    return rows.select(
        *[F.col(f"data.{name}") for name in schema.names],
        F.col("topic").alias("_topic"),
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
        F.col("key").cast("string").alias("_key"),
        F.col("value").cast("string").alias("_value"),
        time["at"].alias("event_at"),
        time["is_fallback"].alias("time_is_fallback"),
        reason.alias("reject_reason"),
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNull()).drop("reject_reason", "_key", "_value")


def rejected(decoded: DataFrame, topic: Column | str) -> DataFrame:
    """Rejected messages as messages of a dead-letter topic: key as it was, and as value the
    reason, the place it came from and the text itself."""
    bad = decoded.filter(F.col("reject_reason").isNotNull())
    shown = bad.select(
        "_key",
        F.col("reject_reason").alias("reason"),
        F.col("_topic").alias("topic"),
        F.col("_partition").alias("partition"),
        F.col("_offset").alias("offset"),
        F.col("_value").alias("text"),
    )
    to = F.lit(topic) if isinstance(topic, str) else topic
    # The key belongs to the frame and not to the document.
    document = json_value(*[c for c in shown.columns if c != "_key"])
    return shown.select(to.alias("topic"), F.col("_key").alias("key"), document.alias("value"))


class DecodeBatches:
    """Batch handler: events into one folder per batch, rejects as messages through ``send``."""

    def __init__(self, path: str, send: Callable[[DataFrame, int], None], dead_letter_topic: str = "events.dlq"):
        self.path, self.send, self.dead_letter_topic = path.rstrip("/"), send, dead_letter_topic

    @property
    def events(self) -> str:
        return f"{self.path}/events"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # The micro-batch is read and parsed once.
        write_batch(decode_events(batch), f"{self.path}/decoded", batch_id)
        decoded = batch.sparkSession.read.parquet(f"{self.path}/decoded/batch={batch_id}")
        write_batch(accepted(decoded), self.events, batch_id)
        self.send(rejected(decoded, self.dead_letter_topic), batch_id)
