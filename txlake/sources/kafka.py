"""Kafka readers and writers.

They need Spark's Kafka connector on the classpath. The same column contract
(``schemas.TOPIC_ROW``) is met by ``files.topic_files``, which reads topics that
have been landed as files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txlake.functions.text import json_value, mapping


def source_options(
    servers: str,
    topics: list[str],
    starting: str = "latest",
    ending: str | None = None,
    starting_timestamp_ms: int | None = None,
    ending_timestamp_ms: int | None = None,
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if starting_timestamp_ms is None:
        options["startingOffsets"] = starting
    else:
        options["startingTimestamp"] = str(starting_timestamp_ms)
    if ending_timestamp_ms is not None:
        options["endingTimestamp"] = str(ending_timestamp_ms)
    elif ending:
        options["endingOffsets"] = ending
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_bounded(spark: SparkSession, servers: str, topics: list[str], **kw) -> DataFrame:
    """Everything between two offset positions, earliest to latest by default."""
    options = source_options(servers, topics, **({"starting": "earliest", "ending": "latest"} | kw))
    return spark.read.format("kafka").options(**options).load()


def day_range(first: dt.date, until: dt.date) -> dict[str, int]:
    """Options of a bounded read of the days [first, until), in UTC."""
    at = lambda day: int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.UTC).timestamp() * 1000)
    return {"starting_timestamp_ms": at(first), "ending_timestamp_ms": at(until)}


def read_days(
    spark: SparkSession, servers: str, topics: list[str], first: dt.date, until: dt.date | None = None, **kw
) -> DataFrame:
    """What arrived on the days [first, until), one day by default.

    The broker finds the offsets, so a daily run reads a day and not the topic.
    """
    days = day_range(first, until or first + dt.timedelta(days=1))
    # A day that nothing has followed yet ends at the latest offset.
    return read_bounded(spark, servers, topics, **days, **kw)


def read_unbounded(spark: SparkSession, servers: str, topics: list[str], **kw) -> DataFrame:
    """Continuous read. Progress lives in the query's checkpoint folder; to replay,
    start with a new one and ``starting="earliest"`` or ``starting_timestamp_ms``."""
    return spark.readStream.format("kafka").options(**source_options(servers, topics, **kw)).load()


def keyed_messages(df: DataFrame, topic: Column | str, key: Column) -> DataFrame:
    """(topic, key, value) rows: the value is the whole row as JSON."""
    topic_col = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(
        topic_col.alias("topic"), key.cast("string").alias("key"), json_value(*df.columns).alias("value")
    )


MESSAGE_ID = "message_id"


def identified(messages: DataFrame, stream: str, batch_id: int) -> DataFrame:
    """(topic, key, value) rows with a header that names each message for good.

    The id is made of the stream, the batch, the message's own content and its number
    among equal messages of the batch. So a batch that is sent again, in whatever order,
    carries the same ids, and two equal messages of one batch stay two.
    """
    counted = messages.groupBy("topic", "key", "value").agg(F.count(F.lit(1)).alias("copies"))
    told = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("~")) for c in ("topic", "key", "value")]
    content = F.sha2(F.concat_ws("|", *[c.cast("string") for c in told]), 256)
    number = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    named = counted.withColumn("copy", number)
    name = F.concat_ws("/", F.lit(stream), F.lit(str(batch_id)), content, F.col("copy").cast("string"))
    header = F.struct(F.lit(MESSAGE_ID).alias("key"), name.cast("binary").alias("value"))
    return named.select("topic", "key", "value", F.array(header).alias("headers"))


def message_id(headers: Column) -> Column:
    """The id that ``identified`` gave a message, null without one."""
    found = F.filter(headers, lambda h: h["key"] == MESSAGE_ID)
    return F.try_element_at(found, F.lit(1))["value"].cast("string")


def without_repeats(messages: DataFrame, within: str = "1 hour") -> DataFrame:
    """Messages as a reader should see them: each id once; those without an id all.

    On a stream, ids are remembered for ``within`` of the messages' own time, so the
    state stays bounded and a replay must come within it.
    """
    named = messages.withColumn("_id", F.coalesce(message_id(F.col("headers")), F.uuid()))
    if messages.isStreaming:
        return named.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["_id"]).drop("_id")
    return named.dropDuplicates(["_id"]).drop("_id")


def topic_by_type(event_type: Column, topics: dict[str, str], default: str) -> Column:
    """Topic name for an event type, ``default`` for unknown types."""
    return mapping(topics, event_type, default)


def write_messages(messages: DataFrame, servers: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def stream_messages(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """At-least-once by nature of the sink; with ``sinks.TopicBatches`` messages carry ids
    on which readers drop repeats."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
