"""Streaming queries over the given tables, run until all input is read.

Each one gives what its batch counterpart gives, as far as the watermark has
closed the windows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from txlake import schemas
from txlake.functions.money import exact_sum
from txlake.functions.times import micros
from txlake.operators import cdc, fraud
from txlake.operators.lateness import Lateness
from txlake.plans.inputs import TX_SQL, as_transactions, order_changes
from txlake.plans.medallion import Lake
from txlake.plans.queries_batch import (
    ALERTS_SQL,
    EVENT_RECORD_RULES,
    EVENT_RULES,
    IN_WINDOW_TYPES,
    RISK_SQL,
    SESSION_GAP,
    WINDOW_TYPES,
    sessions_sql,
    windows_sql,
)
from txlake.plans.queries_tables import CDC_STATE_SQL
from txlake.plans.registry import query
from txlake.session import scratch
from txlake.sources import kafka
from txlake.sources.buckets import ApplyToBuckets, BucketTable
from txlake.sources.files import table, table_stream
from txlake.sources.versioned import VersionedTable
from txlake.streaming import fraud as fraud_stream
from txlake.streaming import events, metrics, sinks, timers, windows
from txlake.streaming.cdc import ApplyChanges
from txlake.streaming.late import LateSplit
from txlake.streaming.serving import ServingViews


def _transactions(spark, folder):
    return windows.watermarked(as_transactions(table_stream(spark, folder, "events")), "ts")


def _to_table(spark, df, name):
    """Run a stream into files and read them back."""
    out = scratch(spark, name)
    sinks.drain(sinks.to_files(df, f"{out}/data", f"{out}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{out}/data")



@query(
    "stream_tumbling",
    f"""WITH {TX_SQL}, w AS ({windows_sql('tx', 300, 300)}) SELECT * FROM w WHERE window_end <= (SELECT MAX(ts) - INTERVAL 15 SECOND FROM tx WHERE {IN_WINDOW_TYPES})""",
)
def stream_tumbling(spark, folder):
    rows = _transactions(spark, folder)
    rows = windows.valid_events(rows, WINDOW_TYPES, F.col("tx_type")).withColumnRenamed("tx_type", "event_type")
    return _to_table(spark, windows.windowed(rows, "ts", ["event_type"], 300, "amount"), "tumbling")


@query(
    "stream_sliding",
    f"""WITH {TX_SQL}, w AS ({windows_sql('tx', 300, 60)}) SELECT * FROM w WHERE window_end <= (SELECT MAX(ts) - INTERVAL 15 SECOND FROM tx WHERE {IN_WINDOW_TYPES})""",
)
def stream_sliding(spark, folder):
    rows = _transactions(spark, folder)
    rows = windows.valid_events(rows, WINDOW_TYPES, F.col("tx_type")).withColumnRenamed("tx_type", "event_type")
    return _to_table(spark, windows.windowed(rows, "ts", ["event_type"], 300, "amount", 60), "sliding")


@query(
    "stream_session",
    f"""WITH {TX_SQL}, s AS ({sessions_sql('tx', SESSION_GAP)})
SELECT user_id, session_start AS window_start, session_end AS window_end, tx_count, total_amount FROM s
WHERE session_end <= (SELECT MAX(ts) - INTERVAL 15 SECOND FROM tx)""",
)
def stream_session(spark, folder):
    found = windows.sessions(_transactions(spark, folder), "ts", "user_id", SESSION_GAP, "amount")
    return _to_table(spark, found, "session")


@query("stream_fraud", f"WITH {TX_SQL}, {ALERTS_SQL} SELECT * FROM alerts")
def stream_fraud(spark, folder):
    rows = _transactions(spark, folder)
    return _to_table(spark, fraud_stream.user_alerts(rows, EVENT_RULES), "fraud")


@query("stream_fraud_batches", f"WITH {TX_SQL}, {ALERTS_SQL} SELECT * FROM alerts")
def stream_fraud_batches(spark, folder):
    out = scratch(spark, "alert-batches")
    handler = fraud_stream.AlertBatches(out, EVENT_RULES)
    rows = _transactions(spark, folder)
    sinks.drain(sinks.to_batches(rows, handler, f"{out}/checkpoint", every=None))
    return spark.read.parquet(handler.alerts).drop("batch")


# How far events may lag behind and still be judged with their context.
KEPT = Lateness(disorder=2 * 86_400, allowed=0)
DISORDER_SQL = f"""{TX_SQL}, parted AS (
  SELECT *, LEAST(3, (day(ts) - 1) // 8 + CASE WHEN k < 10 THEN 1 ELSE 0 END) AS part FROM tx
), tops AS (SELECT part, MAX(ts) AS top FROM parted GROUP BY part), judged AS (
  SELECT *, COALESCE(ts < (SELECT MAX(top) FROM tops WHERE tops.part < p.part) - INTERVAL {KEPT.disorder} SECOND, FALSE) AS late FROM parted p
)"""


def _in_parts(spark, rows, part, count, handler, out, then=None):
    """Part after part is added to a feed, and a stream works off what is new; ``then`` runs after each."""
    for n in range(count):
        rows.filter(F.col(part) == n).drop(part).write.mode("append").parquet(f"{out}/feed")
        feed = spark.readStream.schema(rows.drop(part).schema).parquet(f"{out}/feed")
        sinks.drain(sinks.to_batches(feed, handler, f"{out}/checkpoint", every=None))
        if then:
            then()


def _judged_in_parts(spark, folder):
    """Events that arrive in four parts, a tenth of them one part late; the stream starts
    anew from its checkpoint for each part."""
    out = scratch(spark, "parts")
    rows = as_transactions(table(spark, folder, "events")).select("event_id", "user_id", "amount", "ts", "k")
    part = F.floor((F.dayofmonth("ts") - 1) / 8) + F.when(F.col("k") < 10, 1).otherwise(0)
    rows = rows.withColumn("part", F.least(part, F.lit(3)))
    handler = fraud_stream.AlertBatches(f"{out}/judged", EVENT_RULES, KEPT)
    _in_parts(spark, rows, "part", 4, handler, out)
    return handler


@query(
    "stream_fraud_disorder",
    f"""WITH {DISORDER_SQL}, ok AS (SELECT * FROM judged WHERE NOT late),
{ALERTS_SQL.replace("FROM tx p WHERE", "FROM ok p WHERE p.part <= t.part AND").replace("FROM tx t", '''FROM ok t
  UNION ALL SELECT *, 0, 0 FROM judged WHERE late''')} SELECT * FROM alerts""",
)
def stream_fraud_disorder(spark, folder):
    """Late rows are judged by their amount; the others with what arrived before."""
    return spark.read.parquet(_judged_in_parts(spark, folder).alerts).drop("batch")


@query(
    "stream_fraud_dead_letters",
    f"""WITH {DISORDER_SQL} SELECT event_id, user_id, amount, ts FROM judged WHERE late""",
)
def stream_fraud_dead_letters(spark, folder):
    return spark.read.parquet(_judged_in_parts(spark, folder).dead_letters).select("event_id", "user_id", "amount", "ts")


@query(
    "stream_record_rules",
    f"""WITH {TX_SQL} SELECT tx_id, user_id, amount, currency FROM tx
WHERE is_suspicious OR amount > CASE currency WHEN 'KRW' THEN 150 WHEN 'USD' THEN 100 ELSE 80 END OR (tx_type = 'WITHDRAWAL'
  AND channel = 'ATM' AND amount > 0.5 * CASE currency WHEN 'KRW' THEN 150 WHEN 'USD' THEN 100 ELSE 80 END)""",
)
def stream_record_rules(spark, folder):
    rules = fraud.RecordRules(thresholds={"KRW": 150.0, "USD": 100.0, "JPY": 80.0})
    found = fraud.record_alerts(_transactions(spark, folder), rules)
    return _to_table(spark, found.select("tx_id", "user_id", "amount", "currency"), "records")


@query(
    "stream_distinct",
    f"""WITH {TX_SQL} SELECT user_id, COUNT(*) AS events FROM (SELECT DISTINCT user_id, event_id FROM tx) GROUP BY user_id""",
)
def stream_distinct(spark, folder):
    rows = windows.distinct_events(_transactions(spark, folder).select("user_id", "event_id", "ts"), ["event_id"])
    found = _to_table(spark, rows, "distinct")
    return found.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))


SLICES = 8


def _sliced_events(spark, folder, name):
    """All events rewritten in an order that is not event order: slice n holds the
    events whose property k falls into the n-th eighth."""
    path = scratch(spark, name)
    rows = as_transactions(table(spark, folder, "events")).select("event_id", "user_id", "tx_type", "amount", "ts", "k")
    rows.withColumn("slice", F.floor(F.col("k") * SLICES / 100).cast("int")).write.partitionBy("slice").parquet(path)
    return spark.read.parquet(path)


SLICED_SQL = f"""{TX_SQL}, sliced AS (SELECT *, k * {SLICES} // 100 AS slice FROM tx),
newest AS (SELECT slice, MAX(ts) AS top FROM sliced GROUP BY slice),
marked AS (SELECT s.*, (SELECT MAX(top) FROM newest n WHERE n.slice < s.slice) - INTERVAL 15 SECOND AS passed FROM sliced s)"""


@query(
    "stream_late_split",
    f"""WITH {SLICED_SQL} SELECT event_id, amount, ts, 'tumbling' AS late_for FROM marked WHERE time_bucket(INTERVAL 300 SECOND, ts) + INTERVAL 300 SECOND <= passed
UNION ALL SELECT event_id, amount, ts, 'sliding' FROM marked WHERE time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 300 SECOND <= passed""",
)
def stream_late_split(spark, folder):
    """One slice per micro-batch: rows of later slices are late for windows that
    earlier slices have closed."""
    split = _split(spark, folder)
    return spark.read.parquet(split.dead_letters).select("event_id", "amount", "ts", "late_for")


def _split(spark, folder):
    out = scratch(spark, "late")
    split = LateSplit(f"{out}/split", "ts", None, 300, 60)
    _in_parts(spark, _sliced_events(spark, folder, "slices"), "slice", SLICES, split, out)
    return split


@query(
    "stream_windows_with_late",
    f"""WITH {SLICED_SQL}, kept AS (
  SELECT *, time_bucket(INTERVAL 300 SECOND, ts) AS start, COALESCE(time_bucket(INTERVAL 300 SECOND, ts) + INTERVAL 300 SECOND <= passed, FALSE) AS late FROM marked
) SELECT tx_type AS event_type, start AS window_start, start + INTERVAL 300 SECOND AS window_end,
  COUNT(*) FILTER (WHERE NOT late) AS transaction_count,
  COALESCE(CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))) FILTER (WHERE NOT late), 6) AS DOUBLE), 0.0) AS total_amount,
  COUNT(*) FILTER (WHERE late) AS late_count FROM kept GROUP BY tx_type, start""",
)
def stream_windows_with_late(spark, folder):
    """Windows of the rows on time beside the number of those that came too late: nothing
    is lost between the two."""
    split = _split(spark, folder)
    kept = spark.read.parquet(split.on_time).filter(~F.array_contains("late_for", "tumbling"))
    late = spark.read.parquet(split.dead_letters).filter("late_for = 'tumbling'")
    both = kept.withColumn("late", F.lit(False)).drop("late_for").unionByName(late.withColumn("late", F.lit(True)).drop("late_for"))
    window = F.window(F.col("ts").cast("timestamp"), "300 seconds").alias("w")
    on_time = F.when(~F.col("late"), F.col("amount"))
    return both.groupBy(F.col("tx_type").alias("event_type"), window).agg(
        F.count_if(~F.col("late")).alias("transaction_count"),
        F.coalesce(exact_sum(on_time), F.lit(0.0)).alias("total_amount"),
        F.count_if("late").alias("late_count"),
    ).select(
        "event_type",
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "transaction_count",
        "total_amount",
        "late_count",
    )


# Parts of ninety hours cut day-long windows in two; a tenth of the rows comes one part late.
PART_SECONDS = 90 * 3600
DAY_SECONDS = 86_400
TIMED_SQL = f"""{TX_SQL}, parted AS (
  SELECT *, CAST(LEAST(7, floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / {PART_SECONDS}000000) + CASE WHEN k < 10 THEN 1 ELSE 0 END) AS INTEGER) AS part FROM tx
), tops AS (SELECT part, MAX(ts) AS top FROM parted GROUP BY part), kept AS (
  SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS start, COALESCE(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY
    <= (SELECT MAX(top) FROM tops WHERE tops.part < p.part) - INTERVAL 15 SECOND, FALSE) AS late FROM parted p)"""


@query(
    "stream_windows_updated",
    f"""WITH {TIMED_SQL}, w AS (SELECT tx_type AS event_type, start AS window_start, start + INTERVAL 1 DAY AS window_end,
  COUNT(*) FILTER (WHERE NOT late) AS transaction_count,
  CAST(ROUND(SUM(CAST(COALESCE(amount, 0) AS DECIMAL(28,8))) FILTER (WHERE NOT late), 6) AS DOUBLE) AS total_amount,
  MAX(COALESCE(amount, 0)) FILTER (WHERE NOT late) AS max_amount, MIN(COALESCE(amount, 0)) FILTER (WHERE NOT late) AS min_amount,
  COUNT(DISTINCT part) FILTER (WHERE NOT late) AS emissions,
  COUNT(*) FILTER (WHERE late) AS late_count FROM kept GROUP BY tx_type, start)
SELECT * FROM w WHERE transaction_count > 0""",
)
def stream_windows_updated(spark, folder):
    """Windows that are emitted again whenever a batch changes them, until the lateness has
    passed; the sink holds the last emission. What comes later is in the dead letters.

    Two streams in a row: the first sets late rows aside, the second reads those on time.
    """
    out = scratch(spark, "updated")
    split = LateSplit(f"{out}/split", "ts", None, DAY_SECONDS)
    rows = as_transactions(table(spark, folder, "events")).select("event_id", "tx_type", "amount", "ts", "k")
    since = micros(F.col("ts")) - micros(F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    part = F.floor(since / (PART_SECONDS * 1_000_000)) + F.when(F.col("k") < 10, 1).otherwise(0)
    keys = ["event_type", "window_start", "window_end"]
    results = sinks.KeyedResults(VersionedTable(spark, f"{out}/windows"), keys)

    def update():
        schema = spark.read.parquet(f"{split.on_time}/batch=0").schema
        on_time = spark.readStream.schema(schema).parquet(f"{split.on_time}/batch=*").withColumnRenamed("tx_type", "event_type")
        found = windows.windowed(windows.watermarked(on_time, "ts"), "ts", ["event_type"], DAY_SECONDS, "amount")
        sinks.drain(sinks.to_batches(found, results, f"{out}/checkpoint-windows", every=None, mode="update"))

    _in_parts(spark, rows.withColumn("part", F.least(part, F.lit(7))), "part", 8, split, out, update)
    letters = spark.read.parquet(split.dead_letters)
    start = F.window(F.col("ts").cast("timestamp"), f"{DAY_SECONDS} seconds")["start"].cast("timestamp_ntz")
    late = letters.groupBy(F.col("tx_type").alias("event_type"), start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("late_count")
    )
    measured = [*keys, "transaction_count", "total_amount", "max_amount", "min_amount", "emissions"]
    joined = results.read().select(*measured).join(late, ["event_type", "window_start"], "left")
    return joined.withColumn("late_count", F.coalesce("late_count", F.lit(0).cast("bigint"))).select(*measured, "late_count")


@query(
    "stream_serving_expiry",
    f"""WITH {TX_SQL}, {ALERTS_SQL}, latest AS (SELECT * FROM alerts
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY detected_at DESC, alert_id DESC) = 1)
SELECT user_id, alert_id, rule_id, trigger_amount, detected_at FROM latest
WHERE CAST(detected_at AS TIMESTAMP) + INTERVAL {timers.EXPIRY_SECONDS} SECOND > (SELECT MAX(CAST(detected_at AS TIMESTAMP)) FROM alerts)""",
)
def stream_serving_expiry(spark, folder):
    """The latest alert of each user, gone a day after its time."""
    out = scratch(spark, "expiry")
    judge = fraud_stream.AlertBatches(f"{out}/judged", EVENT_RULES)
    rows = _transactions(spark, folder)
    sinks.drain(sinks.to_batches(rows, judge, f"{out}/checkpoint-judge", every=None))
    schema = spark.read.parquet(f"{judge.alerts}/batch=0").schema
    alerts = spark.readStream.schema(schema).parquet(f"{judge.alerts}/batch=*")
    timed = alerts.withColumn("at_time", F.to_timestamp("detected_at")).withWatermark("at_time", "0 seconds")
    changes = timers.latest_until_expiry(timed, "user_id", "at_time", "alert_id")
    view = sinks.KeyedResults(VersionedTable(spark, f"{out}/latest"), ["user_id"], (F.desc("at"), F.desc("expired")))
    sinks.drain(sinks.to_batches(changes, view, f"{out}/checkpoint", every=None, mode="update"))
    return timers.body_fields(view.read(), schema).select("user_id", "alert_id", "rule_id", "trigger_amount", "detected_at")


# Of the messages one in ten is cut off, one in ten names no number as user, some have no value.
MESSAGES_SQL = f"""{TX_SQL}, judged AS (SELECT *, CASE WHEN k = 11 THEN 'empty' WHEN k % 10 IN (3, 5) THEN 'malformed' END AS reason FROM tx)"""


def event_messages(spark, folder):
    """Transactions as messages of a topic, some of them broken."""
    tx = as_transactions(table(spark, folder, "events"))
    k = F.col("k")
    event = F.struct(
        F.col("tx_id").alias("event_id"),
        F.col("tx_type").alias("event_type"),
        F.when(k % 10 == 5, F.lit("nobody")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        "amount",
        "currency",
        F.when(k % 20 == 7, F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).alias("event_timestamp"),
        F.lit("more").alias("unknown_property"),
    )
    # Numbers stand without quotes, except where there is none.
    text = F.regexp_replace(F.to_json(event), '"user_id":"([0-9]+)"', '"user_id":$1')
    value = F.when(k == 11, F.lit(None)).when(k % 10 == 3, F.substring(text, 1, 40)).otherwise(text)
    return tx.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("events.ingested").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        (F.date_trunc("day", F.col("ts").cast("timestamp"))).alias("timestamp"),
    )


@query(
    "stream_decoded_events",
    f"""WITH {MESSAGES_SQL} SELECT event_id AS "offset", 'event' AS kind, CAST(NULL AS VARCHAR) AS reason, CAST(user_id AS VARCHAR) AS key, tx_id AS event_id, user_id, amount,
  CASE WHEN k % 20 = 7 THEN date_trunc('day', ts) ELSE ts END AS event_at, k % 20 = 7 AS time_is_fallback FROM judged WHERE reason IS NULL
UNION ALL SELECT event_id, 'reject', reason, CAST(user_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL FROM judged WHERE reason IS NOT NULL""",
)
def stream_decoded_events(spark, folder):
    """Every message is either an event or a message of the dead-letter topic, with its reason."""
    out = scratch(spark, "decoded")
    event_messages(spark, folder).write.parquet(f"{out}/topic")
    topic = spark.readStream.schema(schemas.TOPIC_ROW).parquet(f"{out}/topic")

    def send(messages, batch_id):
        kafka.identified(messages, "decode", batch_id).write.mode("append").parquet(f"{out}/dlq")

    handler = events.DecodeBatches(out, send)
    sinks.drain(sinks.to_batches(topic, handler, f"{out}/checkpoint", every=None))
    good = spark.read.parquet(handler.events)
    letters = kafka.without_repeats(spark.read.parquet(f"{out}/dlq"))
    letters = letters.select("key", F.from_json("value", 'reason STRING, offset BIGINT').alias("v"))
    shown = good.select(
        F.col("_offset").alias("offset"), F.lit("event").alias("kind"), F.lit(None).cast("string").alias("reason"),
        F.col("user_id").cast("string").alias("key"), "event_id", "user_id", "amount", "event_at", "time_is_fallback",
    )
    none = {c: F.lit(None).cast(shown.schema[c].dataType) for c in ("event_id", "user_id", "amount", "event_at", "time_is_fallback")}
    bad = letters.select(F.col("v.offset").alias("offset"), F.lit("reject").alias("kind"), F.col("v.reason").alias("reason"), "key").withColumns(none)
    return shown.unionByName(bad)


@query("stream_alert_messages", f"WITH {TX_SQL}, {ALERTS_SQL} SELECT alert_id, rule_id, user_id FROM alerts")
def stream_alert_messages(spark, folder):
    """Alerts sent to a topic, one batch of them twice: a reader sees each of them once."""
    out = scratch(spark, "messages")
    judge = fraud_stream.AlertBatches(f"{out}/judged", EVENT_RULES)
    sinks.drain(sinks.to_batches(_transactions(spark, folder), judge, f"{out}/checkpoint-judge", every=None))
    schema = spark.read.parquet(f"{judge.alerts}/batch=0").schema
    frame = lambda alerts: kafka.keyed_messages(alerts, "alerts.fraud", F.col("user_id"))
    write = lambda messages: messages.write.mode("append").parquet(f"{out}/topic")
    sender = sinks.TopicBatches("alerts", frame, write)
    alerts = spark.readStream.schema(schema).parquet(f"{judge.alerts}/batch=*")
    sinks.drain(sinks.to_batches(alerts, sender, f"{out}/checkpoint", every=None))
    # The batch is sent again, as after a failure before its commit.
    sender(spark.read.parquet(f"{judge.alerts}/batch=0"), 0)
    seen = kafka.without_repeats(spark.read.parquet(f"{out}/topic"))
    return seen.select(F.from_json("value", "alert_id STRING, rule_id STRING, user_id BIGINT").alias("v")).select("v.*")


@query(
    "stream_alert_rate",
    f"""WITH {TX_SQL}, {RISK_SQL} SELECT COUNT(*) AS processed, COUNT(*) FILTER (WHERE len(reasons) > 0) AS alerts,
  ROUND(CAST(COUNT(*) FILTER (WHERE len(reasons) > 0) AS DOUBLE) * 100 / COUNT(*), 2) AS alert_rate FROM judged""",
)
def stream_alert_rate(spark, folder):
    """Processed and suspicious rows, counted by the stream that writes the alerts."""
    out, counters = scratch(spark, "rate"), metrics.Counters(spark)
    try:
        counted = metrics.Counters.observe(_transactions(spark, folder), "records", **fraud.record_counters(EVENT_RECORD_RULES))
        stream = sinks.to_files(fraud.record_alerts(counted, EVENT_RECORD_RULES), f"{out}/data", f"{out}/checkpoint")
        sinks.drain(stream)
        sums = counters.after(stream, "records")
    finally:
        counters.close()
    row = spark.createDataFrame([(sums.get("processed", 0), sums.get("alerts", 0))], "processed BIGINT, alerts BIGINT")
    return row.withColumn("alert_rate", F.round(F.try_divide(F.col("alerts").cast("double") * 100, F.col("processed")), 2))


def _serving(spark, folder, view):
    """Alerts written by one stream feed the views of a second one."""
    lake = Lake(spark, scratch(spark, "serving"))
    judge = fraud_stream.AlertBatches(f"{lake.root}/judged", EVENT_RULES)
    rows = _transactions(spark, folder)
    sinks.drain(sinks.to_batches(rows, judge, f"{lake.root}/checkpoint-judge", every=None))
    schema = spark.read.parquet(f"{judge.alerts}/batch=0").schema
    alerts = spark.readStream.schema(schema).parquet(f"{judge.alerts}/batch=*")
    handler = ServingViews(lake)
    sinks.drain(sinks.to_batches(alerts, handler, f"{lake.root}/checkpoint", every=None))
    return getattr(handler, view).read()


@query(
    "stream_serving_count",
    f"WITH {TX_SQL}, {ALERTS_SQL} SELECT user_id, COUNT(*) AS alert_count FROM alerts GROUP BY user_id",
)
def stream_serving_count(spark, folder):
    return _serving(spark, folder, "count")


@query(
    "stream_serving_latest",
    f"""WITH {TX_SQL}, {ALERTS_SQL} SELECT * FROM alerts
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY detected_at DESC, alert_id DESC) = 1""",
)
def stream_serving_latest(spark, folder):
    return _serving(spark, folder, "latest")


@query(
    "stream_serving_recent",
    f"WITH {TX_SQL}, {ALERTS_SQL} SELECT * FROM alerts ORDER BY detected_at DESC, alert_id DESC LIMIT 100",
)
def stream_serving_recent(spark, folder):
    return _serving(spark, folder, "recent")


@query("stream_cdc", CDC_STATE_SQL)
def stream_cdc(spark, folder):
    """Change records landed as files and applied by a stream."""
    path = scratch(spark, "changes")
    cdc.unwrap(order_changes(spark, folder), position="offset").write.parquet(path)
    feed = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    target = VersionedTable(spark, scratch(spark, "stream-cdc"))
    at = F.lit(dt.datetime(2024, 1, 1))
    handler = ApplyChanges(target, ["settlement_id"], ["__source_ts_ms", "__offset"], at)
    sinks.drain(sinks.to_batches(feed, handler, scratch(spark, "cdc-checkpoint"), every=None))
    return handler.state().select("settlement_id", "merchant_id", "total_amount", "status", "__deleted")


@query("stream_cdc_buckets", CDC_STATE_SQL)
def stream_cdc_buckets(spark, folder):
    """The change feed in three batches, each rewriting the buckets of its keys."""
    out = scratch(spark, "bucket-changes")
    changes = cdc.unwrap(order_changes(spark, folder), position="offset")
    table_ = BucketTable(spark, f"{out}/table", ["settlement_id"], 16)
    handler = ApplyToBuckets(table_, ["__source_ts_ms", "__offset"], F.lit(dt.datetime(2024, 1, 1)), ("__offset",))
    turn = F.when(F.col("__op") == "c", 0).when(F.col("__op") == "u", 1).otherwise(2)
    _in_parts(spark, changes.withColumn("turn", turn), "turn", 3, handler, out)
    return table_.read().select("settlement_id", "merchant_id", "total_amount", "status", "__deleted")
