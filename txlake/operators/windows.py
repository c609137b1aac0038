"""Event-time windows over bounded input.

All of them aggregate before the shuffle, so a hot key costs one partial row
per task and window, not one task per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from txlake.functions.money import as_double, exact_sum, money
from txlake.functions.times import iso_millis, seconds


def measures(amount: Column) -> list[Column]:
    """Count, sum, mean, maximum and minimum; a missing amount counts as zero."""
    value = F.coalesce(amount, F.lit(0.0))
    return [
        F.count(F.lit(1)).alias("transaction_count"),
        exact_sum(value).alias("total_amount"),
        (exact_sum(value) / F.count(F.lit(1))).alias("avg_amount"),
        F.max(value).alias("max_amount"),
        F.min(value).alias("min_amount"),
    ]


RESULT_COLUMNS = ["transaction_count", "total_amount", "avg_amount", "max_amount", "min_amount"]


def tumbling(df: DataFrame, ts: str, keys: list[str], width: int, amount: str) -> DataFrame:
    """Fixed windows of ``width`` seconds."""
    window = F.window(F.col(ts), f"{width} seconds").alias("_w")
    return (
        df.groupBy(*keys, window)
        .agg(*measures(F.col(amount)))
        .select(
            *keys,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *RESULT_COLUMNS,
        )
    )


def sliding(df: DataFrame, ts: str, keys: list[str], width: int, slide: int, amount: str) -> DataFrame:
    """Overlapping windows of ``width`` seconds that start every ``slide`` seconds.

    Rows are reduced to panes of one slide first and only the panes are copied
    into the ``width / slide`` windows they belong to, instead of every row.
    """
    if width % slide:
        raise ValueError("width must be a multiple of slide")
    value = F.coalesce(F.col(amount), F.lit(0.0))
    panes = df.groupBy(*keys, F.window(F.col(ts), f"{slide} seconds").alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(money(value)).alias("_sum"),
        F.max(value).alias("_max"),
        F.min(value).alias("_min"),
    )
    starts = F.sequence(
        F.col("_p.start") - seconds(width - slide), F.col("_p.start"), seconds(slide)
    )
    total = as_double(F.sum("_sum"))
    return (
        panes.withColumn("window_start", F.explode(starts))
        .groupBy(*keys, "window_start")
        .agg(
            F.sum("_n").alias("transaction_count"),
            total.alias("total_amount"),
            (total / F.sum("_n")).alias("avg_amount"),
            F.max("_max").alias("max_amount"),
            F.min("_min").alias("min_amount"),
        )
        .select(
            *keys,
            "window_start",
            (F.col("window_start") + seconds(width)).alias("window_end"),
            *RESULT_COLUMNS,
        )
    )


def window_messages(windows: DataFrame, event_type: str = "event_type") -> DataFrame:
    """Window rows in the shape that is published: text bounds, whole amounts."""
    amounts = ["total_amount", "avg_amount", "max_amount", "min_amount"]
    return windows.select(
        F.col(event_type).alias("event_type"),
        iso_millis(F.col("window_start")).alias("window_start"),
        iso_millis(F.col("window_end")).alias("window_end"),
        "transaction_count",
        *[F.round(F.col(c), 0).cast("decimal(38,0)").alias(c) for c in amounts],
    )


def sessions(
    df: DataFrame, ts: str, key: str, gap: int, amount: str, with_last: bool = False
) -> DataFrame:
    """Sessions of one key separated by more than ``gap`` seconds of silence.

    Two rows in the same gap-wide time slot are always in one session, so rows
    are first reduced to one summary per key and slot (with partial aggregation,
    so a hot key spreads by time); only the summaries are put in order. Their
    number per key is bounded by the time span divided by the gap.
    """
    slots = df.groupBy(F.col(key), F.window(F.col(ts), f"{gap} seconds").alias("_slot")).agg(
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(money(F.col(amount))).alias("_sum"),
    )
    in_order = Window.partitionBy(key).orderBy("_first")
    previous = F.lag("_last").over(in_order)
    starts = F.when(previous.isNull() | (F.col("_first") > previous + seconds(gap)), 1).otherwise(0)
    numbered = slots.withColumn("_new", starts).withColumn(
        "_session", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    out = numbered.groupBy(key, "_session").agg(
        F.min("_first").alias("session_start"),
        F.max("_last").alias("_end"),
        F.sum("_n").alias("tx_count"),
        F.coalesce(as_double(F.sum("_sum")), F.lit(0.0)).alias("total_amount"),
    )
    last = [F.col("_end").alias("last_event")] if with_last else []
    return out.select(
        key,
        "session_start",
        (F.col("_end") + seconds(gap)).alias("session_end"),
        "tx_count",
        "total_amount",
        *last,
    )


def inactivity_gaps(df: DataFrame, ts: str, key: str, gap: int) -> DataFrame:
    """Stretches of more than ``gap`` seconds without a row of the key: exactly
    the silences between two neighbouring sessions."""
    found = sessions(df.withColumn("_one", F.lit(0.0)), ts, key, gap, "_one", with_last=True)
    following = F.lead("session_start").over(Window.partitionBy(key).orderBy("session_start"))
    return (
        found.withColumn("resumed_at", following)
        .filter(F.col("resumed_at").isNotNull())
        .select(
            key,
            F.col("last_event").alias("silent_since"),
            "resumed_at",
            F.timestamp_diff("SECOND", F.col("last_event"), F.col("resumed_at")).alias("silent_seconds"),
        )
    )


def session_text(rows: DataFrame, key: str) -> DataFrame:
    """One readable line per session."""
    return rows.select(
        F.format_string(
            "user=%s | session=[%s, %s] | count=%d | total=%.0f",
            F.col(key).cast("string"),
            iso_millis(F.col("session_start")),
            iso_millis(F.col("session_end")),
            F.col("tx_count"),
            F.col("total_amount"),
        ).alias("line")
    )
