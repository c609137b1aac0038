"""Windowed aggregates over unbounded input.

The watermark delay is disorder plus allowed lateness: in append mode a window is
emitted once, when it can no longer change; in update mode it is emitted again
after every batch that changes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.money import exact_sum
from txlake.operators.lateness import Lateness
from txlake.operators.windows import RESULT_COLUMNS, measures


def watermarked(df: DataFrame, ts: str, rule: Lateness = Lateness()) -> DataFrame:
    """Zoned event time with the watermark of a lateness rule."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(
        ts, f"{rule.closing_delay} seconds"
    )


def follow_fastest_source(spark: SparkSession) -> None:
    """With several sources in one query, let an idle one not hold the watermark back."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")


def _unpacked(agg: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return agg.select(
        *keys,
        F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
        *names,
    )


def windowed(
    df: DataFrame, ts: str, keys: list[str], width: int, amount: str, slide: int | None = None
) -> DataFrame:
    """Tumbling windows, sliding ones with ``slide``; ``df`` carries a watermark."""
    window = F.window(ts, f"{width} seconds", f"{slide or width} seconds").alias("_w")
    return _unpacked(df.groupBy(*keys, window).agg(*measures(F.col(amount))), keys, RESULT_COLUMNS)


def sessions(df: DataFrame, ts: str, key: str, gap: int, amount: str) -> DataFrame:
    """Sessions per key; rows without key or amount do not count.

    In append mode a session is emitted when its key has been silent for ``gap``
    seconds, so the same query also reports inactivity.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(amount).isNotNull())
    agg = rows.groupBy(key, F.session_window(ts, f"{gap} seconds").alias("_w")).agg(
        F.count(F.lit(1)).alias("tx_count"), exact_sum(amount).alias("total_amount")
    )
    return _unpacked(agg, [key], ["tx_count", "total_amount"])


def distinct_events(df: DataFrame, keys: list[str]) -> DataFrame:
    """First event per key within the watermark; later repeats are dropped."""
    return df.dropDuplicatesWithinWatermark(keys)


def valid_events(df: DataFrame, types: list[str], kind: Column) -> DataFrame:
    return df.filter(kind.isin(types))
