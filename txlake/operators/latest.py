"""One row per key, duplicates, serving views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Newest row per key; ``order`` lists descending sort columns.

    Filtering ``row_number() = 1`` lets Spark drop the losers of each input task
    before the shuffle, so a hot key sends one row per task.
    """
    in_order = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(in_order)).filter(F.col("_rank") == 1).drop("_rank")
    )


def duplicate_excess(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys occur more than once and how many rows are too many."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return counted.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("excess_rows"),
    )


def latest_alert_per_user(alerts: DataFrame) -> DataFrame:
    return keep_latest(alerts, ["user_id"], [F.desc("detected_at"), F.desc("alert_id")])


def alert_count_per_user(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("user_id").agg(F.count(F.lit(1)).alias("alert_count"))


def most_recent(alerts: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` newest alerts; the size of this view is the feature."""
    return alerts.orderBy(F.desc("detected_at"), F.desc("alert_id")).limit(n)
