"""Counts and profiles of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.money import percent


def count_by(df: DataFrame, *keys: Column | str, name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, in one pass."""
    one_row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
            for i, c in enumerate(df.columns)
        ]
    )
    return one_row.select(F.inline(entries), F.col("_rows").alias("row_count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables as one relation."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def counts_with_total(df: DataFrame, key: str, total_label: str = "TOTAL") -> DataFrame:
    """Counts per value plus the overall count, from one pass over the rows."""
    per_key = count_by(df, F.col(key).alias("label"))
    total = per_key.agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("row_count"))
    return per_key.unionByName(total.select(F.lit(total_label).alias("label"), "row_count"))


def active_share(df: DataFrame, group: str, active: Column) -> DataFrame:
    """Size of each group and the share of active members in percent."""
    n = F.count(F.lit(1))
    return df.groupBy(group).agg(
        n.alias("customers"), percent(F.count_if(active), n).alias("active_pct")
    )


def key_partition_check(df: DataFrame, key: str, partition: Column) -> DataFrame:
    """Keys that were seen on more than one partition; none in a sound topic."""
    per_key = (
        df.withColumn("_partition", partition)
        .groupBy(key)
        .agg(F.count_distinct("_partition").alias("partitions"))
    )
    return per_key.filter(F.col("partitions") > 1)


def keys_per_partition(df: DataFrame, key: str, partition: Column) -> DataFrame:
    return (
        df.withColumn("partition_id", partition)
        .groupBy("partition_id")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_keys"))
    )


def expectations(counts: DataFrame, minimum: dict[str, int]) -> DataFrame:
    """Required minimum row counts next to the actual ones (missing table = 0)."""
    wanted = counts.sparkSession.createDataFrame(
        list(minimum.items()), "table_name STRING, expected_min BIGINT"
    )
    joined = wanted.join(counts, "table_name", "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0).cast("bigint"))
    )
    return joined.withColumn("reached", F.col("row_count") >= F.col("expected_min"))
