"""Following records and sources through the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.text import json_value


def trace(layers: dict[str, tuple[DataFrame, Column]], record_ids: list[str]) -> DataFrame:
    """Where given records occur: one row per layer and occurrence.

    ``layers`` maps a layer name to its table and the column that holds the
    record id there. The ids are pushed into every scan as a plain predicate.
    """
    out = None
    for name, (df, record_id) in layers.items():
        wanted = df.filter(record_id.isin(*record_ids))
        found = wanted.select(
            F.lit(name).alias("layer"),
            record_id.cast("string").alias("record_id"),
            json_value(*df.columns).alias("document"),
        )
        out = found if out is None else out.unionByName(found)
    return out


def layer_presence(layers: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """For every record: how often it occurs in each layer."""
    out = None
    for name, (df, record_id) in layers.items():
        one = df.select(
            record_id.cast("string").alias("record_id"),
            *[F.lit(1 if n == name else 0).alias(f"in_{n}") for n in layers],
        )
        out = one if out is None else out.unionByName(one)
    return out.groupBy("record_id").agg(
        *[F.sum(f"in_{n}").cast("bigint").alias(f"in_{n}") for n in layers]
    )


def activity(df: DataFrame, source: str, at: str) -> DataFrame:
    """Rows per source with first and last sighting."""
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(at).alias("first_seen"),
        F.max(at).alias("last_seen"),
    )
