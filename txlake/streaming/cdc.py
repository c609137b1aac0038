"""Continuous application of a change feed to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators.cdc import apply_changes
from txlake.sources.files import decode_json
from txlake.sources.versioned import VersionedTable
from txlake.streaming.sinks import MergedView


def decode_changes(topic: DataFrame, schema) -> DataFrame:
    """Topic rows -> change rows; tombstones (null values) are dropped, the topic
    position stays as a tie-breaker between changes of the same source time."""
    rows = decode_json(topic.filter(F.col("value").isNotNull()), F.col("value"), schema)
    return rows.filter(F.col("_corrupt").isNull()).select(
        *[f"data.{name}" for name in schema.names],
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
    )


class ApplyChanges:
    """Batch handler: last change wins, deletes become flags (or go, on request).

    A batch only writes its own changes; ``state`` applies the changes since the
    last fold to the folded table. Later batches win over earlier ones.
    """

    def __init__(
        self,
        table: VersionedTable,
        keys: list[str],
        order: list[str],
        applied_at: Column | None = None,
        hard_delete: bool = False,
        fold_every: int = 50,
    ):
        self.applied_at = applied_at

        def combine(base: DataFrame | None, changes: DataFrame) -> DataFrame:
            rows = changes.withColumn("_batch", F.col("batch").cast("bigint")).drop("batch")
            order_all, extras = ["_batch", *order], ("_batch", "_applied_at")
            return apply_changes(base, rows, keys, order_all, F.col("_applied_at"), hard_delete, extras)

        self.view = MergedView(table, combine, fold_every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        at = F.current_timestamp() if self.applied_at is None else self.applied_at
        self.view.add(batch.withColumn("_applied_at", at), batch_id)

    def state(self) -> DataFrame:
        return self.view.read()
