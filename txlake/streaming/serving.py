"""Keyed views kept up to date by a stream of alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.operators import latest
from txlake.plans.medallion import Lake
from txlake.streaming.sinks import MergedView, write_batch


class ServingViews:
    """Batch handler: alert table plus latest per user, count per user, newest 100."""

    def __init__(self, lake: Lake, recent: int = 100, fold_every: int = 50):
        self.alerts = f"{lake.root}/alerts"
        self.limit = recent

        def view(name, combine) -> MergedView:
            return MergedView(lake.table(f"serving/{name}"), combine, fold_every)

        def together(base: DataFrame | None, parts: DataFrame) -> DataFrame:
            parts = parts.drop("batch")
            return parts if base is None else base.unionByName(parts)

        def added(base, parts):
            return together(base, parts).groupBy("user_id").agg(F.sum("alert_count").alias("alert_count"))

        self.latest = view("latest", lambda b, p: latest.latest_alert_per_user(together(b, p)))
        self.recent = view("recent", lambda b, p: latest.most_recent(together(b, p), recent))
        self.count = view("count", added)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, self.alerts, batch_id)
        alerts = batch.sparkSession.read.schema(batch.schema).parquet(f"{self.alerts}/batch={batch_id}")
        self.latest.add(latest.latest_alert_per_user(alerts), batch_id)
        self.recent.add(latest.most_recent(alerts, self.limit), batch_id)
        self.count.add(latest.alert_count_per_user(alerts), batch_id)
