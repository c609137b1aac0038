"""Late rows of an unbounded stream go to a dead-letter table.

Spark drops rows behind the watermark without a trace, so the split happens
before the windows: each micro-batch is compared with the watermark that all
earlier batches left behind. That watermark is written per batch (one row per
topic partition, cumulative); a replayed batch reads the same row and gives the
same split.

A topic partition that falls silent must not hold the watermark back for ever. It
is idle when the batches that began within the last ``idle`` seconds before the
previous batch began brought no row of it. Only the starts of batches are compared,
so a batch that takes long makes nothing idle, and the partitions of the previous
batch never are. What has been closed stays closed: the watermark never falls, and
while all partitions are idle it stands still. The time of each batch is written
before its work, so a replay sees the same idle partitions.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.text import labels
from txlake.functions.times import micros
from txlake.operators.lateness import Lateness, grid_end
from txlake.sources import fs
from txlake.streaming.sinks import forget, previous_batch, write_batch

SECOND = 1_000_000


class LateSplit:
    """Batch handler that writes ``on_time``, ``dead_letters`` and the ledger.

    On-time rows carry ``late_for`` too: a row may be late for the tumbling path
    and still have open sliding windows, so each path takes the rows that do not
    name it.
    """

    def __init__(
        self,
        path: str,
        ts: str,
        partition: str | None,
        width: int,
        slide: int | None = None,
        rule: Lateness = Lateness(),
        idle: int | None = 60,
    ):
        self.path, self.ts, self.partition = path.rstrip("/"), ts, partition
        self.width, self.slide, self.rule, self.idle = width, slide, rule, idle

    @property
    def on_time(self) -> str:
        return f"{self.path}/on_time"

    @property
    def dead_letters(self) -> str:
        return f"{self.path}/dead_letters"

    def _clock(self, spark: SparkSession, batch_id: int) -> int:
        """Time of the batch in seconds: that of its first run."""
        path = f"{self.path}/clock/batch={batch_id}"
        if not fs.exists(spark, f"{path}/_SUCCESS"):
            now = spark.createDataFrame([(int(time.time()),)], "now BIGINT")
            now.coalesce(1).write.mode("overwrite").json(path)
        return spark.read.schema("now BIGINT").json(path).first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = self._clock(spark, batch_id)
        part = F.col(self.partition) if self.partition else F.lit(0)
        ledger_schema = "part STRING, newest BIGINT, seen_at BIGINT, began BIGINT, mark BIGINT"
        last = previous_batch(spark, f"{self.path}/ledger", batch_id)
        if last:
            before = spark.read.schema(ledger_schema).json(last)
        else:
            before = spark.createDataFrame([], ledger_schema)
        # One value: the slowest topic partition that isn't idle, or what counted before.
        awake = F.lit(True) if self.idle is None else F.col("seen_at") >= F.col("began") - self.idle
        slowest = before.agg(F.greatest(F.min(F.when(awake, F.col("newest"))), F.max("mark"))).first()[0]
        passed = None if slowest is None else slowest - self.rule.closing_delay * SECOND

        at = micros(F.col(self.ts))

        def is_late(width: int, slide: int):
            if passed is None:
                return F.lit(False)
            last_end = (grid_end(at, slide) - slide + width) * SECOND
            return F.coalesce(last_end <= F.lit(passed), F.lit(False))

        paths = {"tumbling": (self.width, self.width)}
        if self.slide:
            paths["sliding"] = (self.width, self.slide)
        late = labels({name: is_late(*pair) for name, pair in paths.items()})
        # The micro-batch is read once; the rest works on what was written.
        write_batch(batch.withColumn("late_for", late), f"{self.path}/marked", batch_id)
        marked = spark.read.parquet(f"{self.path}/marked/batch={batch_id}")
        write_batch(marked.withColumn("late_for", F.explode("late_for")), self.dead_letters, batch_id)
        write_batch(marked.filter(F.size("late_for") < len(paths)), self.on_time, batch_id)

        seen = marked.groupBy(part.cast("string").alias("part")).agg(F.max(at).alias("newest"))
        seen = seen.withColumn("seen_at", F.lit(now).cast("bigint"))
        known = before.select("part", "newest", "seen_at").unionByName(seen).groupBy("part").agg(
            F.max("newest").alias("newest"), F.max("seen_at").alias("seen_at")
        )
        known = known.withColumns({"began": F.lit(now).cast("bigint"), "mark": F.lit(slowest).cast("bigint")})
        known.coalesce(1).write.mode("overwrite").json(f"{self.path}/ledger/batch={batch_id}")
        for name in ("marked", "clock", "ledger"):
            forget(spark, f"{self.path}/{name}", batch_id)
