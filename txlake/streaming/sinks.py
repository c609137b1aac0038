"""Sinks. Files are written exactly once: the built-in file sink keeps its own
commit log, and batch handlers write into one folder per batch, which a replayed
batch overwrites with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txlake.sources import fs, kafka
from txlake.sources.versioned import VersionedTable


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Continuous with an interval, or until everything available is read."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def to_files(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", path).outputMode("append")
    return _triggered(writer.option("checkpointLocation", checkpoint), every).start()


def to_console(df: DataFrame, mode: str = "update") -> DataStreamWriter:
    """For debugging."""
    return df.writeStream.format("console").outputMode(mode).option("truncate", "false")


def to_memory(df: DataFrame, name: str, mode: str = "append") -> DataStreamWriter:
    """For tests; the result is a temporary view on the driver."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode)


def to_batches(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "10 seconds",
    mode: str = "append",
) -> StreamingQuery:
    """Call ``handle(batch, batch_id)`` per micro-batch; offsets are committed after it."""
    writer = df.writeStream.foreachBatch(handle).outputMode(mode)
    return _triggered(writer.option("checkpointLocation", checkpoint), every).start()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent write of one batch."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(name.split("=")[1]) for name in fs.folders(spark, path, 1)] if fs.exists(spark, path) else []


def previous_batch(spark: SparkSession, path: str, batch_id: int) -> str | None:
    """Folder of the newest batch before ``batch_id``, none for the first one.

    Fails if what an older batch left has been deleted: a replay from so far back would
    take the wrong state for the first one.
    """
    known = _numbers(spark, path)
    earlier = [n for n in known if n < batch_id]
    if not earlier and batch_id > 0 and any(n > batch_id for n in known):
        raise RuntimeError(f"{path} no longer holds what batch {batch_id} starts from")
    return f"{path}/batch={max(earlier)}" if earlier else None


def forget(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete the folders that no replay reads: Spark can go back as many batches as it retains."""
    retained = int(spark.conf.get("spark.sql.streaming.minBatchesToRetain", "100"))
    for n in _numbers(spark, path):
        if n < batch_id - retained - 1:
            fs.delete_folder(spark, f"{path}/batch={n}")


def drain(*queries: StreamingQuery, timeout: int | None = None) -> None:
    """Wait until queries over available input have ended; raise if one failed.

    Without a limit in seconds it waits as long as a backlog takes.
    """
    for q in queries:
        if timeout is None:
            q.awaitTermination()
            continue
        ended = q.awaitTermination(timeout)
        if not ended:
            q.stop()
            raise TimeoutError(f"stream {q.id} did not end within {timeout} s")


class MergedView:
    """A keyed view that a stream keeps up to date at the cost of its batches.

    Each micro-batch adds one small folder (a replay overwrites it). Reading
    combines the last folded version with the folders after it; every
    ``fold_every`` batches the combination becomes the new version, so neither a
    batch nor a read works through the whole history.
    """

    def __init__(
        self,
        table: VersionedTable,
        combine: Callable[[DataFrame | None, DataFrame], DataFrame],
        fold_every: int = 50,
    ):
        self.table, self.combine, self.fold_every = table, combine, fold_every
        self._parts = f"{table.path}/batches"

    def add(self, part: DataFrame, batch_id: int) -> None:
        if batch_id <= self.folded():
            return
        write_batch(part, self._parts, batch_id)
        if (batch_id + 1) % self.fold_every == 0:
            self.fold(batch_id)

    def folded(self) -> int:
        """Last batch that is part of the folded version, -1 before the first."""
        return self.table.metrics()["batch"] if self.table.exists() else -1

    def pending(self) -> list[int]:
        spark = self.table.spark
        names = fs.folders(spark, self._parts, 1) if fs.exists(spark, self._parts) else []
        return sorted(n for n in (int(name.split("=")[1]) for name in names) if n > self.folded())

    def read(self) -> DataFrame:
        base = self.table.read() if self.table.exists() else None
        waiting = self.pending()
        if not waiting:
            if base is None:
                raise FileNotFoundError(f"no batch has reached {self.table.path}")
            return base
        paths = [f"{self._parts}/batch={n}" for n in waiting]
        return self.combine(base, self.table.spark.read.option("basePath", self._parts).parquet(*paths))

    def fold(self, batch_id: int) -> None:
        self.table.overwrite(self.read(), operation="FOLD", metrics={"batch": batch_id})

    def clean(self) -> int:
        """Delete batch folders that a folded version contains."""
        spark, done = self.table.spark, self.folded()
        old = [n for n in fs.folders(spark, self._parts, 1) if int(n.split("=")[1]) <= done]
        for name in old:
            fs.delete_folder(spark, f"{self._parts}/{name}")
        return len(old)


class KeyedResults:
    """Batch handler for results that a stream in update mode emits again and again.

    Each emission of a key replaces the one before; the view also counts them. A replayed
    batch overwrites its own folder, so it counts once. ``last`` says which of several
    emissions of one batch comes last, as sort columns that put it first.
    """

    def __init__(self, table: VersionedTable, keys: list[str], last: tuple[Column, ...] = (), fold_every: int = 50):
        self.keys, self.last = keys, last
        self.view = MergedView(table, self._newest, fold_every)

    def _newest(self, base: DataFrame | None, parts: DataFrame) -> DataFrame:
        fresh = parts.withColumns({"_batch": F.col("batch").cast("bigint"), "emissions": F.lit(1).cast("bigint")}).drop("batch")
        rows = fresh if base is None else base.unionByName(fresh)
        of_key = Window.partitionBy(*self.keys)
        return (
            rows.withColumn("emissions", F.sum("emissions").over(of_key))
            .withColumn("_rank", F.row_number().over(of_key.orderBy(F.desc("_batch"), *self.last)))
            .filter("_rank = 1")
            .drop("_rank")
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.view.add(batch, batch_id)

    def read(self) -> DataFrame:
        """The last emission of every key, with the number of its emissions."""
        return self.view.read().drop("_batch")


class TopicBatches:
    """Batch handler that sends each micro-batch to topics as messages with ids.

    A replayed batch sends the same ids again, so readers see every message once
    (``kafka.without_repeats``), although the sink itself may write it twice.
    """

    def __init__(
        self,
        stream: str,
        frame: Callable[[DataFrame], DataFrame],
        write: Callable[[DataFrame], None],
    ):
        self.stream, self.frame, self.write = stream, frame, write

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(kafka.identified(self.frame(batch), self.stream, batch_id))
