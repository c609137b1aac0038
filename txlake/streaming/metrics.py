"""Counters that a stream keeps while it runs, without a pass of their own."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Counters(StreamingQueryListener):
    """Sums of what streams observe, per name of the observation.

    ``observe`` adds the measures to the plan that the stream runs anyway; each batch
    reports its own, and this listener adds them up, one number per measure.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._sums: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(int))
        self._batches: dict[str, set] = defaultdict(set)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)
        self._lock = threading.Lock()
        spark.streams.addListener(self)

    @staticmethod
    def observe(df: DataFrame, name: str, **measures: Column) -> DataFrame:
        return df.observe(name, *[c.alias(n) for n, c in measures.items()])

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            for name, row in progress.observedMetrics.items():
                # A batch that ran again counts once.
                batch = (str(progress.id), progress.batchId)
                if batch in self._batches[name]:
                    continue
                self._batches[name].add(batch)
                for measure, value in row.asDict().items():
                    self._sums[name][measure] += value or 0

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def after(self, query: StreamingQuery, name: str, timeout: int = 60) -> dict[str, float]:
        """The sums once all batches of an ended query have reported."""
        if not self._ended[str(query.runId)].wait(timeout):
            raise TimeoutError(f"stream {query.id} has not reported its end within {timeout} s")
        with self._lock:
            return dict(self._sums[name])

    def close(self) -> None:
        self.spark.streams.removeListener(self)
