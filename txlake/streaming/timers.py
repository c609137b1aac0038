"""Views and alerts that change because time passes, not because a row arrives.

Two stateful processors: the latest row of a key until it expires (timers on event
time), and keys that fall silent (timers on the clock).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txlake.functions.text import json_value
from txlake.functions.times import micros

# Fixed value: seconds that the latest alert of a user stays in the serving view.
EXPIRY_SECONDS = 86_400

LATEST = "user_id BIGINT, at BIGINT, row_id STRING, body STRING, expired BOOLEAN"
ACTIVITY = "user_id BIGINT, kind STRING, silent_since BIGINT, noticed_at BIGINT"


class LatestUntilExpiry(StatefulProcessor):
    """Keeps the newest row of a key; says so when it changes and when it expires."""

    def __init__(self, seconds: int):
        self.milliseconds = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "at BIGINT, row_id STRING")

    def _due(self, at: int) -> int:
        # Up to the next whole millisecond, so that nothing goes early.
        return -(-at // 1000) + self.milliseconds

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for part in rows:
            for at, row_id, body in zip(part["at"], part["row_id"], part["body"]):
                if best is None or (at, row_id) > best[:2]:
                    best = (int(at), row_id, body)
        known = self.newest.get()
        if known is not None and best[:2] <= tuple(known):
            return
        if known is not None:
            self.handle.deleteTimer(self._due(known[0]))
        self.newest.update(best[:2])
        self.handle.registerTimer(self._due(best[0]))
        yield pd.DataFrame([(key[0], *best, False)], columns=["user_id", "at", "row_id", "body", "expired"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.newest.get()
        if known is None:
            return
        self.newest.clear()
        yield pd.DataFrame(
            [(key[0], known[0], known[1], None, True)], columns=["user_id", "at", "row_id", "body", "expired"]
        )

    def close(self) -> None:
        pass


class Activity(StatefulProcessor):
    """Reports a key that has been silent for a while, once, and when it is heard again."""

    def __init__(self, seconds: int):
        self.milliseconds = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heard = handle.getValueState("heard", "at BIGINT, silent BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        now, known = int(timerValues.getCurrentProcessingTimeInMs()), self.heard.get()
        if known is not None and not known[1]:
            self.handle.deleteTimer(known[0] + self.milliseconds)
        self.heard.update((now, False))
        self.handle.registerTimer(now + self.milliseconds)
        if known is not None and known[1]:
            yield self._row(key, "resumed", known[0], now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.heard.get()
        if known is None or known[1]:
            return
        self.heard.update((known[0], True))
        yield self._row(key, "silent", known[0], int(timerValues.getCurrentProcessingTimeInMs()))

    def _row(self, key, kind: str, since: int, now: int) -> pd.DataFrame:
        return pd.DataFrame([(key[0], kind, since, now)], columns=["user_id", "kind", "silent_since", "noticed_at"])

    def close(self) -> None:
        pass


# Ship the processors with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def latest_until_expiry(
    df: DataFrame, key: str, ts: str, row_id: str, seconds: int = EXPIRY_SECONDS
) -> DataFrame:
    """Changes of the latest row per key, in update mode; ``df`` carries a watermark on ``ts``.

    A row with ``expired`` takes its key out of the view: the watermark has passed the time
    of its latest row by ``seconds``. ``body`` is the whole row as JSON.
    """
    placed = df.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("user_id"),
        F.col(ts),
        micros(F.col(ts)).alias("at"),
        F.col(row_id).cast("string").alias("row_id"),
        json_value(*df.columns).alias("body"),
    )
    return placed.groupBy("user_id").transformWithStateInPandas(
        LatestUntilExpiry(seconds), LATEST, "Update", "EventTime"
    )


def silent_keys(df: DataFrame, key: str, seconds: int) -> DataFrame:
    """Keys without a row for ``seconds`` of the clock, reported while the silence lasts."""
    heard = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("user_id"))
    return heard.groupBy("user_id").transformWithStateInPandas(
        Activity(seconds), ACTIVITY, "Update", "ProcessingTime"
    )


def body_fields(view: DataFrame, schema) -> DataFrame:
    """The rows of a view of ``latest_until_expiry`` that have not expired, with their columns again."""
    return view.filter(~F.col("expired")).select(F.from_json("body", schema).alias("row")).select("row.*")
