"""Per-user fraud rules over an unbounded stream.

State is keyed by group of users and time block instead of user alone: rows near the end
of a block are sent to the next block too, as context. A very busy user then spreads over
several keys, a block's state can go once the watermark has left it, and a key that is
called up has the rows of many users to work off at once.
Rules and alert records are column expressions on the result of the processor.

``AlertBatches`` gives the same alerts from a batch handler without any Python in
the tasks; it suits high volume and catching up, the processor low latency.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txlake.functions.times import floor_to, micros
from txlake.operators import trailing
from txlake.operators.fraud import AlertRules, explode_alerts
from txlake.operators.lateness import Lateness
from txlake.streaming.sinks import forget, previous_batch, write_batch

SECOND = 1_000_000

# Users are dealt over so many keys, and a block lasts so many spans: one call of the processor
# costs much the same for one row and for thousands, so a key gathers the rows of many users.
USER_GROUPS = 64
BLOCK_SPANS = 30

# Events of one entry of the state.
PACKED_ROWS = 1 << 17

COLUMNS = {"user": "int64", "at": "int64", "id": "int64", "amount": "float64"}
EVENTS = T.StructType([T.StructField(n, T.BinaryType()) for n in COLUMNS])
TOTALS_SCHEMA = (
    "user_id BIGINT, id BIGINT, at BIGINT, amount DOUBLE, trailing_count BIGINT, trailing_total DOUBLE"
)


class TrailingTotals(StatefulProcessor):
    """Keeps the events of the last ``span`` seconds of one (group of users, block) key."""

    def __init__(self, span: int, width: int):
        self.span, self.width = span * SECOND, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", EVENTS)

    def _known(self) -> list[pd.DataFrame]:
        return [
            pd.DataFrame({n: np.frombuffer(data, kind) for (n, kind), data in zip(COLUMNS.items(), entry)})
            for entry in self.recent.get()
        ]

    def _keep(self, events: pd.DataFrame) -> None:
        arrays = [events[n].to_numpy(kind) for n, kind in COLUMNS.items()]
        starts = range(0, len(events), PACKED_ROWS)
        self.recent.put([tuple(a[i : i + PACKED_ROWS].tobytes() for a in arrays) for i in starts])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self._known()
        if not known:
            # One clean-up timer per key, two spans after the block has ended.
            self.handle.registerTimer((key[1] + self.width + 2 * self.span) // 1000)
        old = [k.assign(home=-1) for k in known]
        events = pd.concat([*old, *(r[[*COLUMNS, "home"]] for r in rows)])
        events = events.sort_values(["user", "at", "id"], kind="stable")

        user, at, home = (events[n].to_numpy("int64") for n in ("user", "at", "home"))
        amount = events["amount"].to_numpy("float64")
        # Extended precision: a running sum of the block loses nothing that shows.
        money = np.where(np.isfinite(amount), amount, 0.0).astype("longdouble")
        counts, sums = np.ones(len(events), "int64"), money.copy()
        firsts = np.flatnonzero(np.diff(user, prepend=user[:1] - 1))
        lasts = np.append(firsts[1:], len(user))
        # Each user's sums run by themselves; a single row is its own total.
        several = lasts - firsts > 1
        for a, b in zip(firsts[several].tolist(), lasts[several].tolist()):
            running = np.concatenate([np.zeros(1, "longdouble"), np.cumsum(money[a:b])])
            here = np.arange(1, b - a + 1)
            oldest = np.searchsorted(at[a:b], at[a:b] - self.span, side="left")
            counts[a:b] = here - oldest
            sums[a:b] = running[here] - running[oldest]
        totals = np.round(sums.astype("float64"), 6)

        # Rows behind the watermark no longer arrive, so older context is not needed.
        needed = at >= timerValues.getCurrentWatermarkInMs() * 1000 - self.span
        if needed.any():
            self._keep(events[needed])
        elif known:
            self.recent.clear()

        out = home == 1
        if out.any():
            yield pd.DataFrame(
                {
                    "user_id": user[out],
                    "id": events["id"].to_numpy("int64")[out],
                    "at": at[out],
                    "amount": amount[out],
                    "trailing_count": counts[out],
                    "trailing_total": totals[out],
                }
            )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # The watermark has left the block: none of its rows can arrive any more.
        self.recent.clear()
        return iter([])

    def close(self) -> None:
        pass


# Ship the processor with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def trailing_totals(
    df: DataFrame, key: str, ts: str, row_id: str, amount: str, span: int, block: int | None = None
) -> DataFrame:
    """Streaming form of ``operators.trailing.trailing_totals``; ``df`` carries a
    watermark on ``ts``."""
    width = (block or BLOCK_SPANS * span) * SECOND
    at = micros(F.col(ts))
    user = F.col(key).cast("bigint")
    home = floor_to(at, width)
    near_end = at >= home + (width - span * SECOND)
    blocks = F.when(near_end, F.array(home, home + width)).otherwise(F.array(home))
    placed = df.filter(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(user), F.lit(USER_GROUPS)).alias("users"),
        F.explode(blocks).alias("block"),
        user.alias("user"),
        F.col(ts),
        at.alias("at"),
        F.col(row_id).cast("bigint").alias("id"),
        F.coalesce(F.col(amount), F.lit(0.0)).alias("amount"),
    )
    placed = placed.withColumn("home", (F.col("block") == floor_to(F.col("at"), width)).cast("int"))
    return placed.groupBy("users", "block").transformWithStateInPandas(
        TrailingTotals(span, width), TOTALS_SCHEMA, "Append", "EventTime"
    )


def user_alerts(
    df: DataFrame,
    rules: AlertRules = AlertRules(),
    key: str = "user_id",
    ts: str = "ts",
    row_id: str = "event_id",
    amount: str = "amount",
) -> DataFrame:
    """Alerts of all users. The amount of a single row needs no context, so every row is
    judged by it, however late; the trailing rules see the rows within the watermark, and
    ``DeadLetters`` keeps those behind it."""
    totals = trailing_totals(df, key, ts, row_id, amount, rules.span_seconds, rules.block_seconds)
    rows = totals.select(
        "user_id",
        F.col("id").alias("event_id"),
        F.timestamp_micros("at").alias("ts"),
        "amount",
        "trailing_count",
        "trailing_total",
    )
    trailing_alerts = explode_alerts(rows, rules, "user_id", "ts", "event_id", "amount")
    return trailing_alerts.filter(F.col("rule_id") != "RULE-002").unionByName(
        alone(df.filter(F.col(key).isNotNull()), rules, key, ts, row_id, amount)
    )


def alone(df: DataFrame, rules: AlertRules, key: str, ts: str, row_id: str, amount: str) -> DataFrame:
    """Alerts that rows raise without any context: those of the single amount."""
    rows = df.withColumns({"trailing_count": F.lit(0).cast("bigint"), "trailing_total": F.lit(0.0)})
    alerts = explode_alerts(rows, rules, key, ts, row_id, amount)
    return alerts.filter(F.col("rule_id") == "RULE-002")


class BehindNewest:
    """The newest event time of each batch, and which rows lag behind that of earlier ones."""

    def __init__(self, path: str, disorder: Lateness):
        self.path, self.delay = path.rstrip("/"), disorder.disorder

    @property
    def dead_letters(self) -> str:
        return f"{self.path}/dead_letters"

    def newest_before(self, spark, batch_id: int) -> int | None:
        last = previous_batch(spark, f"{self.path}/marks", batch_id)
        return spark.read.schema("newest BIGINT").json(last).first()[0] if last else None

    def is_late(self, newest: int | None) -> Column:
        if newest is None:
            return F.lit(False)
        return F.coalesce(micros(F.col("ts")) < newest - self.delay * SECOND, F.lit(False))

    def mark(self, rows: DataFrame, newest: int | None, batch_id: int) -> int | None:
        """Write the newest event time so far; folders that no replay can need go."""
        spark = rows.sparkSession
        top = rows.agg(F.max(micros(F.col("ts")))).first()[0]
        newest = max((v for v in (newest, top) if v is not None), default=None)
        spark.createDataFrame([(newest,)], "newest BIGINT").write.mode("overwrite").json(
            f"{self.path}/marks/batch={batch_id}"
        )
        forget(spark, f"{self.path}/marks", batch_id)
        return newest


class DeadLetters(BehindNewest):
    """Batch handler that keeps the rows behind the watermark of a stateful query.

    It runs on the same source; rows count as late as there, by the newest event time of
    earlier batches less the delay.
    """

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        newest = self.newest_before(batch.sparkSession, batch_id)
        write_batch(batch.filter(self.is_late(newest)), self.dead_letters, batch_id)
        self.mark(batch, newest, batch_id)


class AlertBatches(BehindNewest):
    """Batch handler: alerts of each micro-batch, from built-in operators only.

    Rows are judged with the rows of the last span seconds as context. Context reaches
    back ``disorder`` seconds behind the newest event: later rows than that are judged by
    their amount alone, and written to ``dead_letters`` as well. All folders carry the
    batch number, so a replayed batch reads and writes the same ones; the micro-batch is
    read once, into a folder of its own.
    """

    def __init__(self, path: str, rules: AlertRules = AlertRules(), disorder: Lateness = Lateness()):
        super().__init__(path, disorder)
        self.rules = rules

    @property
    def alerts(self) -> str:
        return f"{self.path}/alerts"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, names = batch.sparkSession, ("user_id", "ts", "event_id", "amount")
        write_batch(batch.filter(F.col("user_id").isNotNull()).select(*names), f"{self.path}/arrived", batch_id)
        rows = spark.read.parquet(f"{self.path}/arrived/batch={batch_id}")
        newest = self.newest_before(spark, batch_id)
        # The context is written last, so its folder stands for a finished batch.
        last = previous_batch(spark, f"{self.path}/context", batch_id)
        context = spark.read.schema(rows.schema).parquet(last) if last else spark.createDataFrame([], rows.schema)
        late = rows.filter(self.is_late(newest))
        rows = rows.filter(~self.is_late(newest))
        both = context.withColumn("_fresh", F.lit(False)).unionByName(rows.withColumn("_fresh", F.lit(True)))
        totals = trailing.trailing_totals(
            both, "user_id", "ts", "event_id", "amount", self.rules.span_seconds, self.rules.block_seconds, None
        )
        found = explode_alerts(totals.filter("_fresh"), self.rules, "user_id", "ts", "event_id", "amount")
        found = found.unionByName(alone(late, self.rules, "user_id", "ts", "event_id", "amount"))
        write_batch(found, self.alerts, batch_id)
        write_batch(late, self.dead_letters, batch_id)

        newest = self.mark(rows, newest, batch_id)
        keep: Column = F.lit(True)
        if newest is not None:
            keep = micros(F.col("ts")) >= newest - (self.delay + self.rules.span_seconds) * SECOND
        write_batch(both.drop("_fresh").filter(keep), f"{self.path}/context", batch_id)
        forget(spark, f"{self.path}/context", batch_id)
        forget(spark, f"{self.path}/arrived", batch_id)
