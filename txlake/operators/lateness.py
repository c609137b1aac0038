"""Late rows of a bounded, replayed stream.

A window is closed for good once the watermark passes its end plus the allowed
lateness; a row that arrives after that is late. Each topic partition has a
watermark of its own, the newest event time that arrived on it, and the slowest
partition that isn't idle counts. A partition is idle while nothing has arrived on
it for a while; what has been closed stays closed.

Nothing runs over all rows in arrival order. Per partition, rows are reduced to
the moments when its watermark passes a grid point and to its stretches without
silence: a step function of few steps, whose number is bounded by the rows and by
the time span alike. The steps of all partitions are dealt out by time, each slot
starting with the state of every partition, and a slot's minimum over partitions is
found by one pass with a heap. There are no more slots than steps per partition,
so the states at their starts are no more rows than the steps. From the minimum
follows when each window end was closed, and every row is compared with that.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import reduce
from math import gcd

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from txlake.functions.text import labels
from txlake.functions.times import floor_to, micros, seconds
from txlake.operators.windows import RESULT_COLUMNS, measures
from txlake.session import scratch

SECOND = 1_000_000

# Steps of one slot, on average.
SLOT_STEPS = 50_000

# Grid points that stand together when closings are carried to earlier window ends.
GRID_BLOCK = 4096

BEFORE_ALL = -(1 << 62)


@dataclass(frozen=True)
class Lateness:
    """Accepted disorder and extra lateness in seconds (fixed values as defaults)."""

    disorder: int = 5
    allowed: int = 10

    @property
    def closing_delay(self) -> int:
        return self.disorder + self.allowed


def grid_end(at: Column, slide: int) -> Column:
    """End, in seconds, of the first window (on a grid of ``slide``) that ends after ``at``."""
    return (floor_to(at, slide * SECOND) / SECOND).cast("bigint") + slide


def _stretches(rows: DataFrame, idle: int) -> DataFrame:
    """(_p, _start, _end): when each partition isn't idle. It falls idle ``idle`` after its last arrival.

    Arrivals are reduced to one row per partition and slot of the idle time first: two of
    one slot are never further apart than that.
    """
    slots = (
        rows.groupBy("_p", F.floor(F.col("_arrival") / idle).alias("_slot"))
        .agg(F.min("_arrival").alias("_from"), F.max("_arrival").alias("_to"))
    )
    # All partitions wait from the first arrival of all on, so a start without rows is a silence too.
    start = F.lit(rows.agg(F.min("_arrival")).first()[0]).cast("bigint")
    known = rows.select("_p").distinct().withColumns({"_from": start, "_to": start})
    slots = slots.select("_p", "_from", "_to").unionByName(known)
    in_order = Window.partitionBy("_p").orderBy("_from", "_to")
    before = F.max("_to").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("_from") > before + idle), 1).otherwise(0)
    numbered = slots.withColumn("_n", F.sum(new).over(in_order))
    return numbered.groupBy("_p", "_n").agg(F.min("_from").alias("_start"), (F.max("_to") + idle).alias("_end")).drop("_n")


def _steps(rows: DataFrame, idle: int | None) -> DataFrame:
    """(_p, _at, _mark, _awake): state of each partition from a moment on, until its next row.

    ``_mark`` is the largest grid point that its watermark has passed, null before the first.
    """
    passed = rows.groupBy("_p", "_closes").agg(F.min("_arrival").alias("_at"))
    rise = passed.select("_p", "_at", F.col("_closes").alias("_mark"), F.lit(None).cast("boolean").alias("_awake"))
    if idle is None:
        first = rows.groupBy("_p").agg(F.lit(BEFORE_ALL).cast("bigint").alias("_at"))
        turns = first.select("_p", "_at", F.lit(True).alias("_awake"))
    else:
        found = _stretches(rows, idle)
        turns = found.select("_p", F.col("_start").alias("_at"), F.lit(True).alias("_awake")).unionByName(
            found.select("_p", F.col("_end").alias("_at"), F.lit(False).alias("_awake"))
        )
    events = rise.unionByName(turns.withColumn("_mark", F.lit(None).cast("bigint")))
    # What happens at one moment is one step.
    events = events.groupBy("_p", "_at").agg(F.max("_mark").alias("_mark"), F.max("_awake").alias("_awake"))
    so_far = Window.partitionBy("_p").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    state = events.select(
        "_p",
        "_at",
        F.max("_mark").over(so_far).alias("_mark"),
        F.last("_awake", ignorenulls=True).over(so_far).alias("_awake"),
    )
    earlier = Window.partitionBy("_p").orderBy("_at")
    same = F.lag("_mark").over(earlier).eqNullSafe(F.col("_mark")) & F.lag("_awake").over(earlier).eqNullSafe(F.col("_awake"))
    return state.withColumn("_same", F.coalesce(same, F.lit(False))).filter(~F.col("_same")).drop("_same")


def _lowest(table: pa.Table) -> pa.Table:
    """Of one slot's steps: when the lowest mark of the partitions awake grew, and to what.

    A heap holds the marks; those that no longer are their partition's state are dropped
    when they come up.
    """
    from heapq import heappop, heappush

    names = ["_at", "_p", "_mark", "_awake"]
    steps = sorted(zip(*(table.column(n).to_pylist() for n in names)), key=lambda s: s[0])
    state, heap, moments, marks = {}, [], [], []
    without, top = BEFORE_ALL, None
    for i, (at, p, mark, awake) in enumerate(steps):
        value = (without if mark is None else mark) if awake else None
        state[p] = value
        if value is not None:
            heappush(heap, (value, p))
        if i + 1 < len(steps) and steps[i + 1][0] == at:
            continue
        while heap and state[heap[0][1]] != heap[0][0]:
            heappop(heap)
        if heap and heap[0][0] != without and (top is None or heap[0][0] > top):
            top = heap[0][0]
            moments.append(at)
            marks.append(top)
    return pa.table({"_at": pa.array(moments, pa.int64()), "_mark": pa.array(marks, pa.int64())})


# Ship the pass with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def combined_mark(rows: DataFrame, idle: int | None, slot_steps: int = SLOT_STEPS) -> DataFrame:
    """(_mark, _at): when the slowest partition awake had first passed a grid point.

    ``rows`` holds _p, _arrival and _closes. Each slot reports growth from its own start
    on, so a higher mark may come earlier; the earliest moment of a mark or a higher one counts.
    """
    spark = rows.sparkSession
    path = scratch(spark, "steps")
    _steps(rows, idle).write.parquet(path)
    steps = spark.read.schema("_p INT, _at BIGINT, _mark BIGINT, _awake BOOLEAN").parquet(path)
    # Without idleness partitions are awake from before all arrivals on.
    moment = F.when(F.col("_at") > BEFORE_ALL, F.col("_at"))
    count, partitions, first, last = steps.agg(
        F.count("*"), F.count_distinct("_p"), F.min(moment), F.max(moment)
    ).first()
    if not count or first is None:
        return steps.select("_mark", "_at").limit(0)
    # With no more slots than steps a partition, the states at their starts are no more than the steps.
    slots = max(1, min(count // slot_steps, count // partitions))
    width = (last - first) // slots + 1
    slot = F.greatest(F.floor((F.col("_at") - first) / width), F.lit(0)).cast("bigint")
    placed = steps.withColumn("_slot", slot)
    following = Window.partitionBy("_p").orderBy("_at")
    until = F.coalesce(F.lead("_slot").over(following), F.lit(slots).cast("bigint") - 1)
    # The state at the start of each later slot, unless a step replaces it there.
    start = F.lit(first) + F.col("_slot") * width
    started = (
        placed.withColumns({"_until": until, "_next": F.lead("_at").over(following)})
        .filter(F.col("_until") > F.col("_slot"))
        .withColumn("_slot", F.explode(F.sequence(F.col("_slot") + 1, F.col("_until"))))
        .withColumn("_at", start)
        .filter(F.col("_next").isNull() | (F.col("_next") > F.col("_at")))
    )
    columns = ["_slot", "_p", "_at", "_mark", "_awake"]
    both = placed.select(*columns).unionByName(started.select(*columns))
    marks = both.groupBy("_slot").applyInArrow(_lowest, "_at bigint, _mark bigint")
    return marks.groupBy("_mark").agg(F.min("_at").alias("_at"))


def closing_moments(
    df: DataFrame,
    ts: str,
    arrival: str,
    partition: str,
    width: int,
    slide: int,
    delay: int,
    idle: int | None = None,
) -> DataFrame:
    """(window_end_s, closed_at): arrival after which a window end is closed.

    One row per end of a window that holds a row. ``closed_at`` is null while a topic
    partition that isn't idle has not moved past the closing point. Topic partitions are
    those of the rows; one without any row holds nothing up. ``idle`` is in the unit of
    ``arrival``; without it no partition ever counts as idle.
    """
    at = micros(F.col(ts))
    # Largest grid point that a row with this event time closes.
    closes = grid_end(at - delay * SECOND, slide) - slide
    rows = df.select(
        F.col(partition).cast("int").alias("_p"),
        F.col(arrival).cast("bigint").alias("_arrival"),
        closes.alias("_closes"),
        grid_end(at, slide).alias("_ends"),
    )
    marks = combined_mark(rows.filter(F.col("_arrival").isNotNull()), idle)
    step = F.lit(slide).cast("bigint")
    ends = (
        rows.select("_ends")
        .distinct()
        .select(F.explode(F.sequence("_ends", F.col("_ends") + (width - slide), step)).alias("_end"))
        .distinct()
    )
    both = marks.select(F.col("_mark").alias("_end"), "_at").withColumn("_wanted", F.lit(False)).unionByName(
        ends.select("_end", F.lit(None).cast("bigint").alias("_at"), F.lit(True).alias("_wanted"))
    )
    both = both.groupBy("_end").agg(F.min("_at").alias("_at"), F.max("_wanted").alias("_wanted"))
    # A mark closes all earlier ends too: those of its block of grid points, and those of the blocks before.
    both = both.withColumn("_block", F.floor(F.col("_end") / (slide * GRID_BLOCK)))
    of_block = both.groupBy("_block").agg(F.min("_at").alias("_first"))
    beyond = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = of_block.select("_block", F.min("_first").over(beyond).alias("_beyond"))
    later = Window.partitionBy("_block").orderBy(F.desc("_end")).rowsBetween(Window.unboundedPreceding, 0)
    closed = both.withColumn("_own", F.min("_at").over(later)).filter("_wanted").join(beyond, "_block")
    return closed.select(F.col("_end").alias("window_end_s"), F.least("_own", "_beyond").alias("closed_at"))


def mark_late(
    df: DataFrame,
    ts: str,
    arrival: str,
    partition: str,
    paths: dict[str, tuple[int, int]],
    rule: Lateness = Lateness(),
    idle: int | None = None,
) -> DataFrame:
    """Adds ``late_for``: the window paths, out of ``paths`` (name -> width and
    slide), for which every window of the row was closed when it arrived.

    ``arrival`` is a number that grows with arrival time (an offset or time). The
    closing moments are found once, on a grid that all window ends lie on. With
    ``idle``, in the unit of ``arrival``, a topic partition that has been silent for so
    long holds nothing up until it is heard again.
    """
    grid = reduce(gcd, [n for pair in paths.values() for n in pair])
    widest = max(width for width, _ in paths.values())
    # Written, because every window path looks its closings up in it.
    path = scratch(df.sparkSession, "closings")
    closing_moments(df, ts, arrival, partition, widest, grid, rule.closing_delay, idle).write.parquet(path)
    moments = df.sparkSession.read.schema("window_end_s BIGINT, closed_at BIGINT").parquet(path)
    at, out = micros(F.col(ts)), df
    for name, (width, slide) in paths.items():
        # The last window a row belongs to starts at its own grid point.
        last_end = grid_end(at, slide) - slide + width
        closed = moments.select(F.col("window_end_s").alias("_end"), F.col("closed_at").alias("_closed"))
        out = out.withColumn("_end", last_end).join(closed, "_end", "left")
        out = out.withColumn(f"_late_{name}", F.coalesce(F.col("_closed") < F.col(arrival), F.lit(False)))
        out = out.drop("_end", "_closed")
    flags = {name: F.col(f"_late_{name}") for name in paths}
    return out.withColumn("late_for", labels(flags)).drop(*[f"_late_{name}" for name in paths])


def windows_without_late(
    df: DataFrame,
    ts: str,
    arrival: str,
    partition: str,
    keys: list[str],
    width: int,
    amount: str,
    slide: int | None = None,
    rule: Lateness = Lateness(),
    idle: int | None = None,
) -> DataFrame:
    """Final window totals: a row counts in those of its windows that were still
    open when it arrived."""
    slide = slide or width
    first_end = grid_end(micros(F.col(ts)), slide)
    ends = F.explode(F.sequence(first_end, first_end + (width - slide), F.lit(slide).cast("bigint")))
    moments = closing_moments(df, ts, arrival, partition, width, slide, rule.closing_delay, idle)
    on_time = (
        df.withColumn("window_end_s", ends)
        .join(moments, "window_end_s", "left")
        .filter(F.col("closed_at").isNull() | (F.col("closed_at") >= F.col(arrival)))
    )
    zone_less = df.schema[ts].dataType.typeName() == "timestamp_ntz"
    kind = "timestamp_ntz" if zone_less else "timestamp"
    end = F.timestamp_seconds("window_end_s").cast(kind)
    return (
        on_time.groupBy(*keys, "window_end_s")
        .agg(*measures(F.col(amount)))
        .select(
            *keys,
            (end - seconds(width)).alias("window_start"),
            end.alias("window_end"),
            *RESULT_COLUMNS,
        )
    )


def dead_letters(marked: DataFrame) -> DataFrame:
    """Late rows of all window paths as one relation; a row that is late for two
    paths appears twice, with the path as its reason."""
    return marked.withColumn("late_for", F.explode("late_for"))
