"""Idle topic partitions, in batch and in streams, against plain versions."""

import collections
import datetime as dt
import random

import pytest

from txlake.operators import lateness
from txlake.streaming import sinks
from txlake.streaming.late import LateSplit

T0 = dt.datetime(2024, 3, 5, 12)
SECOND = 1_000_000


def plain_late(rows, width, slide, delay, idle):
    """rows: (id, event second, arrival, partition). The watermark is recomputed at every moment."""
    start = min(r[2] for r in rows)
    moments = sorted({r[2] for r in rows} | ({r[2] + idle for r in rows} | {start + idle} if idle else set()))
    partitions = {r[3] for r in rows}
    by_arrival = sorted(rows, key=lambda r: r[2])
    newest, heard, n, mark, marks = {}, dict.fromkeys(partitions, start), 0, None, []
    for moment in moments:
        while n < len(by_arrival) and by_arrival[n][2] <= moment:
            _, second, arrival, p = by_arrival[n]
            newest[p] = max(newest.get(p, second), second)
            heard[p] = arrival
            n += 1
        awake = [p for p in partitions if idle is None or heard[p] + idle > moment]
        if awake and all(p in newest for p in awake):
            low = min(newest[p] for p in awake)
            mark = low if mark is None else max(mark, low)
        marks.append((moment, mark))
    late = set()
    for i, second, arrival, _ in rows:
        met = [m for at, m in marks if at < arrival]
        end = second // slide * slide + width
        if met and met[-1] is not None and end <= met[-1] - delay:
            late.add(i)
    return late


@pytest.mark.parametrize("idle", [None, 40, 300])
@pytest.mark.parametrize("slot_steps", [1, 7, 50_000])
def test_late_rows_with_silent_partitions(spark, monkeypatch, idle, slot_steps):
    monkeypatch.setattr(lateness.combined_mark, "__defaults__", (slot_steps,))
    draw = random.Random(f"{idle}-{slot_steps}")
    rows, second = [], 0
    for n in range(400):
        second += draw.choice([0, 1, 2, 5, 20])
        p = draw.choice([0, 0, 0, 1, 2, 3])
        # Partition 2 is silent in the middle, partition 3 at first.
        if (p == 2 and 600 < second < 1500) or (p == 3 and second < 900):
            continue
        rows.append((n, second - draw.choice([0, 0, 3, 30, 200, 500]), second, p))
    rows = [(i, max(0, s), a, p) for i, s, a, p in rows]
    data = [(i, T0 + dt.timedelta(seconds=s), a, p) for i, s, a, p in rows]
    df = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, arrival long, part int").repartition(3)
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    plain = [(i, base + s, a, p) for i, s, a, p in rows]
    marked = lateness.mark_late(df, "ts", "arrival", "part", {"w": (60, 60), "s": (60, 20)}, idle=idle).collect()
    for name, (width, slide) in {"w": (60, 60), "s": (60, 20)}.items():
        got = {r.event_id for r in marked if name in r.late_for}
        assert got == plain_late(plain, width, slide, 15, idle)
    assert len(marked) == len(rows)


def test_a_silent_partition_lets_go(spark):
    rows = [(1, T0, 0, 1), (2, T0 + dt.timedelta(seconds=30), 1, 0)]
    rows += [(10 + n, T0 + dt.timedelta(minutes=10 * n), 600 * n, 0) for n in range(1, 20)]
    rows.append((99, T0, 600 * 19 + 1, 0))
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, arrival long, part int")

    def late(idle):
        marked = lateness.mark_late(df, "ts", "arrival", "part", {"w": (300, 300)}, idle=idle)
        return [r.event_id for r in marked.filter("size(late_for) > 0").collect()]

    assert late(None) == [] and late(60) == [99]


def test_steps_grow_with_the_rows_and_not_with_the_span(spark):
    """Two rows years apart on each of 50 partitions: a step for each, not one for each window between."""
    rows = [(p, 86_400 * SECOND * 365 * k, 300 * k) for p in range(50) for k in (1, 9)]
    df = spark.createDataFrame(rows, "_p int, _arrival long, _closes long")
    assert lateness._steps(df, 60 * SECOND).count() <= 5 * len(rows)
    assert lateness._steps(df, None).count() <= 2 * len(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], "event_id long, ts timestamp_ntz, arrival long, part int")
    assert lateness.mark_late(df, "ts", "arrival", "part", {"w": (300, 300)}, idle=5).count() == 0


# Streams


def feed(spark, split, batches, clock, monkeypatch):
    for n, (rows, now) in enumerate(zip(batches, clock)):
        monkeypatch.setattr("txlake.streaming.late.time.time", lambda now=now: now)
        split(spark.createDataFrame(rows, "event_id long, ts timestamp, part string"), n)


def late_ids(spark, split):
    return sorted(r.event_id for r in spark.read.parquet(split.dead_letters).collect())


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_a_long_batch_makes_nothing_idle(spark, root, monkeypatch):
    split = LateSplit(f"{root}/split", "ts", "part", 300, rule=lateness.Lateness(0, 0), idle=60)
    batches = [[(1, at(0), "slow"), (2, at(60), "fast")], [(3, at(1), "slow"), (4, at(61), "fast")], [(5, at(2), "slow")]]
    feed(spark, split, batches, [1000, 2000, 3000], monkeypatch)
    assert late_ids(spark, split) == []


def test_all_partitions_idle_keeps_the_mark(spark, root, monkeypatch):
    split = LateSplit(f"{root}/split", "ts", "part", 300, rule=lateness.Lateness(0, 0), idle=60)
    batches = [[(1, at(0), "slow"), (2, at(60), "fast")], [], [], [(3, at(1), "slow")], [(4, at(2), "slow")]]
    feed(spark, split, batches, [1000, 1100, 1300, 1400, 1500], monkeypatch)
    assert late_ids(spark, split) == []


def test_a_partition_that_wakes_up_reopens_nothing(spark, root, monkeypatch):
    split = LateSplit(f"{root}/split", "ts", "part", 300, rule=lateness.Lateness(0, 0), idle=60)
    batches = [
        [(1, at(0), "slow"), (2, at(60), "fast")],
        [(3, at(61), "fast")],
        [(4, at(1), "slow"), (5, at(62), "fast")],
        [(6, at(2), "slow")],
    ]
    feed(spark, split, batches, [1000, 1100, 1200, 1300], monkeypatch)
    # By the third batch the slow partition has been silent for 100 s; later it holds nothing back.
    assert late_ids(spark, split) == [4, 6]


@pytest.mark.parametrize("replayed", [1, 2, 3])
def test_replay_of_an_older_batch_changes_nothing(spark, root, monkeypatch, replayed):
    split = LateSplit(f"{root}/split", "ts", "part", 300, 60, idle=60)
    batches = [[(n, at(30 * n), "a"), (100 + n, at(0), "a")] for n in range(6)]
    feed(spark, split, batches, [1000 + 10 * n for n in range(6)], monkeypatch)
    before = collections.Counter((r.event_id, r.late_for) for r in spark.read.parquet(split.dead_letters).collect())
    monkeypatch.setattr("txlake.streaming.late.time.time", lambda: 9999)
    split(spark.createDataFrame(batches[replayed], "event_id long, ts timestamp, part string"), replayed)
    after = collections.Counter((r.event_id, r.late_for) for r in spark.read.parquet(split.dead_letters).collect())
    assert before == after and sum(before.values()) == 8


def test_a_replay_from_too_far_back_fails(spark, root, monkeypatch):
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    try:
        split = LateSplit(f"{root}/split", "ts", "part", 300)
        batches = [[(n, at(30 * n), "a")] for n in range(7)]
        feed(spark, split, batches, range(7), monkeypatch)
        with pytest.raises(RuntimeError, match="no longer holds"):
            sinks.previous_batch(spark, f"{root}/split/ledger", 3)
        assert sinks.previous_batch(spark, f"{root}/split/ledger", 5).endswith("batch=4")
    finally:
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")
