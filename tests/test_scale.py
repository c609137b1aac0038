"""Results under heavy skew, against brute force in plain Python: one key holds
more than a third of all rows, rows share times, blocks are short."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from txlake.operators import lateness, latest, quality, trailing, windows
from txlake.sources import files
from txlake.sources.versioned import VersionedTable
from txlake.streaming import fraud as fraud_stream
from txlake.streaming import sinks
from txlake.streaming import windows as stream_windows
from txlake.streaming.late import LateSplit
from txlake.operators.fraud import AlertRules, user_alerts

T0 = dt.datetime(2024, 1, 1)
N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    """(id, user, ts, amount): user 0 has about half of the rows; times collide."""
    ids = F.col("id")
    h = F.pmod(F.xxhash64("id"), F.lit(1000))
    second = F.pmod(F.xxhash64(ids + 7), F.lit(4 * 3600))
    return spark.createDataFrame(
        spark.range(N).select(
            ids.alias("event_id"),
            F.when(h < 500, 0).otherwise(F.pmod(h, F.lit(17))).cast("bigint").alias("user_id"),
            (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=second.cast("decimal(18,6)"))).alias("ts"),
            (F.pmod(F.xxhash64(ids + 13), F.lit(100_000)) / 100).alias("amount"),
        ).collect(),
        "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, amount DOUBLE",
    )


def per_user(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.user_id].append(r)
    for found in out.values():
        found.sort(key=lambda r: (r.ts, r.event_id))
    return out


@pytest.mark.parametrize("block", [60, 90, 600, 100_000])
def test_trailing_totals(spark, skewed, block):
    got = {
        r.event_id: (r.trailing_count, r.trailing_total)
        for r in trailing.trailing_totals(skewed, "user_id", "ts", "event_id", "amount", 60, block).collect()
    }
    want = {}
    for rows in per_user(skewed.collect()).values():
        for i, r in enumerate(rows):
            inside = [p for p in rows[: i + 1] if r.ts - p.ts <= dt.timedelta(seconds=60)]
            want[r.event_id] = (len(inside), round(sum(round(p.amount * 100) for p in inside) / 100, 2))
    assert got == want


@pytest.mark.parametrize("gap", [5, 30, 120])
def test_sessions(spark, skewed, gap):
    got = sorted(
        (r.user_id, r.session_start, r.tx_count, r.total_amount)
        for r in windows.sessions(skewed, "ts", "user_id", gap, "amount").collect()
    )
    want = []
    for user, rows in per_user(skewed.collect()).items():
        group = [rows[0]]
        for r in [*rows[1:], None]:
            if r is not None and r.ts - group[-1].ts <= dt.timedelta(seconds=gap):
                group.append(r)
                continue
            want.append((user, group[0].ts, len(group), round(sum(round(g.amount * 100) for g in group) / 100, 2)))
            group = [r]
    assert got == sorted(want)
    native = skewed.groupBy("user_id", F.session_window("ts", f"{gap} seconds").alias("w")).count()
    assert sorted((r[0], r[2]) for r in got) == sorted((r.user_id, r["count"]) for r in native.collect())


def test_sliding_equals_native(spark, skewed):
    ours = windows.sliding(skewed, "ts", ["user_id"], 300, 60, "amount")
    native = skewed.groupBy("user_id", F.window("ts", "300 seconds", "60 seconds").alias("w")).agg(
        F.count("*").alias("n"), F.max("amount").alias("m")
    )
    got = {(r.user_id, r.window_start, r.window_end, r.transaction_count, r.max_amount) for r in ours.collect()}
    assert got == {(r.user_id, r.w.start, r.w.end, r.n, r.m) for r in native.collect()}


def test_uniqueness_and_latest(spark, skewed):
    rules = [{"id": "U", "type": "uniqueness", "severity": "critical", "key_fields": ["user_id"]}]
    done = quality.evaluate(skewed, rules, T0, ["ts", "event_id"])
    kept = {r.event_id for r in quality.clean_rows(done).collect()}
    want = {rows[-1].event_id for rows in per_user(skewed.collect()).values()}
    assert kept == want
    assert {r.event_id for r in latest.keep_latest(skewed, ["user_id"], [F.desc("ts"), F.desc("event_id")]).collect()} == want


@pytest.mark.parametrize("partitions", [1, 3])
def test_late_rows(spark, skewed, partitions):
    rows = skewed.withColumn("part", F.pmod("user_id", F.lit(partitions)).cast("int"))
    delay = F.pmod(F.xxhash64("event_id"), F.lit(900)) * 1_000_000
    rows = rows.withColumn("arrival", F.unix_micros(F.col("ts").cast("timestamp")) + delay)
    marked = lateness.mark_late(rows, "ts", "arrival", "part", {"w": (300, 300), "s": (300, 60)})
    got = {r.event_id: set(r.late_for) for r in marked.collect()}

    data = sorted(rows.collect(), key=lambda r: r.arrival)
    epoch = dt.datetime(1970, 1, 1)

    def us(t):
        return (t - epoch) // dt.timedelta(microseconds=1)

    newest, want, pending = {}, {}, []
    for i, r in enumerate(data):
        if pending and pending[-1].arrival < r.arrival:
            for p in pending:
                newest[p.part] = max(newest.get(p.part, 0), us(p.ts))
            pending = []
        pending.append(r)
        mark = min(newest.values()) - 15_000_000 if len(newest) == partitions else None
        late = set()
        for name, slide in (("w", 300), ("s", 60)):
            end = (us(r.ts) // (slide * 1_000_000)) * slide * 1_000_000 + 300_000_000
            if mark is not None and end <= mark:
                late.add(name)
        want[r.event_id] = late
    assert got == want
    assert any(want.values())


def test_json_lines_with_hot_line(spark, root, monkeypatch):
    monkeypatch.setattr(files, "COPIES_PER_TASK_ROW", 7)
    lines = ["hot"] * 100 + [f"line {n % 30}" for n in range(60)]
    spark.createDataFrame([(v,) for v in lines], "value STRING").coalesce(1).write.text(f"{root}/in")
    table = VersionedTable(spark, f"{root}/bronze")
    for _ in range(2):
        rows = files.json_lines_bronze(spark, f"{root}/in", "t", "2024-01-01", F.lit(T0))
        table.insert_new(rows, files.FILE_BRONZE_KEYS, ["ingest_date"])
    got = table.read().groupBy("kafka_value").count().collect()
    assert sum(r["count"] for r in got) == 160
    assert {r["count"] for r in got if r.kafka_value == "hot"} == {100}


def _in_files(rows, folder, parts):
    """The rows as one file per part, in order of event time."""
    import time

    ordered = sorted(rows.collect(), key=lambda r: (r.ts, r.event_id))
    size = -(-len(ordered) // parts)
    for n in range(parts):
        piece = rows.sparkSession.createDataFrame(ordered[n * size : (n + 1) * size], rows.schema)
        piece.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


def test_stream_alerts_over_batches(spark, skewed, root):
    """Both streaming forms over four micro-batches equal the bounded result."""
    rules = AlertRules(high_amount=950.0, burst_count=3, sum_amount=1500.0, block_seconds=120)
    _in_files(skewed, f"{root}/in", 4)
    want = {r.alert_id for r in user_alerts(skewed, rules).collect()}

    def stream():
        s = spark.readStream.schema(skewed.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        return stream_windows.watermarked(s, "ts")

    handler = fraud_stream.AlertBatches(f"{root}/judged", rules)
    sinks.drain(sinks.to_batches(stream(), handler, f"{root}/cp1", every=None))
    by_batch = spark.read.parquet(handler.alerts)
    assert by_batch.select("batch").distinct().count() == 4
    got = [r.alert_id for r in by_batch.collect()]
    assert len(got) == len(set(got)) and set(got) == want

    sinks.drain(sinks.to_files(fraud_stream.user_alerts(stream(), rules), f"{root}/out", f"{root}/cp2"))
    got = [r.alert_id for r in spark.read.parquet(f"{root}/out").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_stream_alerts_gather_users(spark, root):
    """The processor is called up for groups of users, not for every single one."""
    schema = "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, amount DOUBLE"
    events = [(2 * u + i, u, T0 + dt.timedelta(seconds=9 * i), 600.0) for u in range(400) for i in range(2)]
    rows = spark.createDataFrame(events, schema)
    rows.coalesce(1).write.parquet(f"{root}/in")
    rules = AlertRules(high_amount=1e9, burst_count=2, sum_amount=1000.0)
    s = stream_windows.watermarked(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), "ts")
    stream = sinks.to_files(fraud_stream.user_alerts(s, rules), f"{root}/out", f"{root}/cp")
    sinks.drain(stream)
    want = {r.alert_id for r in user_alerts(rows, rules).collect()}
    assert len(want) == 800
    assert {r.alert_id for r in spark.read.parquet(f"{root}/out").collect()} == want
    states = [o["numRowsUpdated"] for p in stream.recentProgress for o in p["stateOperators"]]
    assert 0 < max(states) < 400


def test_stream_late_split_replay(spark, root):
    """Rows behind the closed windows go to the dead letters; a replay changes nothing."""
    schema = "event_id BIGINT, part INT, ts TIMESTAMP_NTZ"

    def batch(*rows):
        return spark.createDataFrame([(i, p, T0 + dt.timedelta(seconds=s)) for i, p, s in rows], schema)

    split = LateSplit(f"{root}/split", "ts", "part", 300, 60)
    batches = [
        batch((1, 0, 10), (2, 1, 20)),
        batch((3, 0, 400), (4, 1, 310)),  # slowest partition at 310: nothing closed
        batch((5, 0, 30), (6, 1, 320)),
        batch((7, 0, 40), (8, 1, 100)),  # slowest at 320: the window to 300 is closed
        batch((9, 0, 299)),
    ]
    for n, b in enumerate(batches):
        split(b, n)
    split(batches[3], 3)
    late = {(r.event_id, r.late_for) for r in spark.read.parquet(split.dead_letters).collect()}
    # The last sliding window of second 40 ends at 300, of second 100 at 360, of second 299 at 540.
    assert late == {(7, "tumbling"), (7, "sliding"), (8, "tumbling"), (9, "tumbling")}
    on_time = {r.event_id: r.late_for for r in spark.read.parquet(split.on_time).collect()}
    assert set(on_time) == {1, 2, 3, 4, 5, 6, 8, 9}
    assert on_time[8] == ["tumbling"] and on_time[1] == []


def test_stream_session_golden(spark, root):
    from tests.test_fixtures import SESSION_ROWS

    rows = spark.createDataFrame(SESSION_ROWS, "user_id BIGINT, ts TIMESTAMP_NTZ, amount DOUBLE")
    rows.coalesce(1).write.parquet(f"{root}/in")
    s = stream_windows.watermarked(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), "ts")
    found = stream_windows.sessions(s, "ts", "user_id", 120, "amount")
    sinks.drain(sinks.to_files(found, f"{root}/out", f"{root}/cp"))
    got = {(r.user_id, r.tx_count, r.total_amount) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {(9001, 2, 200000.0), (9001, 2, 210000.0), (9002, 1, 70000.0)}
