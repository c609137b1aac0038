"""Dense keys, timers, re-emitted windows, cursors, checksum trees, sketches and messages."""

import datetime as dt
import random
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from txlake import schemas
from txlake.functions import times
from txlake.operators import gold, reconcile, trailing
from txlake.plans import load_queries, medallion, migration
from txlake.sources import jdbc, kafka
from txlake.sources.versioned import VersionedTable
from txlake.streaming import events, metrics, sinks, timers, windows

T0 = dt.datetime(2024, 3, 5, 12)
FOLDER = "/root/testdata/sf0.001"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


# Dense keys


def trailing_of(rows, span):
    """{id: (count, total)} by comparing all rows of a key."""
    out = {}
    for i, key, ts, amount in rows:
        seen = [r for r in rows if r[1] == key and ts - dt.timedelta(seconds=span) <= r[2] and (r[2], r[0]) <= (ts, i)]
        out[i] = (len(seen), round(sum(r[3] or 0 for r in seen), 6))
    return out


@pytest.mark.parametrize("span, spread", [(60, 50), (60, 400), (10, 30), (7, 90)])
def test_one_key_with_all_rows_in_a_minute(spark, span, spread):
    draw = random.Random(span * spread)
    rows = [(n, 1, at(draw.randrange(spread * 4) / 4), draw.choice([1.25, 2.5, None, 100.0])) for n in range(400)]
    rows += [(1000 + n, 2 + n % 7, at(draw.randrange(spread)), 1.0) for n in range(60)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, amount double").repartition(5)
    want = trailing_of(rows, span)
    for hot_rows in (None, 100, 0):
        got = trailing.trailing_totals(df, "user_id", "ts", "event_id", "amount", span, hot_rows=hot_rows).collect()
        assert {r.event_id: (r.trailing_count, round(r.trailing_total, 6)) for r in got} == want
        assert len(got) == len(rows)


def test_a_dense_key_is_put_in_order_by_panes(spark):
    """200,000 rows of one key within a minute: no group of rows to sort holds more than one pane."""
    df = spark.range(200_000).select(
        F.col("id").alias("event_id"),
        F.lit(1).cast("long").alias("user_id"),
        F.timestamp_micros(F.lit(1_709_640_000_000_000) + F.col("id") * 300).alias("ts"),
        F.lit(1.0).alias("amount"),
    )
    got = trailing.trailing_totals(df, "user_id", "ts", "event_id", "amount", 60, hot_rows=1000)
    row = got.agg(F.max("trailing_count"), F.sum("trailing_count"), F.count("*")).first()
    assert tuple(row) == (200_000, 200_000 * 200_001 // 2, 200_000)
    plan = got._jdf.queryExecution().toString()
    assert "_pane" in plan and trailing._hot_keys(df, "user_id", "ts", 600_000_000, 200_000) is None


# Windows that are emitted again


def test_update_mode_emits_again_and_survives_restarts(spark, root):
    """Each part is a new start of the same query; totals equal those of one run."""
    schema = "event_type string, ts timestamp_ntz, amount double"
    parts = [
        [("a", at(1), 1.0), ("a", at(301), 2.0)],
        [("a", at(2), 4.0), ("b", at(303), 8.0)],
        [("a", at(302), 16.0), ("a", at(330), 32.0)],
        [("a", at(3), 64.0), ("b", at(304), 128.0)],  # the first window has been closed by second 330
    ]
    keys = ["event_type", "window_start", "window_end"]
    results = sinks.KeyedResults(VersionedTable(spark, f"{root}/windows"), keys, fold_every=2)
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        feed = windows.watermarked(spark.readStream.schema(schema).parquet(f"{root}/in"), "ts")
        found = windows.windowed(feed, "ts", ["event_type"], 300, "amount")
        sinks.drain(sinks.to_batches(found, results, f"{root}/cp", every=None, mode="update"))
    got = {(r.event_type, r.window_start): (r.transaction_count, r.total_amount, r.emissions) for r in results.read().collect()}
    assert got == {("a", T0): (2, 5.0, 2), ("a", at(300)): (3, 50.0, 2), ("b", at(300)): (2, 136.0, 2)}


def test_append_windows_survive_restarts(spark, root):
    schema = "event_type string, ts timestamp_ntz, amount double"
    for second in (1, 100, 200, 400, 900):
        row = [("a", at(second), float(second))]
        spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        feed = windows.watermarked(spark.readStream.schema(schema).parquet(f"{root}/in"), "ts")
        found = windows.windowed(feed, "ts", ["event_type"], 300, "amount")
        sinks.drain(sinks.to_files(found, f"{root}/out", f"{root}/cp"))
    got = sorted((r.window_start, r.transaction_count, r.total_amount) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [(T0, 3, 301.0), (at(300), 1, 400.0)]


def test_a_replayed_emission_counts_once(spark, root):
    results = sinks.KeyedResults(VersionedTable(spark, f"{root}/t"), ["k"], fold_every=3)
    batches = [[(1, "a"), (2, "b")], [(1, "c")], [(1, "d")], [(2, "e")]]
    for n, rows in enumerate(batches):
        for _ in range(2):
            results(spark.createDataFrame(rows, "k long, v string"), n)
    assert {(r.k, r.v, r.emissions) for r in results.read().collect()} == {(1, "d", 3), (2, "e", 2)}


# Timers


def test_latest_alert_expires(spark, root):
    schema = "user_id long, at_time timestamp, alert_id string"
    view = sinks.KeyedResults(VersionedTable(spark, f"{root}/view"), ["user_id"], (F.desc("at"), F.desc("expired")))
    day = 86_400

    def step(*rows):
        spark.createDataFrame([(u, at(s), i) for u, s, i in rows], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        feed = spark.readStream.schema(schema).parquet(f"{root}/in").withWatermark("at_time", "0 seconds")
        changes = timers.latest_until_expiry(feed, "user_id", "at_time", "alert_id")
        sinks.drain(sinks.to_batches(changes, view, f"{root}/cp", every=None, mode="update"))
        return {(r.user_id, r.alert_id) for r in timers.body_fields(view.read(), schema).collect()}

    assert step((1, 0, "a"), (2, 10, "b"), (1, 5, "c"), (3, day - 1, "d")) == {(1, "c"), (2, "b"), (3, "d")}
    # The first user's alert is a day old, the second's a second short of it.
    assert step((3, day + 9, "e")) == {(2, "b"), (3, "e")}
    # A newer alert starts the time again.
    assert step((2, day + 10, "f"), (3, 2 * day, "g")) == {(2, "f"), (3, "g")}
    assert step((3, 2 * day + 10, "h")) == {(3, "h")}


def test_a_silent_key_is_reported_without_a_new_row(spark, root):
    schema = "user_id long"
    spark.createDataFrame([(1,), (2,), (1,), (None,)], schema).coalesce(1).write.parquet(f"{root}/in")
    feed = spark.readStream.schema(schema).parquet(f"{root}/in")
    found = []

    def keep(batch, _):
        found.extend((r.user_id, r.kind) for r in batch.collect())

    query = sinks.to_batches(timers.silent_keys(feed, "user_id", 3), keep, f"{root}/cp", every="1 second", mode="update")
    try:
        until = time.time() + 60
        while len(found) < 2 and time.time() < until:
            time.sleep(0.5)
        assert sorted(found) == [(1, "silent"), (2, "silent")]
        # Only one report for one silence; the next row ends it.
        spark.createDataFrame([(2,)], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        while len(found) < 4 and time.time() < until:
            time.sleep(0.5)
        assert sorted(found) == [(1, "silent"), (2, "resumed"), (2, "silent"), (2, "silent")]
    finally:
        query.stop()


# Cursors


def test_rows_committed_late_are_loaded(spark, root):
    target = VersionedTable(spark, f"{root}/t")
    cursor = migration.Cursor("stamp", ("id",), T0 - dt.timedelta(days=1), dt.timedelta(seconds=60))
    seen = []

    def load(rows):
        df = spark.createDataFrame([(i, at(s)) for i, s in rows], "id long, stamp timestamp_ntz")

        def read_from(start):
            seen.append(start)
            return df.filter(F.col("stamp") >= F.lit(start).cast("timestamp_ntz"))

        return migration.append_from(target, read_from, cursor, "s", "b", F.lit(T0))

    rows = [(1, 0), (2, 100)]
    assert load(rows) == 2
    rows += [(3, 100), (4, 50), (5, 130)]  # the mark's own stamp, one before it, one after it
    assert load(rows) == 3 and load(rows) == 0
    assert sorted(r.id for r in target.read().collect()) == [1, 2, 3, 4, 5]
    assert seen == [T0 - dt.timedelta(days=1), at(40), at(70)]
    assert jdbc.since_query("t", "c", 5, inclusive=True) == "(SELECT * FROM t WHERE c >= 5) t"


# Checksum trees


@pytest.mark.parametrize("most", [500, 1])
def test_only_differing_ranges_are_read(spark, root, monkeypatch, most):
    monkeypatch.setattr(reconcile, "MOST_INTERVALS", most)
    rows = spark.range(-2000, 200_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1)], "k long, v long"))
    changed = rows.withColumn("v", F.when(F.col("k").isin(-1500, 77_777, 199_999), -1).otherwise(F.col("v")))
    changed = changed.filter("k is null or k <> 5000").unionByName(spark.createDataFrame([(None, 2), (900_000, 1)], "k long, v long"))
    tops = [reconcile.write_checksum_tree(df, "k", f"{root}/{n}") for n, df in [("a", rows), ("b", changed)]]
    assert min(tops) >= 1
    ranges = reconcile.differing_ranges(spark, f"{root}/a", f"{root}/b", min(tops))
    want = {k // reconcile.LEAF_KEYS for k in (-1500, 77_777, 199_999, 5000, 900_000)} | {None}
    assert {r["range"] for r in ranges.collect()} == want
    read = reconcile.rows_in_ranges(rows, "k", ranges)
    assert read.count() <= 5 * reconcile.LEAF_KEYS + 1
    got = {(r.k, r.v, r.side) for r in reconcile.differing_rows(rows, changed, "k", f"{root}/a", f"{root}/b", min(tops)).collect()}
    sides = {(k, 3 * k, "source") for k in (-1500, 77_777, 199_999, 5000)} | {(k, -1, "target") for k in (-1500, 77_777, 199_999)}
    assert got == sides | {(None, 2, "target"), (900_000, 1, "target")}


def test_equal_tables_have_no_differing_range(spark, root):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    tops = [reconcile.write_checksum_tree(df, "k", f"{root}/{n}") for n, df in [("a", rows), ("b", rows.repartition(7))]]
    assert reconcile.differing_ranges(spark, f"{root}/a", f"{root}/b", min(tops)).isEmpty()


def test_sample_takes_the_same_keys_on_both_sides(spark):
    rows = spark.range(10_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    changed = rows.withColumn("v", F.when(F.col("k") % 10 == 0, 2).otherwise(1))
    found = reconcile.sample_difference(rows, changed, ["k"], one_in=16).collect()
    chosen = {r.k for r in rows.filter(F.pmod(F.xxhash64("k"), F.lit(16)) == 0).collect()}
    assert {r.k for r in found} == {k for k in chosen if k % 10 == 0} and len(found) == 2 * len({r.k for r in found})
    assert 400 < len(chosen) < 900


# Sketches


def test_sketches_of_days_unite_without_the_rows(spark, root):
    tx = spark.range(300_000).select(
        (F.col("id") % 90_000).alias("user_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("tx_date"),
        F.when(F.col("id") % 3 == 0, "PAYMENT").otherwise("REFUND").alias("tx_type"),
    )
    gold.daily_user_sketches(tx).write.parquet(f"{root}/sketches")
    kept = spark.read.parquet(f"{root}/sketches")
    by = [F.date_format("summary_date", "yyyy-MM").alias("month"), F.col("tx_type")]
    got = {(r.month, r.tx_type): r.unique_users for r in gold.unique_users(kept, *by).collect()}
    exact = tx.groupBy(F.date_format("tx_date", "yyyy-MM").alias("month"), "tx_type").agg(F.count_distinct("user_id").alias("n"))
    for r in exact.collect():
        assert abs(got[r.month, r.tx_type] - r.n) <= 0.02 * r.n
    whole = gold.unique_users(kept).first().unique_users
    assert abs(whole - 90_000) <= 0.02 * 90_000


# Messages


def message_rows(spark, rows):
    return spark.createDataFrame(rows, "topic string, key string, value string")


def test_message_ids_survive_a_replay_in_another_order(spark):
    rows = [("t", "a", "1"), ("t", "a", "1"), ("t", None, "2"), ("t", "", "2"), ("t", "b", None)]

    def ids(order, batch):
        sent = kafka.identified(message_rows(spark, order).repartition(3), "s", batch)
        return sorted(r[0] for r in sent.select(kafka.message_id(F.col("headers"))).collect())

    first = ids(rows, 4)
    assert len(set(first)) == 5 and ids(rows[::-1], 4) == first and not set(ids(rows, 5)) & set(first)


def test_a_reader_sees_each_message_once(spark, root):
    sender = sinks.TopicBatches("s", lambda df: df, lambda m: m.withColumn("timestamp", F.lit(T0).cast("timestamp")).write.mode("append").parquet(f"{root}/t"))
    batches = [[("t", "a", "1"), ("t", "a", "1")], [("t", "a", "1"), ("t", "b", "2")]]
    for n in (0, 1, 1, 0):
        sender(message_rows(spark, batches[n]), n)
    raw = spark.read.parquet(f"{root}/t")
    assert raw.count() == 8
    assert sorted((r.key, r.value) for r in kafka.without_repeats(raw).collect()) == [("a", "1")] * 3 + [("b", "2")]
    feed = kafka.without_repeats(spark.readStream.schema(raw.schema).parquet(f"{root}/t"))
    sinks.drain(sinks.to_files(feed.select("key", "value"), f"{root}/out", f"{root}/cp"))
    assert spark.read.parquet(f"{root}/out").count() == 4
    plain = raw.withColumn("headers", F.lit(None).cast(raw.schema["headers"].dataType))
    assert kafka.without_repeats(plain).count() == 8


def test_unreadable_messages_become_dead_letters(spark):
    values = ['{"event_id":"1","user_id":7,"more":1,"event_timestamp":"2024-03-05T12:00:00Z"}', '{"event_id":"2"', None, "", '{"user_id":"x"}', '{"event_timestamp":"soon"}']
    rows = [(bytes(f"k{n}", "utf-8"), None if v is None else v.encode(), "in", 0, n, T0) for n, v in enumerate(values)]
    decoded = events.decode_events(spark.createDataFrame(rows, schemas.TOPIC_ROW))
    good = {r._offset: (r.event_id, r.user_id, r.event_at, r.time_is_fallback) for r in events.accepted(decoded).collect()}
    assert good[0] == ("1", 7, T0, False) and good[5] == (None, None, T0, True)
    letters = {r.key: r.value for r in events.rejected(decoded, "dlq").collect()}
    assert set(good) | {int(k[1]) for k in letters} == set(range(6)) and not set(good) & {int(k[1]) for k in letters}
    assert set(letters) >= {"k1", "k2", "k4"}
    assert '"reason":"malformed","topic":"in","partition":0,"offset":1' in letters["k1"] and '"reason":"empty"' in letters["k2"]


# Counters and days


def test_a_batch_that_reports_twice_counts_once(spark):
    counters = metrics.Counters(spark)
    try:
        metrics_row = SimpleNamespace(asDict=lambda: {"n": 3})
        for batch in (0, 0, 1):
            counters.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(id="q", batchId=batch, observedMetrics={"x": metrics_row})))
        counters.onQueryTerminated(SimpleNamespace(runId="r"))
        assert counters.after(SimpleNamespace(runId="r", id="q"), "x") == {"n": 6}
    finally:
        counters.close()


def test_unreadable_time_is_marked(spark):
    df = spark.createDataFrame([("2024-03-05T12:00:00Z",), ("x",), (None,)], "t string")
    got = df.select(times.audited_event_time(F.col("t"), F.lit(T0).cast("timestamp")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == [(T0, False), (T0, True), (T0, True)]


def test_a_run_without_a_day_takes_yesterday(spark, root):
    empty = spark.createDataFrame([], schemas.TOPIC_ROW)
    rows = medallion.run(medallion.Lake(spark, root), empty).collect()
    yesterday = dt.datetime.now(dt.UTC).date() - dt.timedelta(days=1)
    assert {(r.first_day, r.until_day, r.status) for r in rows} == {(yesterday, yesterday + dt.timedelta(days=1), "SUCCESS")}


def test_windows_are_emitted_more_than_once(spark):
    rows = load_queries()["stream_windows_updated"].run(spark, "/root/testdata/sf0.01").collect()
    assert max(r.emissions for r in rows) > 1 and sum(r.late_count for r in rows) > 100
