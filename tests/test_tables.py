"""Versioned tables, merges, the medallion run, migration and streamed changes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from txlake.operators import reconcile
from txlake.plans import medallion, migration
from txlake.plans.medallion import Lake, Settings
from txlake.session import scratch, shared_root
from txlake.sources import fs
from txlake.sources import versioned
from txlake.sources.versioned import VersionedTable
from txlake.streaming import sinks
from txlake.streaming.cdc import ApplyChanges, decode_changes
from txlake.streaming.serving import ServingViews

DAY = dt.date(2024, 3, 5)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions(spark, root):
    t = VersionedTable(spark, f"{root}/t")
    assert not t.exists()
    t.overwrite(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id INT, p STRING, v STRING"), ["p"])
    t.append(spark.createDataFrame([(3, "a", "z")], "id INT, p STRING, v STRING"))
    t.upsert(spark.createDataFrame([(1, "a", "X"), (4, "c", "w")], "id INT, p STRING, v STRING"), ["id"], touched=F.col("p").isin("a", "c"))
    assert rows_of(t.read()) == [(1, "a", "X"), (2, "b", "y"), (3, "a", "z"), (4, "c", "w")]
    assert rows_of(t.read(version=0)) == [(1, "a", "x"), (2, "b", "y")]
    stamp = t._load(1).timestamp_ms
    assert t.version_at(stamp + 10_000_000) == 2 and t.version_at(stamp) in (1, 2)
    with pytest.raises(ValueError):
        t.version_at(0)
    assert [r.operation for r in t.history().collect()] == ["MERGE", "APPEND", "OVERWRITE"]
    before = rows_of(t.read())
    t.compact(order_by=["id", "v"], files=2)
    assert rows_of(t.read()) == before
    assert t.vacuum(retention_hours=168) == []
    t.vacuum(retention_hours=0, now_ms=t._load().timestamp_ms + 1)
    assert rows_of(t.read()) == before
    assert len(fs.folders(spark, f"{root}/t/data", 1)) == 1
    t.overwrite(spark.createDataFrame([(1.5,)], "other DOUBLE"), [])
    assert t.read().columns == ["other"]


def test_compact_bounds_rows_of_a_task(spark, root, monkeypatch):
    """Files are cut by rows too: few bytes may be very many rows."""
    monkeypatch.setattr(versioned, "SORTED_ROWS", 1000)
    t = VersionedTable(spark, f"{root}/t")
    t.overwrite(spark.range(5000).select("id", (F.col("id") % 7).alias("v")))
    t.compact(order_by=["id", "v"])
    assert len(t.read().inputFiles()) >= 4
    assert t.read().count() == 5000 and t.read().select("id").distinct().count() == 5000


def test_odd_partition_values(spark, root):
    t = VersionedTable(spark, f"{root}/t")
    values = [(1, "a/b"), (2, "x=y"), (3, None), (4, "50% off + more"), (5, "plain")]
    df = spark.createDataFrame(values, "id INT, p STRING")
    t.overwrite(df, ["p"])
    assert {tuple(r) for r in t.read().collect()} == set(values)
    for i, p in values:
        same = F.col("p").eqNullSafe(F.lit(p))
        t.replace_where(spark.createDataFrame([(i + 10, p)], "id INT, p STRING"), F.lit(False), same, "R")
    assert {tuple(r) for r in t.read().collect()} == {(i + 10, p) for i, p in values}


def test_merge_is_null_safe_and_repeatable(spark, root):
    t = VersionedTable(spark, f"{root}/t")
    schema = "k INT, c STRING, v INT"
    t.overwrite(spark.createDataFrame([(1, None, 1), (1, "x", 2)], schema))
    change = spark.createDataFrame([(1, None, 10), (None, None, 20)], schema)
    for _ in range(2):
        t.upsert(change, ["k", "c"])
    assert {tuple(r) for r in t.read().collect()} == {(1, None, 10), (1, "x", 2), (None, None, 20)}
    t.insert_new(spark.createDataFrame([(1, "x", 99), (5, "n", 5), (5, "n", 5)], schema), ["k", "c"])
    assert {tuple(r) for r in t.read().collect()} == {(1, None, 10), (1, "x", 2), (None, None, 20), (5, "n", 5)}
    t.update_matching(spark.createDataFrame([(1, "x")], "k INT, c STRING"), ["k", "c"], {"v": F.lit(-1)})
    assert (1, "x", -1) in {tuple(r) for r in t.read().collect()}


def test_merge_rewrites_only_touched_partitions(spark, root):
    t = VersionedTable(spark, f"{root}/t")
    schema = "day STRING, id INT, v INT"
    t.overwrite(spark.createDataFrame([("a", 1, 1), ("b", 2, 2), (None, 3, 3)], schema), ["day"])
    t.upsert(spark.createDataFrame([("a", 1, 10), ("c", 9, 9), (None, 3, 30)], schema), ["day", "id"])
    assert {tuple(r) for r in t.read().collect()} == {("a", 1, 10), ("b", 2, 2), (None, 3, 30), ("c", 9, 9)}
    now, before = t._load(), t._load(0)
    assert now.metrics["partitions_replaced"] == 2
    assert now.folders["day=b"] == before.folders["day=b"] and now.folders["day=a"] != before.folders["day=a"]


def test_second_writer_of_a_version_fails(spark, root):
    t = VersionedTable(spark, f"{root}/t")
    t.overwrite(spark.range(1).toDF("id"))
    stale = t._load()
    t.append(spark.range(1, 2).toDF("id"))
    with pytest.raises(Exception):
        t._commit(t._next(stale, "X", stale.schema, [], stale.folders, {}))
    assert t.read().count() == 2


def test_schema_evolution_needs_consent(spark, root):
    t = VersionedTable(spark, f"{root}/t")
    t.overwrite(spark.createDataFrame([(1,)], "a INT"))
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([(2, "n")], "a INT, b STRING"))
    t.append(spark.createDataFrame([(2, "n")], "a INT, b STRING"), merge_schema=True)
    assert {tuple(r) for r in t.read().collect()} == {(1, None), (2, "n")}


def test_diff(spark):
    a = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id INT, v STRING")
    b = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "id INT, v STRING")
    assert rows_of(reconcile.row_difference(a, b, ["id"])) == [(2, "changed"), (3, "removed"), (4, "added")]
    s = reconcile.version_summary(a, b, ["id"]).first()
    assert (s.added, s.removed, s.changed, s.old_count, s.new_count, s.delta) == (1, 1, 1, 3, 3, 0)


def message(n, day=DAY, **kw):
    event = {
        "tx_id": f"t{n}", "user_id": f"u{n % 3}", "tx_type": "PAYMENT", "amount": 1000.0 + n, "merchant_id": "m1",
        "merchant_category": "F&B", "status": "SUCCESS", "timestamp": f"{day}T10:00:00Z", "source": "api",
    } | kw
    return bytearray(json.dumps(event), "utf-8")


def topic(spark, messages, day=DAY):
    rows = [(None, m, "t", 0, n, dt.datetime.combine(day, dt.time(12))) for n, m in enumerate(messages)]
    return spark.createDataFrame(rows, "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP")


def at_night():
    return F.lit("2024-03-06 03:00:00").cast("timestamp")


@pytest.fixture()
def settings(spark):
    return Settings(now=at_night(), as_of=dt.datetime(2024, 3, 6))


def layer_rows(lake):
    out = {}
    for name in ["silver", "quarantine", *medallion.GOLD_TABLES]:
        out[name] = sorted(str(r) for r in lake.table(name).read().collect())
    return out


def test_medallion_day(spark, root, settings):
    lake = Lake(spark, root)
    yesterday = DAY - dt.timedelta(days=1)
    messages = [message(n) for n in range(10)]
    messages += [
        message(3, amount=5.0, currency="USD"),  # newer copy of t3, too small: flagged
        message(20, amount="12.5"),  # numeric text
        message(21, amount=None),
        message(22, tx_type="CANCEL"),
        message(23, timestamp="not a time"),
        bytearray(b"{broken"),
        message(24, day=yesterday, tx_type="REFUND"),
    ]
    feed = topic(spark, messages)
    out = medallion.run(lake, feed, DAY, settings=settings)
    assert [(r.stage, r.status) for r in out.collect()] == [("bronze", "SUCCESS"), ("silver", "SUCCESS"), ("gold", "SUCCESS")]
    assert lake.table("bronze").read().count() == 17
    silver = {r.tx_id: r for r in lake.table("silver").read().collect()}
    assert set(silver) == {f"t{n}" for n in range(10)} | {"t20", "t24"}
    assert silver["t3"].amount == 5.0 and silver["t3"].quality_flags == "VLD-002" and silver["t3"].currency == "USD"
    assert silver["t1"].currency == "KRW" and not silver["t1"].is_anomaly
    assert lake.table("quarantine").read().count() == 5
    daily = {(r.summary_date, r.tx_type): r for r in lake.table("gold/daily_summary").read().collect()}
    assert daily[(DAY, "PAYMENT")].total_count == 11 and daily[(DAY, "PAYMENT")].unique_users == 3
    assert daily[(yesterday, "REFUND")].total_amount == 1024.0
    fees = {r.settlement_date: r for r in lake.table("gold/fee_settlement").read().collect()}
    assert fees[yesterday].net_amount == -1024.0 and fees[DAY].fee_rate == 0.015
    first = layer_rows(lake)
    medallion.run(lake, feed, DAY, settings=settings)
    assert layer_rows(lake) == first

    # The next day brings a late row for this day: nothing of this day is lost.
    late = topic(spark, [message(30), message(31, day=DAY + dt.timedelta(days=1))], DAY + dt.timedelta(days=1))
    late = late.withColumn("offset", F.col("offset") + 100)
    medallion.run(lake, late, DAY + dt.timedelta(days=1), settings=settings)
    assert lake.table("silver").read().count() == 14
    daily = {(r.summary_date, r.tx_type): r.total_count for r in lake.table("gold/daily_summary").read().collect()}
    assert daily[(DAY, "PAYMENT")] == 12 and daily[(yesterday, "REFUND")] == 1
    stats = lake.table("gold/customer_stats").read().agg(F.sum("total_tx_count")).first()[0]
    assert stats == 14
    # Running an old day again leaves the newer rows alone.
    now = layer_rows(lake)
    medallion.run(lake, feed, DAY, settings=settings)
    assert layer_rows(lake) == now
    assert all(r.has_rows for r in medallion.gold_not_empty(lake).collect())
    medallion.quality_report_json(lake, f"{root}/report")
    # One row per rule and first day of the three runs' two days.
    assert spark.read.json(f"{root}/report").count() == 2 * len(settings.checks())


def test_failing_stage_is_recorded(spark, root):
    lake = Lake(spark, root)
    broken = Settings(rules=[{"id": "X", "type": "completeness", "severity": "critical", "fields": ["nope"]}], now=at_night())
    with pytest.raises(ValueError):
        medallion.run(lake, topic(spark, [message(1)]), DAY, settings=broken)
    runs = {r.stage: r.status for r in lake.table("runs").read().collect()}
    assert runs == {"bronze": "SUCCESS", "silver": "FAILED"}


def test_empty_day(spark, root, settings):
    lake = Lake(spark, root)
    medallion.run(lake, topic(spark, [message(1)]), DAY - dt.timedelta(days=9), settings=settings)
    assert lake.table("silver").read().count() == 0


def test_incremental_load(spark, root):
    source = spark.range(1, 1011).select(F.col("id").alias("tx_id"), (F.col("id") * 2).alias("amount"))
    target = VersionedTable(spark, f"{root}/tx")
    at = F.lit("2024-01-01").cast("timestamp")

    def since(limit):
        return lambda last: source.filter((F.col("tx_id") > last) & (F.col("tx_id") <= limit))

    assert migration.incremental_append(target, since(1000), "tx_id", 0, "db", "b1", at) == 1000
    assert migration.incremental_append(target, since(1010), "tx_id", 0, "db", "b2", at) == 10
    assert migration.incremental_append(target, since(1010), "tx_id", 0, "db", "b3", at) == 0
    assert target.read().count() == 1010
    empty = VersionedTable(spark, f"{root}/empty")
    empty.overwrite(target.read().limit(0))
    assert migration.high_water_mark(empty, "tx_id", -5) == -5


def test_streamed_changes_and_replay(spark, root):
    schema_rows = [
        (b'{"settlement_id":1,"status":"PENDING","__op":"c","__source_ts_ms":1,"__deleted":"false"}', 0),
        (b'{"settlement_id":2,"status":"PENDING","__op":"c","__source_ts_ms":1,"__deleted":"false"}', 1),
        (b'{"settlement_id":1,"status":"DONE","__op":"u","__source_ts_ms":2,"__deleted":"false"}', 2),
        (b'{"settlement_id":2,"__op":"d","__source_ts_ms":3,"__deleted":"true"}', 3),
        (None, 4),
    ]
    from txlake import schemas

    feed = spark.createDataFrame(
        [(None, None if v is None else bytearray(v), "t", 0, o, dt.datetime(2024, 1, 1)) for v, o in schema_rows],
        schemas.TOPIC_ROW,
    )
    rows = decode_changes(feed, schemas.CDC_ROW)
    assert rows.count() == 4
    for fold_every in (50, 1):
        target = VersionedTable(spark, f"{root}/state{fold_every}")
        order = ["__source_ts_ms", "_offset"]
        handler = ApplyChanges(target, ["settlement_id"], order, F.lit(dt.datetime(2024, 1, 1)), fold_every=fold_every)
        handler(rows.filter("_offset < 2"), 0)
        assert {(r.settlement_id, r.status) for r in handler.state().collect()} == {(1, "PENDING"), (2, "PENDING")}
        handler(rows.filter("_offset >= 2"), 1)
        handler(rows.filter("_offset >= 2"), 1)  # a replay changes nothing
        got = {(r.settlement_id, r.status, r["__deleted"]) for r in handler.state().collect()}
        assert got == {(1, "DONE", "false"), (2, "PENDING", "true")}
        assert handler.view.folded() == (1 if fold_every == 1 else -1)
        if fold_every == 1:
            assert handler.view.clean() == 2 and handler.state().count() == 2
            assert set(handler.state().columns) >= {"__deleted", "_cdc_ingested_at"}
            assert not {"_batch", "_applied_at"} & set(handler.state().columns)


@pytest.mark.parametrize("fold_every", [50, 2])
def test_serving_views_replay(spark, root, fold_every):
    handler = ServingViews(Lake(spark, root), recent=3, fold_every=fold_every)

    def batch(*rows):
        return spark.createDataFrame(list(rows), "alert_id STRING, user_id BIGINT, detected_at STRING")

    one = batch(("a1", 1, "2024-01-01T00:00:01Z"), ("a2", 2, "2024-01-01T00:00:02Z"))
    two = batch(("a3", 1, "2024-01-01T00:00:03Z"), ("a4", 1, "2024-01-01T00:00:04Z"))
    for b, n in [(one, 0), (two, 1), (two, 1)]:
        handler(b, n)
    assert {r.alert_id for r in handler.latest.read().collect()} == {"a2", "a4"}
    assert {r.alert_id for r in handler.recent.read().collect()} == {"a2", "a3", "a4"}
    assert {(r.user_id, r.alert_count) for r in handler.count.read().collect()} == {(1, 3), (2, 1)}


def test_scratch_is_below_the_shared_root(spark):
    assert scratch(spark, "x").startswith(shared_root(spark))
    assert scratch(spark, "x") != scratch(spark, "x")


def test_sinks_for_debugging(spark, root):
    spark.range(3).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("id BIGINT").parquet(f"{root}/in")
    q = sinks.to_memory(stream, "seen").trigger(availableNow=True).start()
    sinks.drain(q, timeout=60)
    assert spark.table("seen").count() == 3
