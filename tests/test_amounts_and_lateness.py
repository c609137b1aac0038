"""Amounts that are no cents, rows that lag behind, and texts that follow parameters."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests import oracle
from txlake.functions.money import exact_avg, exact_sum
from txlake.operators import cdc, fraud, lateness, quality, reconcile
from txlake.sources import kafka
from txlake.streaming.late import LateSplit

T0 = dt.datetime(2024, 3, 5, 12)


@pytest.mark.parametrize("value", [0.004, 1 / 128, 12.3456])
def test_small_parts_of_a_cent_count(spark, value):
    got = spark.range(1000).select(F.lit(value).alias("v")).agg(exact_sum("v"), exact_avg("v")).first()
    assert math.isclose(got[0], 1000 * value, abs_tol=1e-5) and math.isclose(got[1], value, abs_tol=1e-8)


def test_unrounded_sums_as_by_sql(spark):
    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet")
    part = F.col("value") / 128
    found = events.groupBy("event_type").agg(exact_sum(part).alias("total")).withColumn("total", F.round("total", 4))
    want = "SELECT event_type, round(sum(value / 128), 4) AS total FROM events GROUP BY event_type"
    assert oracle.spark_rows(found) == oracle.sql_rows(oracle.connect(folder), want)


def test_amounts_that_are_no_money_are_null(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e30,), (2.5,), (None,)], "v double")
    assert rows.agg(exact_sum("v")).first()[0] == 2.5


def test_amounts_that_are_no_money_break_a_rule(spark):
    rows = spark.createDataFrame(
        [(1, float("nan")), (2, 1e17), (3, float("inf")), (4, -2e15), (5, 10.0)], "tx_id long, amount double"
    )
    done = quality.evaluate(rows, [quality.MONEY_RULE])
    assert {r.tx_id for r in quality.clean_rows(done).collect()} == {5}
    assert {r.tx_id for r in quality.quarantined_rows(done).collect()} == {1, 2, 3, 4}


def test_alert_texts_follow_the_rules():
    usual = fraud.AlertRules()
    assert usual.high_amount_text == "단건 500만원 초과 거래"
    assert usual.burst_text == "1분 내 %d건 연속 거래" and usual.sum_text == "1분 내 거래 합계 %.0f원 초과"
    other = fraud.AlertRules(span_seconds=90, high_amount=250.0)
    assert other.high_amount_text == "단건 250원 초과 거래" and other.burst_text == "90초 내 %d건 연속 거래"


def test_checksums_tell_columns_apart(spark):
    def sums(*rows):
        df = spark.createDataFrame(list(rows), "a string, b string")
        return reconcile.checksum(df, [F.col("a"), F.col("b")], "md5").first().checksum

    assert len({sums(("a|b", "c")), sums(("a", "b|c")), sums((None, "x")), sums(("\\N", "x")), sums(("~", "x"))}) == 5


def test_a_day_of_a_topic_has_both_ends():
    days = kafka.day_range(dt.date(2024, 3, 5), dt.date(2024, 3, 6))
    options = kafka.source_options("k:9092", ["t"], starting="earliest", ending="latest", **days)
    assert options["startingTimestamp"] == "1709596800000" and options["endingTimestamp"] == "1709683200000"
    assert "startingOffsets" not in options and "endingOffsets" not in options


def test_every_topic_partition_holds_the_watermark(spark):
    rows = [(i, T0 + dt.timedelta(seconds=20 * i), i, i % 4) for i in range(100)]
    rows += [(1000 + i, T0 + dt.timedelta(seconds=20 * i), 100 + i, 7) for i in range(2)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, arrival long, part int")
    marked = lateness.mark_late(df, "ts", "arrival", "part", {"w": (300, 300)})
    assert [r.event_id for r in marked.filter(F.size("late_for") > 0).collect()] == []


def test_update_and_delete_of_one_millisecond(spark):
    envelope = "before struct<id:long,v:string>, after struct<id:long,v:string>, source struct<db:string,table:string,ts_ms:long>, op string, offset long"
    at = ("d", "t", 5)
    feed = [(None, (1, "a"), at, "c", 1), ((1, "a"), (1, "b"), at, "u", 2), ((1, "b"), None, at, "d", 3), (None, None, None, None, 4)]
    changes = cdc.unwrap(spark.createDataFrame(feed, envelope), position="offset")
    order, extras = ["__source_ts_ms", "__offset"], ("__offset",)
    state = cdc.apply_changes(None, changes, ["id"], order, F.lit(T0), extras=extras).first()
    assert (state.v, state["__deleted"]) == ("b", "true")


@pytest.mark.parametrize("idle, late", [(None, 0), (60, 1)])
def test_an_idle_partition_lets_go_after_a_while(spark, root, monkeypatch, idle, late):
    split = LateSplit(f"{root}/split", "ts", "part", 300, rule=lateness.Lateness(0, 0), idle=idle)
    batches = [
        [(1, T0, "a"), (2, T0, "b")],
        [(3, T0 + dt.timedelta(hours=2), "a")],
        [(4, T0 + dt.timedelta(hours=1), "a")],
    ]
    for n, rows in enumerate(batches):
        monkeypatch.setattr("txlake.streaming.late.time.time", lambda n=n: 1_000_000 + 100 * n)
        split(spark.createDataFrame(rows, "event_id long, ts timestamp, part string"), n)
    assert spark.read.parquet(split.dead_letters).count() == late
