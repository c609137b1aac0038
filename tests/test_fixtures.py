"""Golden cases and edge rows from FIXTURES.md."""

import datetime as dt
import json

from pyspark.sql import functions as F

from txlake import schemas
from txlake.functions import text, times
from txlake.operators import cdc, fraud, latest, quality, reconcile, windows
from txlake.operators import standardize as std
from txlake.sources import files, jdbc, kafka

T0 = dt.datetime(2024, 4, 14, 10, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_window_message_json(spark):
    row = spark.createDataFrame(
        [("PAYMENT", at(0), at(300), 3, 45000.0, 15000.0, 20000.0, 10000.0)],
        "event_type STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, transaction_count BIGINT, "
        "total_amount DOUBLE, avg_amount DOUBLE, max_amount DOUBLE, min_amount DOUBLE",
    )
    message = windows.window_messages(row)
    got = json.loads(message.select(text.json_value(*message.columns).alias("v")).first().v)
    assert got == {
        "event_type": "PAYMENT",
        "window_start": "2024-04-14T10:00:00.000Z",
        "window_end": "2024-04-14T10:05:00.000Z",
        "transaction_count": 3,
        "total_amount": 45000,
        "avg_amount": 15000,
        "max_amount": 20000,
        "min_amount": 10000,
    }


SESSION_ROWS = [
    (9001, at(0), 120000.0),
    (9001, at(35), 80000.0),
    (9001, at(190), 150000.0),
    (9001, at(220), 60000.0),
    (9002, at(60), 70000.0),
    (9003, at(420), 10000.0),
]


def test_sessions_golden(spark):
    rows = spark.createDataFrame(SESSION_ROWS, "user_id BIGINT, ts TIMESTAMP_NTZ, amount DOUBLE")
    got = {(r.user_id, r.tx_count, r.total_amount) for r in windows.sessions(rows, "ts", "user_id", 120, "amount").collect()}
    assert got == {(9001, 2, 200000.0), (9001, 2, 210000.0), (9002, 1, 70000.0), (9003, 1, 10000.0)}


def test_session_gap_is_inclusive(spark):
    rows = spark.createDataFrame(
        [(1, at(0), 1.0), (1, at(120), 1.0), (1, at(240) + dt.timedelta(microseconds=1), 1.0)],
        "user_id BIGINT, ts TIMESTAMP_NTZ, amount DOUBLE",
    )
    got = sorted(r.tx_count for r in windows.sessions(rows, "ts", "user_id", 120, "amount").collect())
    assert got == [1, 2]


def test_burst_and_high_amount(spark):
    burst = [(n, 7, at(10 * n), 1000.0) for n in range(5)]
    rows = spark.createDataFrame(
        [*burst, (10, 8, at(0), 7_500_000.0), (11, 9, at(0), None), (12, None, at(0), 9e6)],
        "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, amount DOUBLE",
    )
    got = [(r.rule_id, r.user_id, r.event_count, r.trigger_event_id) for r in fraud.user_alerts(rows).collect()]
    assert sorted(got) == [
        ("RULE-001", 7, 3, "2"),
        ("RULE-001", 7, 4, "3"),
        ("RULE-001", 7, 5, "4"),
        ("RULE-002", 8, 1, "10"),
    ]


def test_thresholds_and_sum_rule(spark):
    rows = spark.createDataFrame(
        [
            (1, 1, at(0), 5_000_000.0),  # exactly at the limit: reported
            (2, 2, at(0), 4_999_999.99),
            (3, 3, at(0), 4_000_000.0),
            (4, 3, at(60), 4_000_000.0),  # exactly 60 s later: still inside
            (5, 3, at(60), 2_000_000.0),  # sum is exactly the limit: not reported
            (6, 3, at(60), 1.0),
            (7, 3, at(121), 1.0),  # everything else has left
        ],
        "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, amount DOUBLE",
    )
    got = {(r.rule_id, r.trigger_event_id): (r.trigger_amount, r.event_count) for r in fraud.user_alerts(rows).collect()}
    assert got == {
        ("RULE-002", "1"): (5_000_000.0, 1),
        ("RULE-001", "5"): (2_000_000.0, 3),
        ("RULE-001", "6"): (1.0, 4),
        ("RULE-003", "6"): (10_000_001.0, 4),
    }


def test_record_rules(spark):
    rows = spark.createDataFrame(
        [
            ("a", 1, 60_000_000.0, "KRW", "PAYMENT", "APP", False),
            ("b", 1, 30_000_000.0, "KRW", "WITHDRAWAL", "ATM", True),
            ("c", 1, 1e12, "EUR", "PAYMENT", "APP", False),
            ("d", 1, 50_000_000.0, "KRW", "PAYMENT", "APP", None),
            ("e", 1, None, "KRW", "PAYMENT", "APP", True),
        ],
        "tx_id STRING, user_id BIGINT, amount DOUBLE, currency STRING, tx_type STRING, channel STRING, is_suspicious BOOLEAN",
    )
    got = {r.tx_id: (len(r.reasons), r.risk_level) for r in fraud.record_alerts(rows).collect()}
    assert got == {"a": (1, "MEDIUM"), "b": (2, "HIGH"), "e": (1, "MEDIUM")}
    assert fraud.record_alerts(rows).filter("tx_id = 'a'").first().reasons == ["고액 거래(KRW 60,000,000)"]


def test_timestamps(spark):
    rows = spark.createDataFrame(
        [("2026-04-14T13:03:10.713212+00:00", "2026-04-14 13:03:10.713212", "2026-04-14"), ("nonsense", "bad", "14.04.2026")],
        "a STRING, b STRING, c STRING",
    )
    good, bad = rows.select(
        times.normalize_offset_timestamp(F.col("a")),
        times.normalize_naive_timestamp(F.col("b")),
        times.normalize_day(F.col("c")),
    ).collect()
    assert tuple(good) == ("2026-04-14T13:03:10Z", "2026-04-14T13:03:10Z", "2026-04-14T00:00:00Z")
    assert tuple(bad) == ("nonsense", "bad", "14.04.2026")


def test_bad_csv_rows_are_set_aside(spark, root):
    with open(f"{root}/settlement_1.csv", "w") as f:
        f.write(",".join(schemas.SETTLEMENT_CSV.names) + "\n")
        f.write("S1,B1,M1,shop,FOOD,DAILY_CLOSE,100.5,1.5,99.0,KRW,3,2026-04-14,2026-04-14T00:00:00,COMPLETED\n")
        f.write(",B1,M1,shop,FOOD,DAILY_CLOSE,abc,1.5,99.0,KRW,many,2026-04-14,,COMPLETED\n")
        f.write("S3,,,,,,,,,,,,,\n")
    with open(f"{root}/other.csv", "w") as f:
        f.write("not,ours\n")
    rows = files.settlement_csv(spark, root)
    good, bad = std.split_valid(std.validate(std.from_settlement(rows, F.lit("now"), carry=("filename",))))
    assert [(r.event_id, r.amount, r.tx_count, r.event_timestamp, r.filename) for r in good.collect()] == [
        ("S1", 100.5, 3, "2026-04-14T00:00:00Z", "settlement_1.csv")
    ]
    reasons = {r.event_id: set(r.validation_errors) for r in bad.collect()}
    assert reasons[None] == {"missing:event_id", "type:amount", "type:tx_count"}
    assert reasons["S3"] == {"missing:event_type", "missing:event_timestamp"}


def test_csv_stream_reads_each_file_once(spark, root):
    from txlake.streaming import sinks

    import os

    os.makedirs(f"{root}/in")
    header = ",".join(schemas.SETTLEMENT_CSV.names) + "\n"

    def drop(n):
        with open(f"{root}/in/settlement_{n}.csv", "w") as f:
            f.write(header + f"S{n},B,M,s,F,D,1,1,1,KRW,1,2026-04-14,,COMPLETED\n")

    def run():
        stream = files.settlement_csv(spark, f"{root}/in", streaming=True, archive=f"{root}/done")
        sinks.drain(sinks.to_files(stream, f"{root}/out", f"{root}/cp"))

    drop(1)
    run()
    drop(2)
    run()
    run()
    assert sorted(r.settlement_id for r in spark.read.parquet(f"{root}/out").collect()) == ["S1", "S2"]


def test_api_envelope(spark, root):
    payment = {"event_id": "E1", "event_type": "PAYMENT", "user_id": 5, "amount": 10.5, "merchant": {"id": "M1", "name": "n", "category": "c"},
               "timestamp": "2026-04-14T13:03:10.713212+00:00", "source": "payment-api", "unknown": {"x": 1}}
    with open(f"{root}/r.json", "w") as f:
        json.dump({"status": "ok", "count": 2, "fetched_at": "x", "data": [payment | {"is_suspicious": False}, payment | {"event_id": "E2"}]}, f, indent=1)
    rows = std.from_api(files.api_payments(spark, root, one_per_file=True), F.lit("now"))
    good, bad = std.split_valid(std.validate(rows))
    # The standard event requires the flag, which the API sends and E2 lacks.
    assert [(r.event_id, r.validation_errors) for r in bad.collect()] == [("E2", ["missing:is_suspicious"])]
    got = good.first()
    assert (got.event_id, got.user_id, got.amount, got.merchant_id, got.is_suspicious) == ("E1", 5, 10.5, "M1", False)
    assert got.event_timestamp == "2026-04-14T13:03:10Z"


def test_dirty_numbers(spark):
    values = ['{"tx_id":"1","amount":12.5}', '{"tx_id":"2","amount":"12.5"}', '{"tx_id":"3","amount":"x"}', "{broken", None]
    rows = spark.createDataFrame([(v,) for v in values], "value STRING")
    got = files.decode_json(rows, F.col("value"), schemas.RAW_EVENT)
    out = got.select("data.tx_id", F.col("data.amount").try_cast("double").alias("a"), "_corrupt").collect()
    assert [(r.tx_id, r.a) for r in out[:3]] == [("1", 12.5), ("2", 12.5), ("3", None)]
    assert out[3]._corrupt == "{broken" and out[4].tx_id is None and out[4]._corrupt is None


def test_masking(spark):
    row = spark.createDataFrame([("card 1234-5678-9012-0000 or 1234567890120000, mail a.b@x.example.com.",)], "t STRING")
    got = row.select(text.mask_emails(text.mask_cards(F.col("t")))).first()[0]
    assert got == "card 1234-****-****-0000 or 1234-****-****-0000, mail ***@x.example.com."


CHANGES = "id BIGINT, status STRING, __op STRING, __source_ts_ms BIGINT, __deleted STRING, n BIGINT"


def test_cdc_day(spark):
    now = F.lit(T0)
    order = ["__source_ts_ms", "n"]
    first = spark.createDataFrame(
        [(1, "NEW", "c", 1, "false", 1), (2, "NEW", "c", 1, "false", 2), (3, "NEW", "r", 1, None, 3)], CHANGES
    )
    state = cdc.apply_changes(None, first, ["id"], order, now)
    second = spark.createDataFrame(
        [
            (1, "A", "u", 2, "false", 4),
            (1, "B", "u", 2, "false", 5),  # same source time, later offset wins
            (2, None, "d", 3, "true", 6),
            (4, "NEW", "c", 2, "false", 7),
            (4, None, "d", 3, "true", 8),  # inserted and deleted in one batch
            (5, None, "d", 3, "true", 9),  # never seen: nothing to delete
            (3, None, "d", 2, "true", 10),
            (3, "BACK", "c", 4, "false", 11),  # deleted, then inserted again
        ],
        CHANGES,
    )
    got = cdc.apply_changes(state, second, ["id"], order, now)
    assert {(r.id, r.status, r.__getitem__("__deleted")) for r in got.collect()} == {
        (1, "B", "false"),
        (2, "NEW", "true"),
        (3, "BACK", "false"),
        (4, "NEW", "true"),
    }
    hard = cdc.apply_changes(state, second, ["id"], order, now, hard_delete=True)
    assert {r.id for r in hard.collect()} == {1, 3}


def test_quality_edges(spark):
    rows = spark.createDataFrame(
        [
            ("t1", "u", "PAYMENT", 500.0, "SUCCESS", at(0), 1),
            ("t1", "u", "PAYMENT", 500.0, "SUCCESS", at(0), 2),  # equal time: later offset wins
            ("t2", "u", "PAYMENT", -1.0, "SUCCESS", at(9), 3),  # newest copy, but broken
            ("t2", "u", "PAYMENT", 500.0, "SUCCESS", at(0), 4),
            (None, "u", "PAYMENT", 500.0, "SUCCESS", at(0), 5),
            (None, "u", "PAYMENT", 500.0, "SUCCESS", at(0), 6),
            ("t3", "u", None, 100.0, "SUCCESS", at(0), 7),
            ("t4", "u", "PAYMENT", 0.0, None, at(-200_000), 8),
            ("t5", "u", "CANCEL", 50_000_001.0, "LOST", None, 9),
        ],
        "tx_id STRING, user_id STRING, tx_type STRING, amount DOUBLE, status STRING, event_timestamp TIMESTAMP_NTZ, n INT",
    )
    done = quality.evaluate(rows, as_of=F.lit(T0).cast("timestamp_ntz"), latest_by=["event_timestamp", "n"])
    got = {r.n: (r.critical_violations, r.warning_violations) for r in done.collect()}
    assert got == {
        1: (["UNQ-001"], []),
        2: ([], []),
        3: (["UNQ-001", "VLD-004"], ["VLD-002"]),
        4: ([], []),
        5: (["CMP-001"], []),
        6: (["CMP-001"], []),
        7: (["CMP-001"], []),
        8: ([], ["VLD-002", "TML-001"]),
        9: (["CMP-001", "VLD-001", "VLD-003"], ["VLD-002"]),
    }
    assert quality.clean_rows(done).count() + quality.quarantined_rows(done).count() == 9
    empty = quality.report(done.limit(0)).collect()
    assert all(r.failed_records == 0 and r.total_records == 0 for r in empty)


def test_unknown_rule_field_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError):
        quality.evaluate(spark.range(1), [{"id": "X", "type": "completeness", "severity": "critical", "fields": ["nope"]}])


def test_reconcile_and_checksum(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "id INT, v STRING")
    b = spark.createDataFrame([(2, "y"), (3, "w"), (None, "z")], "id INT, v STRING")
    row = reconcile.reconcile(a, b, ["id"], "t").first()
    assert (row.source_count, row.target_count, row.missing_keys, row.extra_keys, row.verdict) == (3, 3, 1, 1, "FAIL")
    cols = [F.col("id"), F.col("v")]
    shuffled = a.orderBy(F.desc("v"))
    assert reconcile.checksum(a, cols).first() == reconcile.checksum(shuffled, cols).first()
    assert reconcile.checksum(a, cols).first() != reconcile.checksum(b, cols).first()
    sample = reconcile.sample_difference(a, b, ["id"], one_in=1)
    assert {(r.id, r.side) for r in sample.collect()} == {(1, "source"), (3, "target")}


def test_serving_views(spark):
    rows = [("A%03d" % n, n % 3, f"2024-01-01T00:{n // 60:02d}:{n % 60:02d}Z") for n in range(250)]
    alerts = spark.createDataFrame(rows, "alert_id STRING, user_id BIGINT, detected_at STRING")
    assert {r.alert_id for r in latest.latest_alert_per_user(alerts).collect()} == {"A247", "A248", "A249"}
    recent = [r.alert_id for r in latest.most_recent(alerts).collect()]
    assert recent[0] == "A249" and len(recent) == 100


def test_jdbc_text():
    assert jdbc.since_query("tx", "id", 7) == "(SELECT * FROM tx WHERE id > 7) t"
    assert jdbc.since_query("tx", "at", "o'clock") == "(SELECT * FROM tx WHERE at > 'o''clock') t"
    assert "MIN(id) AS min_val" in jdbc.bounds_query("tx", "id")


def test_kafka_options():
    bounded = kafka.source_options("h:1", ["a", "b"], starting="earliest", ending="latest")
    assert bounded["subscribe"] == "a,b" and bounded["endingOffsets"] == "latest"
    replay = kafka.source_options("h:1", ["a"], starting_timestamp_ms=5, fail_on_data_loss=False)
    assert replay["startingTimestamp"] == "5" and "startingOffsets" not in replay
    assert replay["failOnDataLoss"] == "false"


def test_partner_view_and_routing(spark):
    row = spark.createDataFrame([("e1", "010-1234", "1111222233334444")], "event_id STRING, phone STRING, card STRING")
    got = std.partner_view(row, {"card": text.mask_cards(F.col("card"))}, ["phone"]).first()
    assert got.asDict() == {"event_id": "e1", "card": "1111-****-****-4444"}
    messages = kafka.keyed_messages(row, "out", F.col("event_id")).first()
    assert messages.topic == "out" and messages.key == "e1" and json.loads(messages.value)["phone"] == "010-1234"
