"""Queries over bounded input, each with its SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from txlake.functions import text, times
from txlake.functions.money import exact_sum
from txlake.operators import fraud, gold, lateness, latest, lineage, profile, quality, reconcile
from txlake.operators import standardize as std
from txlake.operators import windows
from txlake.plans.inputs import (
    ARRIVALS_SQL,
    SETTLED_SQL,
    TX_SQL,
    arrivals,
    revenue,
    settled,
    transactions,
)
from txlake.plans.registry import query
from txlake.sources import kafka
from txlake.sources.files import table

WINDOW_TYPES = ["PAYMENT", "TRANSFER", "WITHDRAWAL", "SETTLEMENT"]
IN_WINDOW_TYPES = "tx_type IN ('PAYMENT', 'TRANSFER', 'WITHDRAWAL', 'SETTLEMENT')"

# -- gold aggregates ------------------------------------------------------------

DAILY_SQL = """
SELECT CAST(tx_date AS VARCHAR) AS summary_date, tx_type, COUNT(*) AS total_count,
  CAST(SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
  CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_count,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_amount,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) / COUNT(amount) AS avg_amount,
  MIN(amount) AS min_amount, MAX(amount) AS max_amount,
  COUNT(DISTINCT user_id) AS unique_users,
  CAST(SUM(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count
FROM tx GROUP BY tx_date, tx_type"""


@query("daily_summary", f"WITH {TX_SQL} {DAILY_SQL}")
def daily_summary(spark, folder):
    return gold.daily_summary(transactions(spark, folder))


STATS_SQL = """
SELECT user_id, strftime(tx_date, '%Y-%m') AS stats_month, COUNT(*) AS total_tx_count,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_amount,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) / COUNT(amount) AS avg_amount,
  COUNT(*) FILTER (WHERE tx_type = 'PAYMENT') AS payment_count,
  COUNT(*) FILTER (WHERE tx_type = 'REFUND') AS refund_count,
  COUNT(*) FILTER (WHERE tx_type = 'TRANSFER') AS transfer_count,
  COUNT(*) FILTER (WHERE is_anomaly) AS anomaly_count,
  CAST(MIN(tx_date) AS VARCHAR) AS first_tx_date, CAST(MAX(tx_date) AS VARCHAR) AS last_tx_date
FROM settled GROUP BY user_id, stats_month"""


@query("customer_month_stats", f"WITH {SETTLED_SQL} {STATS_SQL}")
def customer_month_stats(spark, folder):
    return gold.customer_month_stats(settled(spark, folder))


@query(
    "customer_top10_month",
    f"""WITH {SETTLED_SQL}, stats AS ({STATS_SQL})
SELECT user_id, total_amount, total_tx_count FROM stats WHERE stats_month = '1997-03'
ORDER BY total_amount DESC, user_id LIMIT 10""",
)
def customer_top10_month(spark, folder):
    month = gold.month_filter(F.col("tx_date"), dt.date(1997, 3, 1), dt.date(1997, 4, 1))
    stats = gold.customer_month_stats(settled(spark, folder).filter(month))
    top = gold.top_by(stats, "total_amount", 10, ["user_id"])
    return top.select("user_id", "total_amount", "total_tx_count")


PART_FEES = gold.FeeRates(
    rates={"ECONOMY": 0.015, "SMALL": 0.018, "MEDIUM": 0.022, "PROMO": 0.025, "LARGE": 0.010}
)
FEES_SQL = """
sums AS (
  SELECT p_brand AS merchant_id, p_type AS merchant_category,
    ROUND(SUM(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(28,8)) ELSE 0 END), 6) AS paid,
    ROUND(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(28,8)) ELSE 0 END), 6) AS refunded,
    COUNT(*) AS tx_count
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F' GROUP BY p_brand, p_type
), rated AS (
  SELECT *, paid - refunded AS net, CASE merchant_category WHEN 'ECONOMY' THEN 0.015 WHEN 'SMALL' THEN 0.018
    WHEN 'MEDIUM' THEN 0.022 WHEN 'PROMO' THEN 0.025 WHEN 'LARGE' THEN 0.010 ELSE 0.020 END AS rate FROM sums
), fees AS (
  SELECT merchant_id, merchant_category, CAST(paid AS DOUBLE) AS total_payment_amount,
    CAST(refunded AS DOUBLE) AS total_refund_amount, CAST(net AS DOUBLE) AS net_amount,
    CAST(rate AS DOUBLE) AS fee_rate, CAST(ROUND(CAST(net AS DECIMAL(24,6)) * CAST(rate AS DECIMAL(6,4)), 0) AS DOUBLE) AS fee_amount,
    CAST(net - ROUND(CAST(net AS DECIMAL(24,6)) * CAST(rate AS DECIMAL(6,4)), 0) AS DOUBLE) AS settlement_amount, tx_count
  FROM rated
)"""


@query("merchant_fee_settlement", f"WITH {FEES_SQL} SELECT * FROM fees")
def merchant_fee_settlement(spark, folder):
    return gold.fee_settlement(revenue(spark, folder), PART_FEES)


@query(
    "merchant_top10_net",
    f"""WITH {FEES_SQL} SELECT merchant_id, merchant_category, net_amount FROM fees
ORDER BY net_amount DESC, merchant_id, merchant_category LIMIT 10""",
)
def merchant_top10_net(spark, folder):
    fees = gold.fee_settlement(revenue(spark, folder), PART_FEES)
    top = gold.top_by(fees, "net_amount", 10, ["merchant_id", "merchant_category"])
    return top.select("merchant_id", "merchant_category", "net_amount")


@query(
    "fee_grand_total",
    f"""WITH {FEES_SQL} SELECT CAST(ROUND(SUM(CAST(fee_amount AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_fee FROM fees""",
)
def fee_grand_total(spark, folder):
    fees = gold.fee_settlement(revenue(spark, folder), PART_FEES)
    return fees.agg(exact_sum("fee_amount").alias("total_fee"))


@query(
    "daily_fee_settlement",
    f"""WITH {TX_SQL}, sums AS (
  SELECT tx_date, merchant_id, merchant_category,
    ROUND(SUM(CASE WHEN tx_type = 'PAYMENT' THEN CAST(amount AS DECIMAL(28,8)) ELSE 0 END), 6) AS paid,
    ROUND(SUM(CASE WHEN tx_type = 'REFUND' THEN CAST(amount AS DECIMAL(28,8)) ELSE 0 END), 6) AS refunded, COUNT(*) AS tx_count
  FROM tx WHERE merchant_id IS NOT NULL AND status = 'SUCCESS' GROUP BY ALL
), rated AS (SELECT *, CAST(paid - refunded AS DECIMAL(24,6)) AS net, CAST(CASE merchant_category WHEN 'F&B' THEN 0.015
    WHEN 'RETAIL' THEN 0.018 WHEN 'ONLINE' THEN 0.022 WHEN 'TRAVEL' THEN 0.025 WHEN 'FINANCE' THEN 0.010
    WHEN 'HEALTH' THEN 0.012 ELSE 0.020 END AS DECIMAL(6,4)) AS rate FROM sums)
SELECT CAST(tx_date AS VARCHAR) AS settlement_date, merchant_id, merchant_category,
  CAST(paid AS DOUBLE) AS total_payment_amount, CAST(refunded AS DOUBLE) AS total_refund_amount,
  CAST(net AS DOUBLE) AS net_amount, CAST(rate AS DOUBLE) AS fee_rate,
  CAST(ROUND(net * rate, 0) AS DOUBLE) AS fee_amount, CAST(net - ROUND(net * rate, 0) AS DOUBLE) AS settlement_amount, tx_count
FROM rated""",
)
def daily_fee_settlement(spark, folder):
    tx = transactions(spark, folder).withColumnRenamed("tx_date", "settlement_date")
    return gold.fee_settlement(tx, by=("settlement_date",))


LEDGER_SQL = """
SELECT currency, tx_type, COUNT(*) AS tx_count,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_amount FROM tx GROUP BY currency, tx_type"""


@query("settlement_ledger", f"WITH {TX_SQL} {LEDGER_SQL} ORDER BY currency, tx_type")
def settlement_ledger(spark, folder):
    return gold.ledger(transactions(spark, folder))


@query(
    "settlement_ledger_text",
    f"""WITH {TX_SQL}, ledger AS ({LEDGER_SQL})
SELECT currency, tx_type, rpad(currency, 6, ' ') || ' ' || rpad(tx_type, 12, ' ') || ' ' ||
  lpad(format('{{:,}}', tx_count), 8, ' ') || ' ' || lpad(format('{{:,}}', CAST(round_even(total_amount, 0) AS BIGINT)), 18, ' ') AS line
FROM ledger""",
)
def settlement_ledger_text(spark, folder):
    return gold.ledger_text(gold.ledger(transactions(spark, folder)))


@query(
    "user_features",
    f"""WITH {TX_SQL} SELECT user_id, COUNT(*) AS tx_count,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) / COUNT(amount) AS avg_amount FROM tx GROUP BY user_id""",
)
def user_features(spark, folder):
    return gold.user_features(transactions(spark, folder))


@query(
    "user_features_top5",
    f"""WITH {TX_SQL} SELECT user_id, COUNT(*) AS tx_count,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) / COUNT(amount) AS avg_amount FROM tx GROUP BY user_id
ORDER BY tx_count DESC, user_id LIMIT 5""",
)
def user_features_top5(spark, folder):
    return gold.top_by(gold.user_features(transactions(spark, folder)), "tx_count", 5, ["user_id"])


@query(
    "type_avg",
    f"""WITH {TX_SQL} SELECT tx_type, COUNT(*) AS tx_count,
  CAST(ROUND(CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) / COUNT(amount), 2) AS DOUBLE) AS avg_amount FROM tx GROUP BY tx_type""",
)
def type_avg(spark, folder):
    return gold.type_averages(transactions(spark, folder))


@query(
    "event_totals",
    f"""WITH {TX_SQL} SELECT tx_type, COUNT(*) AS total, COUNT(*) FILTER (WHERE status = 'SUCCESS') AS delivered,
  COUNT(*) FILTER (WHERE status = 'FAILED') AS failed, COUNT(*) FILTER (WHERE is_suspicious) AS suspicious
FROM tx GROUP BY tx_type""",
)
def event_totals(spark, folder):
    return gold.event_totals(transactions(spark, folder))


@query(
    "daily_kpis",
    f"""WITH {TX_SQL} SELECT '2024-01-15' AS kpi_date,
  COUNT(*) FILTER (WHERE tx_date = DATE '2024-01-15') AS total_transactions,
  COALESCE(CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))) FILTER (WHERE tx_date = DATE '2024-01-15'), 6) AS DOUBLE), 0.0) AS total_amount,
  COUNT(*) FILTER (WHERE tx_date = DATE '2024-01-15' AND is_anomaly) AS anomalies,
  COUNT(DISTINCT user_id) FILTER (WHERE strftime(tx_date, '%Y-%m') = '2024-01') AS active_customers FROM tx""",
)
def daily_kpis(spark, folder):
    tx = transactions(spark, folder)
    return gold.daily_kpis(
        gold.daily_summary(tx), gold.customer_month_stats(tx), dt.date(2024, 1, 15)
    )


@query(
    "watermark_bounds",
    """SELECT COALESCE(MIN(o_orderkey), 0) AS min_key, COALESCE(MAX(o_orderkey), 0) AS max_key,
  MAX(o_orderdate) AS last_change FROM orders""",
)
def watermark_bounds(spark, folder):
    return table(spark, folder, "orders").agg(
        F.coalesce(F.min("o_orderkey"), F.lit(0)).alias("min_key"),
        F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("max_key"),
        F.max("o_orderdate").alias("last_change"),
    )


# -- event-time windows -----------------------------------------------------------


def windows_sql(source: str, width: int, slide: int) -> str:
    """Windows of ``width`` seconds every ``slide`` seconds, from a relation with
    event_type, ts and amount."""
    return f"""
SELECT event_type, window_start, window_start + INTERVAL {width} SECOND AS window_end, COUNT(*) AS transaction_count,
  CAST(ROUND(SUM(CAST(COALESCE(amount, 0) AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_amount,
  CAST(ROUND(SUM(CAST(COALESCE(amount, 0) AS DECIMAL(28,8))), 6) AS DOUBLE) / COUNT(*) AS avg_amount,
  MAX(COALESCE(amount, 0)) AS max_amount, MIN(COALESCE(amount, 0)) AS min_amount
FROM (SELECT tx_type AS event_type, amount,
    time_bucket(INTERVAL {slide} SECOND, ts) - UNNEST(generate_series(0, {width - slide}, {slide})) * INTERVAL 1 SECOND AS window_start
  FROM {source} WHERE {IN_WINDOW_TYPES})
GROUP BY event_type, window_start"""


def window_input(tx):
    return tx.filter(F.col("tx_type").isin(WINDOW_TYPES)).withColumnRenamed("tx_type", "event_type")


@query("tumbling_by_type", f"WITH {TX_SQL} {windows_sql('tx', 300, 300)}")
def tumbling_by_type(spark, folder):
    return windows.tumbling(window_input(transactions(spark, folder)), "ts", ["event_type"], 300, "amount")


@query("sliding_by_type", f"WITH {TX_SQL} {windows_sql('tx', 300, 60)}")
def sliding_by_type(spark, folder):
    return windows.sliding(window_input(transactions(spark, folder)), "ts", ["event_type"], 300, 60, "amount")


ISO_MILLIS = "'%Y-%m-%dT%H:%M:%S.%gZ'"


@query(
    "window_messages",
    f"""WITH {TX_SQL}, w AS ({windows_sql('tx', 3600, 3600)})
SELECT event_type, strftime(window_start, {ISO_MILLIS}) AS window_start, strftime(window_end, {ISO_MILLIS}) AS window_end,
  transaction_count, ROUND(total_amount) AS total_amount, ROUND(avg_amount) AS avg_amount,
  ROUND(max_amount) AS max_amount, ROUND(min_amount) AS min_amount FROM w""",
)
def window_messages(spark, folder):
    rows = window_input(transactions(spark, folder))
    return windows.window_messages(windows.tumbling(rows, "ts", ["event_type"], 3600, "amount"))


SESSION_GAP = 6 * 3600


def sessions_sql(source: str, gap: int) -> str:
    return f"""
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL {gap} SECOND AS session_end, COUNT(*) AS tx_count,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_amount, MAX(ts) AS last_event
FROM (SELECT *, SUM(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
  FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL {gap} SECOND THEN 1 ELSE 0 END AS is_new
    FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
GROUP BY user_id, s"""


@query(
    "session_by_user",
    f"""WITH {TX_SQL}, s AS ({sessions_sql('tx', SESSION_GAP)})
SELECT user_id, session_start, session_end, tx_count, total_amount FROM s""",
)
def session_by_user(spark, folder):
    return windows.sessions(transactions(spark, folder), "ts", "user_id", SESSION_GAP, "amount")


@query(
    "session_text",
    f"""WITH {TX_SQL}, s AS ({sessions_sql('tx', SESSION_GAP)})
SELECT 'user=' || user_id || ' | session=[' || strftime(session_start, {ISO_MILLIS}) || ', ' || strftime(session_end, {ISO_MILLIS})
  || '] | count=' || tx_count || ' | total=' || CAST(ROUND(total_amount) AS BIGINT) AS line FROM s""",
)
def session_text(spark, folder):
    found = windows.sessions(transactions(spark, folder), "ts", "user_id", SESSION_GAP, "amount")
    return windows.session_text(found, "user_id")


@query(
    "inactivity_gaps",
    f"""WITH {TX_SQL}, g AS (SELECT user_id, ts AS silent_since, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS resumed_at FROM tx)
SELECT *, epoch_us(resumed_at) // 1000000 * 0 + (epoch_us(resumed_at) - epoch_us(silent_since)) // 1000000 AS silent_seconds
FROM g WHERE resumed_at > silent_since + INTERVAL {SESSION_GAP} SECOND""",
)
def inactivity_gaps(spark, folder):
    return windows.inactivity_gaps(transactions(spark, folder), "ts", "user_id", SESSION_GAP)


# -- late rows --------------------------------------------------------------------


def closed_sql(relation: str) -> str:
    """Rows with the watermark they met: least of the partitions' running maxima."""
    parts = ", ".join(
        f"""MAX(CASE WHEN topic_partition = {p} THEN ts END) OVER (ORDER BY arrival
      RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm{p}"""
        for p in range(4)
    )
    return f"""
seen AS (SELECT *, {parts} FROM {relation}),
marked AS (SELECT *, CASE WHEN wm0 IS NULL OR wm1 IS NULL OR wm2 IS NULL OR wm3 IS NULL THEN NULL
  ELSE LEAST(wm0, wm1, wm2, wm3) - INTERVAL 15 SECOND END AS passed FROM seen)"""


@query(
    "late_split_dlq",
    f"""WITH {ARRIVALS_SQL}, {closed_sql('arrivals')}
SELECT event_id, tx_type, user_id, amount, ts, 'tumbling' AS late_for FROM marked
WHERE time_bucket(INTERVAL 300 SECOND, ts) + INTERVAL 300 SECOND <= passed
UNION ALL
SELECT event_id, tx_type, user_id, amount, ts, 'sliding' FROM marked
WHERE time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 300 SECOND <= passed""",
)
def late_split_dlq(spark, folder):
    paths = {"tumbling": (300, 300), "sliding": (300, 60)}
    marked = lateness.mark_late(arrivals(spark, folder), "ts", "arrival", "topic_partition", paths)
    late = lateness.dead_letters(marked)
    return late.select("event_id", "tx_type", "user_id", "amount", "ts", "late_for")


# A topic partition counts as idle after two days without an arrival.
IDLE = 2 * 86_400 * 1_000_000

SILENT = "topic_partition = 3 AND (day(ts) BETWEEN 8 AND 14 OR day(ts) < 4)"


def idle_sql(relation: str) -> str:
    """Rows with the watermark they met: the largest so far of the least mark of the partitions awake."""
    last = ", ".join(
        f"""MAX(CASE WHEN p = {p} THEN ts END) OVER w AS wm{p},
    COALESCE(MAX(CASE WHEN p = {p} THEN tick END) OVER w, (SELECT MIN(arrival) FROM {relation})) + {IDLE} > tick AS awake{p}"""
        for p in range(4)
    )
    least = "LEAST(" + ", ".join(f"CASE WHEN awake{p} THEN COALESCE(wm{p}, TIMESTAMP '1900-01-01') ELSE TIMESTAMP '2900-01-01' END" for p in range(4)) + ")"
    return f"""
ticks AS (SELECT arrival AS tick, topic_partition AS p, ts FROM {relation} UNION ALL SELECT arrival + {IDLE}, NULL, NULL FROM {relation}
  UNION ALL SELECT MIN(arrival) + {IDLE}, NULL, NULL FROM {relation}),
states AS (SELECT tick, {last} FROM ticks WINDOW w AS (ORDER BY tick RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
lows AS (SELECT DISTINCT tick, {least} AS low FROM states),
marks AS (SELECT tick, MAX(CASE WHEN low < TIMESTAMP '2900-01-01' THEN low END) OVER (ORDER BY tick) - INTERVAL 15 SECOND AS passed FROM lows),
marked AS (SELECT a.*, m.passed FROM {relation} a ASOF LEFT JOIN marks m ON m.tick < a.arrival)"""


@query(
    "late_split_idle",
    f"""WITH {ARRIVALS_SQL}, heard AS (SELECT * FROM arrivals WHERE NOT ({SILENT})), {idle_sql('heard')}
SELECT event_id, tx_type, user_id, amount, ts, 'tumbling' AS late_for FROM marked
WHERE time_bucket(INTERVAL 300 SECOND, ts) + INTERVAL 300 SECOND <= passed
UNION ALL
SELECT event_id, tx_type, user_id, amount, ts, 'sliding' FROM marked
WHERE time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 300 SECOND <= passed""",
)
def late_split_idle(spark, folder):
    """A topic partition that is silent at first and for a week later holds back nothing after two days."""
    paths = {"tumbling": (300, 300), "sliding": (300, 60)}
    rows = arrivals(spark, folder)
    silent = F.col("topic_partition").eqNullSafe(3) & (F.dayofmonth("ts").between(8, 14) | (F.dayofmonth("ts") < 4))
    marked = lateness.mark_late(rows.filter(~silent), "ts", "arrival", "topic_partition", paths, idle=IDLE)
    return lateness.dead_letters(marked).select("event_id", "tx_type", "user_id", "amount", "ts", "late_for")


def on_time_sql(width: int, slide: int) -> str:
    return f"""WITH {ARRIVALS_SQL}, {closed_sql('arrivals')},
placed AS (SELECT *, time_bucket(INTERVAL {slide} SECOND, ts)
    - UNNEST(generate_series(0, {width - slide}, {slide})) * INTERVAL 1 SECOND AS window_start FROM marked)
SELECT tx_type, window_start, window_start + INTERVAL {width} SECOND AS window_end, COUNT(*) AS transaction_count,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_amount,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) / COUNT(*) AS avg_amount,
  MAX(amount) AS max_amount, MIN(amount) AS min_amount
FROM placed WHERE passed IS NULL OR window_start + INTERVAL {width} SECOND > passed
GROUP BY tx_type, window_start"""


@query("tumbling_without_late", on_time_sql(300, 300))
def tumbling_without_late(spark, folder):
    return lateness.windows_without_late(
        arrivals(spark, folder), "ts", "arrival", "topic_partition", ["tx_type"], 300, "amount"
    )


@query("sliding_without_late", on_time_sql(300, 60))
def sliding_without_late(spark, folder):
    return lateness.windows_without_late(
        arrivals(spark, folder), "ts", "arrival", "topic_partition", ["tx_type"], 300, "amount", 60
    )


# -- fraud ------------------------------------------------------------------------

# Limits that fit the amounts and the density of the events table.
EVENT_RULES = fraud.AlertRules(
    span_seconds=6 * 3600, high_amount=200.0, burst_count=3, sum_amount=300.0, block_seconds=48 * 3600
)
EVENT_RECORD_RULES = fraud.RecordRules(thresholds={"KRW": 150.0, "USD": 100.0, "JPY": 80.0})

ALERTS_SQL = """
totals AS (
  SELECT t.*, (SELECT COUNT(*) FROM tx p WHERE p.user_id = t.user_id AND p.ts >= t.ts - INTERVAL 21600 SECOND
      AND (p.ts < t.ts OR (p.ts = t.ts AND p.event_id <= t.event_id))) AS n,
    (SELECT CAST(ROUND(SUM(CAST(p.amount AS DECIMAL(28,8))), 6) AS DOUBLE) FROM tx p WHERE p.user_id = t.user_id AND p.ts >= t.ts - INTERVAL 21600 SECOND
      AND (p.ts < t.ts OR (p.ts = t.ts AND p.event_id <= t.event_id))) AS total
  FROM tx t
), raised AS (
  SELECT *, 'RULE-002' AS rule_id, '단건 200원 초과 거래' AS rule_description, 'HIGH' AS severity, amount AS trigger_amount, 1 AS event_count
  FROM totals WHERE amount >= 200
  UNION ALL
  SELECT *, 'RULE-001', '360분 내 ' || n || '건 연속 거래', 'HIGH', amount, n FROM totals WHERE n >= 3
  UNION ALL
  SELECT *, 'RULE-003', '360분 내 거래 합계 ' || CAST(ROUND(total) AS BIGINT) || '원 초과', 'MEDIUM', total, n FROM totals WHERE total > 300
), alerts AS (
  SELECT 'ALERT-' || sha256(rule_id || '|' || CAST(event_id AS VARCHAR)) AS alert_id, rule_id, rule_description, user_id, severity,
    CAST(event_id AS VARCHAR) AS trigger_event_id, trigger_amount, event_count, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS detected_at FROM raised
)"""


@query("trailing_fraud_alerts", f"WITH {TX_SQL}, {ALERTS_SQL} SELECT * FROM alerts")
def trailing_fraud_alerts(spark, folder):
    return fraud.user_alerts(transactions(spark, folder), EVENT_RULES)


@query("trailing_alerts_by_panes", f"WITH {TX_SQL}, {ALERTS_SQL} SELECT * FROM alerts")
def trailing_alerts_by_panes(spark, folder):
    """Users with more than two events in two days go the way of very busy ones."""
    return fraud.user_alerts(transactions(spark, folder), EVENT_RULES, hot_rows=2)


@query(
    "alert_text",
    f"""WITH {TX_SQL}, {ALERTS_SQL} SELECT alert_id, '[' || rule_id || '] ' || rule_description || ' | user=' || user_id || ', severity='
  || severity || ',amount=' || CAST(ROUND(trigger_amount) AS BIGINT) || ', events=' || event_count AS line FROM alerts""",
)
def alert_text(spark, folder):
    alerts = fraud.user_alerts(transactions(spark, folder), EVENT_RULES)
    return alerts.select("alert_id", fraud.alert_text().alias("line"))


@query(
    "serving_latest_alert",
    f"""WITH {TX_SQL}, {ALERTS_SQL} SELECT * FROM alerts
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY detected_at DESC, alert_id DESC) = 1""",
)
def serving_latest_alert(spark, folder):
    return latest.latest_alert_per_user(fraud.user_alerts(transactions(spark, folder), EVENT_RULES))


@query(
    "serving_alert_count",
    f"WITH {TX_SQL}, {ALERTS_SQL} SELECT user_id, COUNT(*) AS alert_count FROM alerts GROUP BY user_id",
)
def serving_alert_count(spark, folder):
    return latest.alert_count_per_user(fraud.user_alerts(transactions(spark, folder), EVENT_RULES))


@query(
    "serving_recent_alerts",
    f"WITH {TX_SQL}, {ALERTS_SQL} SELECT * FROM alerts ORDER BY detected_at DESC, alert_id DESC LIMIT 100",
)
def serving_recent_alerts(spark, folder):
    return latest.most_recent(fraud.user_alerts(transactions(spark, folder), EVENT_RULES))


RISK_SQL = """
risk AS (
  SELECT *, CASE currency WHEN 'KRW' THEN 150.0 WHEN 'USD' THEN 100.0 WHEN 'JPY' THEN 80.0 END AS lim FROM tx
), judged AS (
  SELECT *, list_filter([CASE WHEN is_suspicious THEN '프로듀서 이상 플래그' END,
    CASE WHEN amount > lim THEN '고액 거래(' || currency || ' ' || format('{:,}', CAST(round_even(amount, 0) AS BIGINT)) || ')' END,
    CASE WHEN tx_type = 'WITHDRAWAL' AND channel = 'ATM' AND amount > lim * 0.5 THEN 'ATM 고액 출금' END], lambda x: x IS NOT NULL) AS reasons FROM risk
)"""


@query(
    "record_risk_rules",
    f"""WITH {TX_SQL}, {RISK_SQL}
SELECT tx_id, user_id, amount, currency, array_to_string(reasons, ', ') AS reasons,
  CASE WHEN len(reasons) >= 2 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level FROM judged WHERE len(reasons) > 0""",
)
def record_risk_rules(spark, folder):
    found = fraud.record_alerts(transactions(spark, folder), EVENT_RECORD_RULES)
    return found.withColumn("reasons", F.array_join("reasons", ", "))


@query(
    "record_alert_rate",
    f"""WITH {TX_SQL}, {RISK_SQL} SELECT COUNT(*) AS processed, COUNT(*) FILTER (WHERE len(reasons) > 0) AS alerts,
  ROUND(CAST(COUNT(*) FILTER (WHERE len(reasons) > 0) AS DOUBLE) * 100 / COUNT(*), 2) AS alert_rate FROM judged""",
)
def record_alert_rate(spark, folder):
    return fraud.record_rates(transactions(spark, folder), EVENT_RECORD_RULES)


# -- standardisation ----------------------------------------------------------------


def api_rows(spark, folder):
    """Events in the shape of the payment API; an error event has an unreadable
    user, an event without value has lost its id."""
    e = table(spark, folder, "events")
    broken = F.col("event_type") == "error"
    return e.select(
        F.when(F.col("value") > 0, F.concat(F.lit("EV-"), F.col("event_id").cast("string"))).alias("event_id"),
        F.upper("event_type").alias("event_type"),
        F.when(broken, F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        money_text("value").alias("amount"),
        F.lit("KRW").alias("currency"),
        F.struct(
            F.get_json_object("props", "$.k").alias("id"),
            F.lit("shop").alias("name"),
            F.lit("RETAIL").alias("category"),
        ).alias("merchant"),
        F.lit("APP").alias("channel"),
        F.lit("SUCCESS").alias("status"),
        F.when(F.col("value") > 150, "true").otherwise("false").alias("is_suspicious"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+09:00")).alias("timestamp"),
        F.lit("payment-api").alias("source"),
    )


def money_text(name):
    return F.col(name).cast("decimal(18,2)").cast("string")


def settlement_rows(spark, folder):
    """Orders in the shape of the settlement file."""
    o = table(spark, folder, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return o.select(
        F.concat(F.lit("ST-"), F.col("o_orderkey").cast("string")).alias("settlement_id"),
        F.concat(F.lit("B-"), F.date_format("o_orderdate", "yyyyMMdd")).alias("batch_id"),
        F.concat(F.lit("M-"), F.col("o_custkey").cast("string")).alias("merchant_id"),
        F.lit("shop").alias("merchant_name"),
        F.lit("RETAIL").alias("merchant_category"),
        F.lit("DAILY_CLOSE").alias("settlement_type"),
        price.cast("string").alias("gross_amount"),
        F.lit("0.00").alias("fee_amount"),
        price.cast("string").alias("net_amount"),
        F.lit("KRW").alias("currency"),
        # Priorities such as "4-NOT SPECIFIED" make the count unreadable.
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.col("o_orderpriority"))
        .otherwise(F.substring("o_orderpriority", 1, 1))
        .alias("tx_count"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("settlement_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.col("o_orderstatus").alias("status"),
    )


def customer_rows(spark, folder):
    """Customers in the shape of the customer table."""
    c = table(spark, folder, "customer")
    return c.select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        F.col("c_custkey").cast("int").alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("c_mktsegment").alias("grade"),
        (F.col("c_acctbal") > 0).alias("is_active"),
        F.lit("2024-01-01 00:00:00").alias("created_at"),
        F.lit("2024-01-02 03:04:05.000006").alias("updated_at"),
    )


LOADED_AT = "2024-02-01T00:00:00Z"
CANON_SQL = f"""
api AS (
  SELECT CASE WHEN value > 0 THEN 'EV-' || event_id END AS event_id, upper(event_type) AS event_type,
    CASE WHEN event_type = 'error' THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount, 'KRW' AS currency, json_extract_string(props, '$.k') AS merchant_id,
    'shop' AS merchant_name, 'RETAIL' AS merchant_category, 'APP' AS channel, 'SUCCESS' AS status,
    CASE WHEN value > 150 THEN 'true' ELSE 'false' END AS is_suspicious, strftime(ts - INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp,
    '{LOADED_AT}' AS ingested_at, 'payment-api' AS data_source, '1.0' AS schema_version, NULL AS created_at, NULL AS fee_amount, NULL AS net_amount,
    NULL AS tx_count, NULL AS batch_id, NULL AS customer_name, NULL AS customer_email, CAST(NULL AS VARCHAR) AS customer_phone, NULL AS customer_grade,
    NULL AS is_active, 'payment-api' AS source_system
  FROM events
), files AS (
  SELECT 'ST-' || o_orderkey AS event_id, 'DAILY_CLOSE' AS event_type, NULL AS user_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
    'KRW' AS currency, 'M-' || o_custkey AS merchant_id, 'shop' AS merchant_name, 'RETAIL' AS merchant_category, 'BATCH' AS channel,
    o_orderstatus AS status, 'false' AS is_suspicious, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS event_timestamp,
    '{LOADED_AT}' AS ingested_at, 'settlement-csv' AS data_source, '1.0' AS schema_version, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created_at,
    '0.00' AS fee_amount, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS net_amount,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderpriority ELSE substr(o_orderpriority, 1, 1) END AS tx_count,
    'B-' || strftime(o_orderdate, '%Y%m%d') AS batch_id, NULL AS customer_name, NULL AS customer_email, CAST(NULL AS VARCHAR) AS customer_phone,
    NULL AS customer_grade, NULL AS is_active, 'settlement-csv' AS source_system
  FROM orders
), people AS (
  SELECT CAST(c_custkey AS VARCHAR) AS event_id, 'CUSTOMER_UPDATE' AS event_type, CAST(c_custkey AS VARCHAR) AS user_id, NULL AS amount,
    NULL AS currency, NULL AS merchant_id, NULL AS merchant_name, NULL AS merchant_category, 'DB_SYNC' AS channel, NULL AS status,
    'false' AS is_suspicious, '2024-01-02T03:04:05Z' AS event_timestamp, '{LOADED_AT}' AS ingested_at, 'customer-db' AS data_source,
    '1.0' AS schema_version, '2024-01-01 00:00:00' AS created_at, NULL AS fee_amount, NULL AS net_amount, NULL AS tx_count, NULL AS batch_id,
    c_name AS customer_name, lower(c_name) || '@example.com' AS customer_email, CAST(NULL AS VARCHAR) AS customer_phone, c_mktsegment AS customer_grade,
    CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END AS is_active, 'customer-db' AS source_system
  FROM customer
), canon AS (SELECT * FROM api UNION ALL SELECT * FROM files UNION ALL SELECT * FROM people),
checked AS (
  SELECT *, list_filter([CASE WHEN event_id IS NULL THEN 'missing:event_id' END,
    CASE WHEN user_id IS NOT NULL AND TRY_CAST(user_id AS INTEGER) IS NULL THEN 'type:user_id' END,
    CASE WHEN tx_count IS NOT NULL AND TRY_CAST(tx_count AS INTEGER) IS NULL THEN 'type:tx_count' END], lambda x: x IS NOT NULL) AS errors FROM canon
)"""


def standard_rows(spark, folder):
    at = F.lit(LOADED_AT)
    return std.fan_in(
        std.from_api(api_rows(spark, folder), at),
        std.from_settlement(settlement_rows(spark, folder), at),
        std.from_customer(customer_rows(spark, folder), at),
    )


@query("standardize_union", f"WITH {CANON_SQL} SELECT * FROM canon")
def standardize_union(spark, folder):
    return standard_rows(spark, folder)


@query(
    "validation_valid",
    f"""WITH {CANON_SQL} SELECT event_id, event_type, CAST(user_id AS INTEGER) AS user_id, CAST(amount AS DOUBLE) AS amount, merchant_id,
  CAST(is_suspicious AS BOOLEAN) AS is_suspicious, event_timestamp, data_source, CAST(fee_amount AS DOUBLE) AS fee_amount,
  CAST(tx_count AS INTEGER) AS tx_count, CAST(is_active AS BOOLEAN) AS is_active, source_system FROM checked WHERE len(errors) = 0""",
)
def validation_valid(spark, folder):
    good, _ = std.split_valid(std.validate(standard_rows(spark, folder)))
    return good.select(
        "event_id", "event_type", "user_id", "amount", "merchant_id", "is_suspicious", "event_timestamp",
        "data_source", "fee_amount", "tx_count", "is_active", "source_system",
    )


@query(
    "validation_split",
    f"""WITH {CANON_SQL} SELECT event_id, event_type, user_id, tx_count, array_to_string(errors, ',') AS errors,
  'events.dlq' AS kafka_topic, event_id AS kafka_key, 'etl' AS source_group FROM checked WHERE len(errors) > 0""",
)
def validation_split(spark, folder):
    checked = std.validate(standard_rows(spark, folder))
    routed = std.routed(checked, "events.ingested", "events.dlq", "etl", F.lit(LOADED_AT))
    return routed.filter("validation_status = 'invalid'").select(
        "event_id",
        "event_type",
        "user_id",
        "tx_count",
        F.array_join("validation_errors", ",").alias("errors"),
        "kafka_topic",
        "kafka_key",
        "source_group",
    )


@query(
    "validation_counts",
    f"""WITH {CANON_SQL} SELECT data_source, COUNT(*) FILTER (WHERE len(errors) = 0) AS valid_rows,
  COUNT(*) FILTER (WHERE len(errors) > 0) AS invalid_rows FROM checked GROUP BY data_source""",
)
def validation_counts(spark, folder):
    checked = std.validate(standard_rows(spark, folder))
    good = F.col("validation_status") == "valid"
    return checked.groupBy("data_source").agg(
        F.count_if(good).alias("valid_rows"), F.count_if(~good).alias("invalid_rows")
    )


@query(
    "core_fields_split",
    """WITH d AS (SELECT CASE WHEN value > 0 THEN CAST(event_id AS VARCHAR) END AS event_id, event_type,
  CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS user_id FROM events)
SELECT event_type, COUNT(*) FILTER (WHERE event_id IS NOT NULL AND user_id IS NOT NULL) AS matched,
  COUNT(*) FILTER (WHERE event_id IS NULL OR user_id IS NULL) AS unmatched FROM d GROUP BY event_type""",
)
def core_fields_split(spark, folder):
    e = table(spark, folder, "events")
    document = F.to_json(
        F.struct(
            F.when(F.col("value") > 0, F.col("event_id")).alias("event_id"),
            "event_type",
            F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
            F.col("value").alias("amount"),
            F.col("ts").alias("timestamp"),
        )
    )
    found = std.core_fields(e.select(document.alias("document")), "document")
    kind = F.get_json_object("document", "$.event_type").alias("event_type")
    return found.groupBy(kind).agg(
        F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("unmatched")
    )


@query(
    "timestamp_normalize",
    """SELECT event_id, strftime(ts - INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS from_offset,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS from_naive_micros, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS from_naive_seconds,
  strftime(ts, '%Y-%m-%dT00:00:00Z') AS from_day, event_type AS unreadable,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS millis, strftime(ts, '%Y-%m') AS month_key, CAST(hour(ts) AS INTEGER) AS tx_hour FROM events""",
)
def timestamp_normalize(spark, folder):
    e = table(spark, folder, "events")
    offset = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+09:00"))
    return e.select(
        "event_id",
        times.normalize_offset_timestamp(offset).alias("from_offset"),
        times.normalize_naive_timestamp(F.date_format("ts", times.NAIVE_MICROS)).alias("from_naive_micros"),
        times.normalize_naive_timestamp(F.date_format("ts", times.NAIVE_SECONDS)).alias("from_naive_seconds"),
        times.normalize_day(F.date_format("ts", "yyyy-MM-dd")).alias("from_day"),
        times.normalize_offset_timestamp(F.col("event_type")).alias("unreadable"),
        times.iso_millis(F.col("ts")).alias("millis"),
        times.month_key(F.col("ts")).alias("month_key"),
        F.hour("ts").alias("tx_hour"),
    )


@query(
    "mask_pii",
    r"""SELECT doc_id, lang, regexp_replace(regexp_replace(text, '([0-9]{4})[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?([0-9]{4})', '\1-****-****-\2', 'g'),
  '[A-Za-z0-9._+-]+@([A-Za-z0-9-]+[.][A-Za-z0-9.-]*[A-Za-z0-9])', '***@\1', 'g') AS text FROM documents""",
)
def mask_pii(spark, folder):
    masked = {"text": text.mask_emails(text.mask_cards(F.col("text")))}
    return std.partner_view(table(spark, folder, "documents"), masked, ["source", "n_chars"])


TOPICS = {
    "PAYMENT": "transactions.payment",
    "TRANSFER": "transactions.transfer",
    "WITHDRAWAL": "transactions.withdrawal",
}


@query(
    "route_by_type",
    f"""WITH {TX_SQL} SELECT CASE tx_type WHEN 'PAYMENT' THEN 'transactions.payment' WHEN 'TRANSFER' THEN 'transactions.transfer'
  WHEN 'WITHDRAWAL' THEN 'transactions.withdrawal' ELSE 'transactions.other' END AS topic, CAST(user_id AS VARCHAR) AS key, COUNT(*) AS messages
FROM tx GROUP BY ALL""",
)
def route_by_type(spark, folder):
    tx = transactions(spark, folder).select("tx_id", "user_id", "tx_type", "amount", "currency")
    topic = kafka.topic_by_type(F.col("tx_type"), TOPICS, "transactions.other")
    return kafka.keyed_messages(tx, topic, F.col("user_id")).groupBy("topic", "key").agg(
        F.count("value").alias("messages")
    )


# -- quality ------------------------------------------------------------------------

AS_OF = dt.datetime(2024, 1, 20)
EVENT_QUALITY = [
    {"id": "CMP-001", "type": "completeness", "severity": "critical", "fields": ["tx_id", "merchant_id", "timestamp"]},
    {"id": "UNQ-001", "type": "uniqueness", "severity": "critical", "key_fields": ["user_id", "k"], "strategy": "keep_latest"},
    {"id": "VLD-001", "type": "validity", "severity": "critical", "field": "tx_type",
     "allowed_values": ["PAYMENT", "REFUND", "TRANSFER", "WITHDRAWAL"]},
    {"id": "VLD-002", "type": "validity", "severity": "warning", "field": "amount", "min_value": 10, "max_value": 150},
    {"id": "VLD-003", "type": "validity", "severity": "critical", "field": "status", "allowed_values": ["SUCCESS", "PENDING"]},
    {"id": "VLD-004", "type": "validity", "severity": "critical", "field": "amount", "min_value": 0},
    {"id": "TML-001", "type": "timeliness", "severity": "warning", "field": "timestamp", "max_delay_hours": 48},
]

QUALITY_SQL = f"""{TX_SQL}, base AS (
  SELECT *, merchant_id IS NULL AS cmp1, tx_type NOT IN ('PAYMENT', 'REFUND', 'TRANSFER', 'WITHDRAWAL') AS vld1,
    amount < 10 OR amount > 150 AS vld2, status NOT IN ('SUCCESS', 'PENDING') AS vld3, amount < 0 AS vld4,
    ts < TIMESTAMP '2024-01-20' - INTERVAL 48 HOUR AS tml1 FROM tx
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY (cmp1 OR vld1 OR vld3 OR vld4), ts DESC, event_id DESC) > 1 AS unq1 FROM base
), evaluated AS (
  SELECT *, list_filter([CASE WHEN cmp1 THEN 'CMP-001' END, CASE WHEN unq1 THEN 'UNQ-001' END, CASE WHEN vld1 THEN 'VLD-001' END,
      CASE WHEN vld3 THEN 'VLD-003' END, CASE WHEN vld4 THEN 'VLD-004' END], lambda x: x IS NOT NULL) AS critical,
    list_filter([CASE WHEN vld2 THEN 'VLD-002' END, CASE WHEN tml1 THEN 'TML-001' END], lambda x: x IS NOT NULL) AS warning FROM placed
)"""


def evaluated(spark, folder):
    rows = transactions(spark, folder).withColumnRenamed("ts", "event_timestamp").drop("is_anomaly")
    moment = F.lit(AS_OF).cast("timestamp_ntz")
    return quality.evaluate(rows, EVENT_QUALITY, moment, ["event_timestamp", "event_id"])


@query(
    "quality_flags",
    f"""WITH {QUALITY_SQL} SELECT tx_id, user_id, amount, len(warning) > 0 AS is_anomaly,
  CASE WHEN len(warning) > 0 THEN array_to_string(warning, ',') END AS quality_flags FROM evaluated WHERE len(critical) = 0""",
)
def quality_flags(spark, folder):
    return quality.clean_rows(evaluated(spark, folder)).select(
        "tx_id", "user_id", "amount", "is_anomaly", "quality_flags"
    )


@query(
    "quality_quarantine",
    f"""WITH {QUALITY_SQL} SELECT tx_id, user_id, amount, array_to_string(critical, ',') AS violated,
  array_to_string(warning, ',') AS warnings FROM evaluated WHERE len(critical) > 0""",
)
def quality_quarantine(spark, folder):
    return quality.quarantined_rows(evaluated(spark, folder)).select(
        "tx_id",
        "user_id",
        "amount",
        F.array_join("critical_violations", ",").alias("violated"),
        F.array_join("warning_violations", ",").alias("warnings"),
    )


def _rule_sql(rule_id: str, severity: str, flag: str) -> str:
    return f"""SELECT '{rule_id}' AS rule_id, '{severity}' AS severity, COUNT(*) AS total_records,
  COUNT(*) FILTER (WHERE {flag}) AS failed_records, COUNT(*) FILTER (WHERE NOT {flag}) AS passed_records,
  CAST(COUNT(*) FILTER (WHERE NOT {flag}) AS DOUBLE) / COUNT(*) AS pass_rate,
  CASE WHEN CAST(COUNT(*) FILTER (WHERE NOT {flag}) AS DOUBLE) / COUNT(*) >= 0.99 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM evaluated"""


RULE_FLAGS = [
    ("CMP-001", "critical", "cmp1"),
    ("UNQ-001", "critical", "unq1"),
    ("VLD-001", "critical", "vld1"),
    ("VLD-002", "warning", "vld2"),
    ("VLD-003", "critical", "vld3"),
    ("VLD-004", "critical", "vld4"),
    ("TML-001", "warning", "tml1"),
]


@query("quality_report", f"WITH {QUALITY_SQL} " + " UNION ALL ".join(_rule_sql(*r) for r in RULE_FLAGS))
def quality_report(spark, folder):
    return quality.report(evaluated(spark, folder), EVENT_QUALITY).drop("rule_name")


@query(
    "quality_totals",
    f"""WITH {QUALITY_SQL} SELECT COUNT(*) AS total_input_records, COUNT(*) FILTER (WHERE len(critical) = 0) AS total_output_records,
  COUNT(*) FILTER (WHERE len(critical) > 0) AS quarantined_records,
  COUNT(*) FILTER (WHERE len(critical) = 0 AND len(warning) > 0) AS flagged_records FROM evaluated""",
)
def quality_totals(spark, folder):
    return quality.totals(evaluated(spark, folder))


@query(
    "quality_gates",
    f"""WITH {QUALITY_SQL}, c AS (SELECT COUNT(*) AS b, COUNT(*) FILTER (WHERE len(critical) = 0) AS s, COUNT(*) FILTER (WHERE len(critical) > 0) AS q FROM evaluated)
SELECT 'quarantine_rate' AS gate, CAST(q AS DOUBLE) / b AS observed, CAST(q AS DOUBLE) / b <= 0.05 AS ok FROM c
UNION ALL SELECT 'bronze_to_silver_loss', CAST(b - s AS DOUBLE) / b, CAST(b - s AS DOUBLE) / b <= 0.10 FROM c
UNION ALL SELECT 'gold_rows', CAST(s AS DOUBLE), s > 0 FROM c""",
)
def quality_gates(spark, folder):
    counts = quality.totals(evaluated(spark, folder))
    rows = {c: F.col(c) for c in counts.columns}
    return quality.gates(
        counts,
        rows["total_input_records"],
        rows["total_output_records"],
        rows["quarantined_records"],
        rows["total_output_records"],
    )


@query(
    "dedupe_keep_latest",
    f"""WITH {TX_SQL} SELECT user_id, tx_type, tx_id, amount, ts FROM tx
QUALIFY row_number() OVER (PARTITION BY user_id, tx_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def dedupe_keep_latest(spark, folder):
    rows = transactions(spark, folder).select("user_id", "tx_type", "tx_id", "amount", "ts", "event_id")
    found = latest.keep_latest(rows, ["user_id", "tx_type"], [F.desc("ts"), F.desc("event_id")])
    return found.drop("event_id")


@query(
    "duplicate_excess",
    """SELECT COUNT(*) AS duplicate_keys, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows
FROM (SELECT user_id, props, COUNT(*) AS n FROM events GROUP BY ALL HAVING COUNT(*) > 1)""",
)
def duplicate_excess(spark, folder):
    return latest.duplicate_excess(table(spark, folder, "events"), ["user_id", "props"])


@query(
    "content_filter",
    "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+[.]')",
)
def content_filter(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.filter(F.col("text").rlike("[A-Za-z0-9._+-]+@[A-Za-z0-9-]+[.]")).select("doc_id", "lang")


# -- profiles -------------------------------------------------------------------------

PROFILE_COLUMNS = ["event_id", "tx_id", "user_id", "tx_type", "amount", "currency", "merchant_id", "merchant_category"]


@query(
    "null_profile",
    f"WITH {TX_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, COUNT(*) AS row_count FROM tx"
        for c in PROFILE_COLUMNS
    ),
)
def null_profile(spark, folder):
    return profile.null_profile(transactions(spark, folder).select(*PROFILE_COLUMNS))


@query(
    "counts_by_key",
    f"""WITH {TX_SQL} SELECT CAST(tx_date AS VARCHAR) AS tx_date, tx_type, COUNT(*) AS row_count FROM tx
GROUP BY tx_date, tx_type ORDER BY tx_date, tx_type""",
)
def counts_by_key(spark, folder):
    return profile.count_by(transactions(spark, folder), "tx_date", "tx_type").orderBy("tx_date", "tx_type")


COUNTED = ["customer", "part", "orders", "lineitem", "events", "supplier"]


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in COUNTED),
)
def table_counts(spark, folder):
    return profile.table_counts({t: table(spark, folder, t) for t in COUNTED})


@query(
    "source_counts_total",
    """SELECT source AS label, COUNT(*) AS row_count FROM documents GROUP BY source
UNION ALL SELECT 'TOTAL', COUNT(*) FROM documents ORDER BY row_count DESC, label""",
)
def source_counts_total(spark, folder):
    found = profile.counts_with_total(table(spark, folder, "documents"), "source")
    return found.orderBy(F.desc("row_count"), "label")


@query(
    "segment_active_share",
    """SELECT c_mktsegment, COUNT(*) AS customers,
  ROUND(CAST(COUNT(*) FILTER (WHERE c_acctbal > 0) AS DOUBLE) * 100 / COUNT(*), 1) AS active_pct
FROM customer GROUP BY c_mktsegment ORDER BY customers DESC""",
)
def segment_active_share(spark, folder):
    found = profile.active_share(table(spark, folder, "customer"), "c_mktsegment", F.col("c_acctbal") > 0)
    return found.orderBy(F.desc("customers"))


@query(
    "key_partition_check",
    f"""WITH {TX_SQL} SELECT user_id, COUNT(DISTINCT channel) AS partitions FROM tx GROUP BY user_id HAVING COUNT(DISTINCT channel) > 1""",
)
def key_partition_check(spark, folder):
    return profile.key_partition_check(transactions(spark, folder), "user_id", F.col("channel"))


@query(
    "keys_per_partition",
    """SELECT user_id % 8 AS partition_id, COUNT(*) AS row_count, COUNT(DISTINCT user_id) AS distinct_keys FROM events GROUP BY ALL""",
)
def keys_per_partition(spark, folder):
    e = table(spark, folder, "events")
    return profile.keys_per_partition(e, "user_id", F.pmod("user_id", F.lit(8)))


EXPECTED = {"customer": 100, "orders": 1000, "lineitem": 1_000_000_000, "events": 1, "refunds": 1}


@query(
    "expectations",
    """WITH c AS (SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer UNION ALL SELECT 'orders', COUNT(*) FROM orders
  UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'events', COUNT(*) FROM events),
w(table_name, expected_min) AS (VALUES ('customer', 100), ('orders', 1000), ('lineitem', 1000000000), ('events', 1), ('refunds', 1))
SELECT table_name, CAST(expected_min AS BIGINT) AS expected_min, COALESCE(row_count, 0) AS row_count, COALESCE(row_count, 0) >= expected_min AS reached
FROM w LEFT JOIN c USING (table_name)""",
)
def expectations(spark, folder):
    counts = profile.table_counts({t: table(spark, folder, t) for t in ["customer", "orders", "lineitem", "events"]})
    return profile.expectations(counts, EXPECTED)


@query(
    "source_activity",
    f"""WITH {TX_SQL} SELECT channel, COUNT(*) AS row_count, MIN(ts) AS first_seen, MAX(ts) AS last_seen FROM tx GROUP BY channel""",
)
def source_activity(spark, folder):
    return lineage.activity(transactions(spark, folder), "channel", "ts")


# -- reconciliation -------------------------------------------------------------------


@query(
    "reconcile_keys",
    """WITH t AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT o_orderkey AS orderkey, 'missing' AS side FROM orders WHERE o_orderkey NOT IN (SELECT k FROM t)
UNION ALL SELECT k, 'extra' FROM t WHERE k NOT IN (SELECT o_orderkey FROM orders)""",
)
def reconcile_keys(spark, folder):
    source = table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"))
    target = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return reconcile.key_difference(source, target, ["orderkey"])


@query(
    "reconcile_verdict",
    """WITH t AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT 'lineitem' AS table_name, (SELECT COUNT(*) FROM orders) AS source_count, (SELECT COUNT(*) FROM lineitem) AS target_count,
  (SELECT COUNT(*) FROM orders WHERE o_orderkey NOT IN (SELECT k FROM t)) AS missing_keys,
  (SELECT COUNT(*) FROM t WHERE k NOT IN (SELECT o_orderkey FROM orders)) AS extra_keys, 'FAIL' AS verdict
UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM orders), (SELECT COUNT(*) FROM orders), 0, 0, 'PASS'""",
)
def reconcile_verdict(spark, folder):
    orders = table(spark, folder, "orders")
    source = orders.select(F.col("o_orderkey").alias("orderkey"))
    target = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return reconcile.reconcile(source, target, ["orderkey"], "lineitem").unionByName(
        reconcile.reconcile(orders, orders, ["o_orderkey"], "orders")
    )


@query(
    "reconcile_checksum",
    """SELECT 'orders' AS table_name, COUNT(*) AS row_count,
  CAST(SUM(CAST(CAST(('0x' || substr(m, 1, 16)) AS UBIGINT) AS HUGEINT)) AS VARCHAR) || ':' ||
  CAST(SUM(CAST(CAST(('0x' || substr(m, 17, 16)) AS UBIGINT) AS HUGEINT)) AS VARCHAR) AS checksum
FROM (SELECT md5(concat_ws('|', length(k) || ':' || k, length(c) || ':' || c, length(o_orderstatus) || ':' || o_orderstatus, length(p) || ':' || p)) AS m
  FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS p FROM orders))""",
)
def reconcile_checksum(spark, folder):
    cols = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice").cast("decimal(18,2)")]
    found = reconcile.checksum(table(spark, folder, "orders"), cols, "md5")
    return found.select(F.lit("orders").alias("table_name"), "row_count", "checksum")


@query("checksum_xxhash64")
def checksum_xxhash64(spark, folder):
    orders = table(spark, folder, "orders")
    return reconcile.checksum(orders, [F.col(c) for c in orders.columns])


@query(
    "layer_presence",
    """WITH i AS (SELECT event_id AS id, 'a' AS l FROM events UNION ALL SELECT o_orderkey, 'b' FROM orders UNION ALL SELECT l_orderkey, 'c' FROM lineitem)
SELECT CAST(id AS VARCHAR) AS record_id, COUNT(*) FILTER (WHERE l = 'a') AS in_events, COUNT(*) FILTER (WHERE l = 'b') AS in_orders,
  COUNT(*) FILTER (WHERE l = 'c') AS in_lineitem FROM i GROUP BY id""",
)
def layer_presence(spark, folder):
    return lineage.layer_presence(
        {
            "events": (table(spark, folder, "events"), F.col("event_id")),
            "orders": (table(spark, folder, "orders"), F.col("o_orderkey")),
            "lineitem": (table(spark, folder, "lineitem"), F.col("l_orderkey")),
        }
    )


@query(
    "lineage_trace",
    """SELECT 'orders' AS layer, CAST(o_orderkey AS VARCHAR) AS record_id, COUNT(*) AS occurrences FROM orders WHERE o_orderkey IN (7, 11) GROUP BY ALL
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR), COUNT(*) FROM lineitem WHERE l_orderkey IN (7, 11) GROUP BY ALL""",
)
def lineage_trace(spark, folder):
    layers = {
        "orders": (table(spark, folder, "orders"), F.col("o_orderkey")),
        "lineitem": (table(spark, folder, "lineitem"), F.col("l_orderkey")),
    }
    found = lineage.trace(layers, [7, 11])
    return found.groupBy("layer", "record_id").agg(F.count("document").alias("occurrences"))


@query(
    "first_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20",
)
def first_rows(spark, folder):
    """Sample of the first rows for a report."""
    orders = table(spark, folder, "orders")
    return orders.orderBy("o_orderdate", "o_orderkey").limit(20).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "load_metadata",
    """SELECT o_orderkey, 'mysql.shop' AS _source, 'jdbc_full_export' AS _migration_type, 'b-1' AS _batch_id,
  TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at FROM orders""",
)
def load_metadata(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey")
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return std.load_metadata(rows, "mysql.shop", "jdbc_full_export", "b-1", at)


@query(
    "keyed_messages",
    """SELECT 'alerts.fraud' AS topic, CAST(o_custkey AS VARCHAR) AS key, '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_custkey":' || o_custkey || '}' AS value
FROM orders""",
)
def keyed_messages(spark, folder):
    rows = table(spark, folder, "orders")
    rows = rows.select("o_orderkey", "o_orderstatus", "o_custkey")
    return kafka.keyed_messages(rows, "alerts.fraud", F.col("o_custkey"))
