"""The given tables seen as payment data, in DataFrame form and as SQL.

The events table plays the transaction stream, orders play settled transactions
and change records, lineitem with part plays merchant revenue. Every view keeps
all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.money import money
from txlake.functions.text import mapping
from txlake.functions.times import micros, seconds
from txlake.sources.files import table

# What an event type, priority or status stands for.
TX_TYPES = {
    "purchase": "PAYMENT",
    "signup": "TRANSFER",
    "click": "WITHDRAWAL",
    "view": "REFUND",
    "error": "ERROR",
}
ORDER_TYPES = {
    "1-URGENT": "PAYMENT",
    "2-HIGH": "PAYMENT",
    "3-MEDIUM": "REFUND",
    "4-NOT SPECIFIED": "TRANSFER",
    "5-LOW": "TRANSFER",
}
ORDER_STATES = {"F": "SUCCESS", "O": "PENDING", "P": "FAILED"}


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return as_transactions(table(spark, folder, "events"))


def as_transactions(events: DataFrame) -> DataFrame:
    # A column of its own, so that the document is parsed once per row.
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, amount = F.col("k"), F.col("value")
    category = (
        F.when(k < 15, "F&B")
        .when(k < 30, "RETAIL")
        .when(k < 45, "ONLINE")
        .when(k < 55, "TRAVEL")
        .when(k < 65, "FINANCE")
        .when(k < 75, "HEALTH")
        .otherwise("OTHER")
    )
    is_transfer = F.col("event_type") == "signup"
    return events.select(
        "event_id",
        F.col("event_id").cast("string").alias("tx_id"),
        "user_id",
        mapping(TX_TYPES, F.col("event_type")).alias("tx_type"),
        amount.alias("amount"),
        F.when(k < 70, "KRW").when(k < 90, "USD").otherwise("JPY").alias("currency"),
        F.when(~is_transfer, F.concat(F.lit("M"), k.cast("string"))).alias("merchant_id"),
        F.when(~is_transfer, category).alias("merchant_category"),
        F.when(amount < 2, "FAILED").when(amount < 5, "PENDING").otherwise("SUCCESS").alias("status"),
        F.when(k < 40, "APP").when(k < 70, "WEB").when(k < 85, "ATM").otherwise("POS").alias("channel"),
        (amount > 150).alias("is_suspicious"),
        (amount > 200).alias("is_anomaly"),
        "ts",
        F.to_date("ts").alias("tx_date"),
        "k",
    )


TX_SQL = """
tx AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS tx_id, user_id,
    CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'signup' THEN 'TRANSFER'
      WHEN 'click' THEN 'WITHDRAWAL' WHEN 'view' THEN 'REFUND' WHEN 'error' THEN 'ERROR' END AS tx_type,
    value AS amount,
    CASE WHEN k < 70 THEN 'KRW' WHEN k < 90 THEN 'USD' ELSE 'JPY' END AS currency,
    CASE WHEN event_type <> 'signup' THEN 'M' || k END AS merchant_id,
    CASE WHEN event_type = 'signup' THEN NULL WHEN k < 15 THEN 'F&B' WHEN k < 30 THEN 'RETAIL'
      WHEN k < 45 THEN 'ONLINE' WHEN k < 55 THEN 'TRAVEL' WHEN k < 65 THEN 'FINANCE'
      WHEN k < 75 THEN 'HEALTH' ELSE 'OTHER' END AS merchant_category,
    CASE WHEN value < 2 THEN 'FAILED' WHEN value < 5 THEN 'PENDING' ELSE 'SUCCESS' END AS status,
    CASE WHEN k < 40 THEN 'APP' WHEN k < 70 THEN 'WEB' WHEN k < 85 THEN 'ATM' ELSE 'POS' END AS channel,
    value > 150 AS is_suspicious, value > 200 AS is_anomaly, ts, CAST(ts AS DATE) AS tx_date, k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


def settled(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as settled transactions."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("tx_id"),
        F.col("o_custkey").alias("user_id"),
        mapping(ORDER_TYPES, F.col("o_orderpriority")).alias("tx_type"),
        F.col("o_totalprice").alias("amount"),
        mapping(ORDER_STATES, F.col("o_orderstatus")).alias("status"),
        (F.col("o_totalprice") > 400_000).alias("is_anomaly"),
        F.to_date("o_orderdate").alias("tx_date"),
    )


SETTLED_SQL = """
settled AS (
  SELECT o_orderkey AS tx_id, o_custkey AS user_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'PAYMENT' WHEN '2-HIGH' THEN 'PAYMENT'
      WHEN '3-MEDIUM' THEN 'REFUND' WHEN '4-NOT SPECIFIED' THEN 'TRANSFER' WHEN '5-LOW' THEN 'TRANSFER' END AS tx_type,
    o_totalprice AS amount,
    CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'FAILED' END AS status,
    o_totalprice > 400000 AS is_anomaly, CAST(o_orderdate AS DATE) AS tx_date
  FROM orders
)"""


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as merchant revenue, summed per part before the join so that a
    part with very many lines reaches the join as a few rows."""
    per_part = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", "l_returnflag", "l_linestatus")
        .agg(F.sum(money("l_extendedprice")).alias("amount"), F.count(F.lit(1)).alias("row_count"))
    )
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    return per_part.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("merchant_id"),
        F.col("p_type").alias("merchant_category"),
        F.when(F.col("l_returnflag") == "R", "REFUND").otherwise("PAYMENT").alias("tx_type"),
        F.when(F.col("l_linestatus") == "F", "SUCCESS").otherwise("PENDING").alias("status"),
        "amount",
        "row_count",
    )


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with an arrival time: each is delayed by ``k`` minutes, so
    arrival order differs from event order. Users are spread over four topic
    partitions."""
    tx = transactions(spark, folder)
    late_by = F.col("k").cast("bigint") * 60_000_000
    return tx.withColumn("arrival", micros(F.col("ts")) + late_by).withColumn(
        "topic_partition", F.pmod("user_id", F.lit(4)).cast("int")
    )


ARRIVALS_SQL = TX_SQL + """,
arrivals AS (
  SELECT *, epoch_us(ts) + CAST(k AS BIGINT) * 60000000 AS arrival, user_id % 4 AS topic_partition FROM tx
)"""


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change records derived from all orders, with the envelope of a change feed.

    Every order is created; orders that reached state F or P are updated an hour
    later; orders in state P are deleted in the same millisecond as that, which only
    the offset tells apart, and a tombstone follows.
    """
    orders = table(spark, folder, "orders")
    created = F.struct(
        F.col("o_orderkey").alias("settlement_id"),
        F.col("o_custkey").alias("merchant_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.lit("PENDING").alias("status"),
    )
    updated = F.struct(
        F.col("o_orderkey").alias("settlement_id"),
        F.col("o_custkey").alias("merchant_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("FAILED").alias("status"),
    )

    def change(step, op, before, after, hours):
        at = F.unix_millis((F.col("o_orderdate") + seconds(3600 * hours)).cast("timestamp"))
        origin = F.struct(F.lit("shop").alias("db"), F.lit("orders").alias("table"), at.alias("ts_ms"))
        return F.struct(
            before.alias("before"),
            after.alias("after"),
            origin.alias("source"),
            F.lit(op).cast("string").alias("op"),
            at.alias("ts_ms"),
            (F.col("o_orderkey") * 4 + step).alias("offset"),
        )

    nothing = F.when(F.lit(False), created)
    done, gone = F.col("o_orderstatus").isin("F", "P"), F.col("o_orderstatus") == "P"
    steps = F.array(
        change(0, "c", nothing, created, 0),
        F.when(done, change(1, "u", created, updated, 1)),
        F.when(gone, change(2, "d", updated, nothing, 1)),
        F.when(gone, change(3, None, nothing, nothing, 1)),
    )
    return orders.select(F.inline(F.array_compact(steps)))


CHANGES_SQL = """
changes AS (
  SELECT o_orderkey AS settlement_id, o_custkey AS merchant_id, o_totalprice AS total_amount, 'PENDING' AS status,
    'c' AS op, epoch_ms(o_orderdate) AS ts_ms FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'FAILED' END,
    'u', epoch_ms(o_orderdate) + 3600000 FROM orders WHERE o_orderstatus IN ('F', 'P')
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, 'FAILED', 'd', epoch_ms(o_orderdate) + 3600000
  FROM orders WHERE o_orderstatus = 'P'
)"""
