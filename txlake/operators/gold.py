"""Business aggregates of the gold layer and the small reports around them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.functions.money import MONEY, PLACES, count_where, exact_avg, exact_sum, money
from txlake.functions.text import mapping
from txlake.functions.times import month_key


@dataclass(frozen=True)
class FeeRates:
    """Fee per merchant category (fixed values as defaults)."""

    rates: dict[str, float] = field(
        default_factory=lambda: {
            "F&B": 0.015,
            "RETAIL": 0.018,
            "ONLINE": 0.022,
            "TRAVEL": 0.025,
            "FINANCE": 0.010,
            "HEALTH": 0.012,
        }
    )
    default: float = 0.020


def daily_summary(tx: DataFrame) -> DataFrame:
    """Nine measures per day and transaction type."""
    return tx.groupBy(F.col("tx_date").alias("summary_date"), "tx_type").agg(
        F.count(F.lit(1)).alias("total_count"),
        count_where(F.col("status") == "SUCCESS").alias("success_count"),
        count_where(F.col("status") == "FAILED").alias("failed_count"),
        exact_sum("amount").alias("total_amount"),
        exact_avg("amount").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.count_distinct("user_id").alias("unique_users"),
        count_where(F.col("is_anomaly")).alias("anomaly_count"),
    )


# Size of a user sketch as a power of two: a relative error of 0.4 % (one standard deviation).
SKETCH_SIZE = 16


def daily_user_sketches(tx: DataFrame) -> DataFrame:
    """Per day and type a sketch of the different users, to be kept and merged later."""
    return tx.groupBy(F.col("tx_date").alias("summary_date"), "tx_type").agg(
        F.hll_sketch_agg("user_id", F.lit(SKETCH_SIZE)).alias("user_sketch")
    )


def unique_users(sketches: DataFrame, *by: Column) -> DataFrame:
    """Different users of any union of days, from the sketches alone: no row is read again."""
    return sketches.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sketches"),
        F.hll_sketch_estimate(F.hll_union_agg("user_sketch")).alias("unique_users"),
    )


def month_filter(column: Column, first: dt.date, following: dt.date) -> Column:
    """Half-open range on the raw partition column, so that partitions are pruned."""
    return (column >= F.lit(first)) & (column < F.lit(following))


def customer_month_stats(tx: DataFrame) -> DataFrame:
    """Per user and month: counts by type, totals, first and last day."""
    kind = F.col("tx_type")
    stats = tx.groupBy("user_id", F.trunc("tx_date", "MM").alias("_month")).agg(
        F.count(F.lit(1)).alias("total_tx_count"),
        exact_sum("amount").alias("total_amount"),
        exact_avg("amount").alias("avg_amount"),
        count_where(kind == "PAYMENT").alias("payment_count"),
        count_where(kind == "REFUND").alias("refund_count"),
        count_where(kind == "TRANSFER").alias("transfer_count"),
        count_where(F.col("is_anomaly")).alias("anomaly_count"),
        F.min("tx_date").alias("first_tx_date"),
        F.max("tx_date").alias("last_tx_date"),
    )
    # Text only after grouping: days group as numbers.
    return stats.select("user_id", month_key(F.col("_month")).alias("stats_month"), *stats.columns[2:])


def fee_settlement(tx: DataFrame, fees: FeeRates = FeeRates(), by: tuple[str, ...] = ()) -> DataFrame:
    """Payments, refunds, fee and payout per merchant and category.

    Counts successful transactions that name a merchant; ``by`` adds further
    grouping columns, for instance the settlement date. Input that has been summed
    up before (decimal ``amount``) says in ``row_count`` how many rows it stands for.
    """
    good = tx.filter(F.col("merchant_id").isNotNull() & (F.col("status") == "SUCCESS"))
    summed = isinstance(tx.schema["amount"].dataType, T.DecimalType)
    amount = F.col("amount") if summed else money("amount")
    rows = F.sum("row_count") if "row_count" in tx.columns else F.count(F.lit(1))
    zero = F.lit(0).cast(MONEY)

    def total(kind: str) -> Column:
        total = F.sum(F.when(F.col("tx_type") == kind, amount).otherwise(zero))
        return F.round(total, PLACES).cast("decimal(24,6)")

    sums = good.groupBy(*by, "merchant_id", "merchant_category").agg(
        total("PAYMENT").alias("_paid"),
        total("REFUND").alias("_refunded"),
        rows.alias("tx_count"),
    )
    rate = mapping(fees.rates, F.col("merchant_category"), fees.default).cast("decimal(6,4)")
    net = (F.col("_paid") - F.col("_refunded")).cast("decimal(24,6)")
    fee = F.round(net * F.col("_rate"), 0)
    return sums.withColumn("_rate", rate).select(
        *by,
        "merchant_id",
        "merchant_category",
        F.col("_paid").cast("double").alias("total_payment_amount"),
        F.col("_refunded").cast("double").alias("total_refund_amount"),
        net.cast("double").alias("net_amount"),
        F.col("_rate").cast("double").alias("fee_rate"),
        fee.cast("double").alias("fee_amount"),
        (net - fee).cast("double").alias("settlement_amount"),
        "tx_count",
    )


def top_by(df: DataFrame, column: str, n: int, tie_break: list[str]) -> DataFrame:
    """The n largest rows, a report; ties by key so that the result is stable."""
    return df.orderBy(F.desc(column), *tie_break).limit(n)


def ledger(tx: DataFrame, currency: str = "currency", kind: str = "tx_type") -> DataFrame:
    """Count and total per currency and type, sorted for the report."""
    return (
        tx.groupBy(currency, kind)
        .agg(F.count(F.lit(1)).alias("tx_count"), exact_sum("amount").alias("total_amount"))
        .orderBy(currency, kind)
    )


def ledger_text(rows: DataFrame, currency: str = "currency", kind: str = "tx_type") -> DataFrame:
    """Ledger rows as lines of a fixed-width table."""
    return rows.select(
        currency,
        kind,
        F.format_string(
            "%-6s %-12s %8s %18s",
            F.col(currency),
            F.col(kind),
            F.format_number("tx_count", 0),
            F.format_number("total_amount", 0),
        ).alias("line"),
    )


def user_features(tx: DataFrame) -> DataFrame:
    """Lookup features per user."""
    return tx.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("tx_count"), exact_avg("amount").alias("avg_amount")
    )


def type_averages(tx: DataFrame, kind: str = "tx_type") -> DataFrame:
    return tx.groupBy(kind).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.round(exact_avg("amount"), 2).alias("avg_amount"),
    )


def event_totals(tx: DataFrame, kind: str = "tx_type") -> DataFrame:
    """Per type: all, delivered, failed and suspicious rows."""
    return tx.groupBy(kind).agg(
        F.count(F.lit(1)).alias("total"),
        count_where(F.col("status") == "SUCCESS").alias("delivered"),
        count_where(F.col("status") == "FAILED").alias("failed"),
        count_where(F.col("is_suspicious")).alias("suspicious"),
    )


def daily_kpis(summary: DataFrame, stats: DataFrame, day: dt.date) -> DataFrame:
    """Transactions, volume and anomalies of a day, active customers of its month."""
    of_day = summary.filter(F.col("summary_date") == F.lit(day)).agg(
        F.coalesce(F.sum("total_count"), F.lit(0)).cast("bigint").alias("total_transactions"),
        F.coalesce(exact_sum("total_amount"), F.lit(0.0)).alias("total_amount"),
        F.coalesce(F.sum("anomaly_count"), F.lit(0)).cast("bigint").alias("anomalies"),
    )
    of_month = stats.filter(F.col("stats_month") == day.strftime("%Y-%m")).agg(
        F.count_distinct("user_id").alias("active_customers")
    )
    # Two rows with different columns become one.
    both = of_day.unionByName(of_month, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("kpi_date", F.lit(day))
