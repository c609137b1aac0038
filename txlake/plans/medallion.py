"""Bronze -> silver -> gold for a range of days.

Every stage replaces exactly what earlier runs of the same days produced, so a
re-run or a backfill leaves the same tables as a single run. Stages hand over
through written tables; nothing is recomputed by a later stage.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake import schemas
from txlake.functions import times
from txlake.operators import gold, quality
from txlake.sources.files import decode_json
from txlake.sources.versioned import VersionedTable

BRONZE_KEYS = ["kafka_topic", "kafka_partition", "kafka_offset"]


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root.rstrip('/')}/{name}")


@dataclass
class Settings:
    """What a run may vary; the defaults are those of the nightly job."""

    rules: list[dict] = field(default_factory=lambda: list(quality.DEFAULT_RULES))
    fees: gold.FeeRates = field(default_factory=gold.FeeRates)
    default_currency: str = "KRW"
    now: Column | None = None
    as_of: dt.datetime | Column | None = None
    bronze_keys: list[str] = field(default_factory=lambda: list(BRONZE_KEYS))

    def checks(self) -> list[dict]:
        """The rules, and that amounts can be summed at all."""
        return [*self.rules, quality.MONEY_RULE]

    def clock(self) -> Column:
        return F.current_timestamp() if self.now is None else self.now


def topic_to_bronze(topic: DataFrame, first: dt.date, until: dt.date, now: Column) -> DataFrame:
    """Topic rows of the days [first, until) with bronze names and types.

    The days are a range on the raw timestamp, which the source can push down.
    """
    at = F.col("timestamp")
    wanted = (at >= F.lit(first).cast("timestamp")) & (at < F.lit(until).cast("timestamp"))
    return topic.filter(wanted).select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        at.alias("kafka_timestamp"),
        F.to_date(at).alias("ingest_date"),
        now.alias("ingest_timestamp"),
    )


def load_bronze(lake: Lake, rows: DataFrame, first: dt.date, until: dt.date, keys: list[str]) -> int:
    """Insert-only merge: rows that are there already stay as they are.

    A topic position occurs once in a read, so the input needs no de-duplication.
    """
    day = F.col("ingest_date")
    touched = (day >= F.lit(first)) & (day < F.lit(until))
    return lake.table("bronze").insert_new(rows, keys, ["ingest_date"], touched, distinct=True)


def parse_silver(bronze: DataFrame, default_currency: str) -> DataFrame:
    """Bronze rows as typed transactions; unreadable values become null and are
    left to the quality rules."""
    decoded = decode_json(bronze, F.col("kafka_value"), schemas.RAW_EVENT, "event")
    return decoded.select(
        "event.tx_id",
        "event.user_id",
        "event.tx_type",
        F.col("event.amount").try_cast("double").alias("amount"),
        F.coalesce("event.currency", F.lit(default_currency)).alias("currency"),
        "event.merchant_id",
        "event.merchant_category",
        "event.status",
        times.event_time(F.col("event.timestamp")).alias("event_timestamp"),
        F.col("event.source").alias("source_system"),
        *[c for c in schemas.BRONZE.names if c != "ingest_timestamp"],
    ).withColumns(
        {
            "tx_date": F.to_date("event_timestamp"),
            "tx_hour": F.hour("event_timestamp"),
        }
    )


def build_silver(lake: Lake, first: dt.date, until: dt.date, settings: Settings) -> list[dt.date]:
    """Checked rows of the given ingest days; returns the transaction days whose
    silver rows changed."""
    day = F.col("ingest_date")
    of_run = (day >= F.lit(first)) & (day < F.lit(until))
    parsed = parse_silver(lake.table("bronze").read().filter(of_run), settings.default_currency)
    checked = quality.evaluate(
        parsed,
        settings.checks(),
        settings.as_of,
        ["kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_key"],
    )
    staged = lake.table("staging/checked")
    staged.overwrite(checked, ["is_quarantined"])
    rows = staged.read()

    clean = quality.clean_rows(rows).withColumn("processed_timestamp", settings.clock())
    # The ingest day stays with each row: it tells which rows a re-run replaces.
    clean = clean.select(*schemas.SILVER.names, "ingest_date")
    silver = lake.table("silver")
    changed = clean.select("tx_date").distinct()
    if silver.exists():
        changed = changed.union(silver.read().filter(of_run).select("tx_date").distinct()).distinct()
    days = sorted(r.tx_date for r in changed.collect())  # at most one entry per calendar day
    if not silver.exists():
        silver.overwrite(clean, ["tx_date", "tx_type"], operation="CREATE")
    elif days:
        silver.replace_where(clean, ~of_run, F.col("tx_date").isin(days), "REPLACE DAYS")

    rejected = quality.quarantined_rows(rows).withColumn("quarantined_at", settings.clock())
    _replace(lake.table("quarantine"), rejected, ["ingest_date"], of_run)
    report = quality.report(rows, settings.checks()).withColumns(
        {"first_day": F.lit(first), "until_day": F.lit(until), "generated_at": settings.clock()}
    )
    same_run = (F.col("first_day") == F.lit(first)) & (F.col("until_day") == F.lit(until))
    _replace(lake.table("quality_reports"), report, ["first_day", "until_day"], same_run)
    return days


def _replace(table: VersionedTable, df: DataFrame, partition_by: list[str], touched: Column) -> None:
    """Replace the partitions selected by ``touched``, also when ``df`` is empty there."""
    if table.exists():
        table.replace_where(df, F.lit(False), touched, "REPLACE DAYS")
    else:
        table.overwrite(df, partition_by, operation="CREATE")


def _next_month(day: dt.date) -> dt.date:
    return (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def build_gold(lake: Lake, days: list[dt.date], settings: Settings) -> None:
    """Rebuild the gold rows of the given days, and of their months."""
    if not days:
        return
    silver = lake.table("silver").read()
    now = settings.clock()
    of_days = silver.filter(F.col("tx_date").isin(days))

    summary = gold.daily_summary(of_days).withColumn("generated_at", now)
    _replace(
        lake.table("gold/daily_summary"),
        summary.select(*schemas.GOLD_DAILY_SUMMARY.names),
        ["summary_date"],
        F.col("summary_date").isin(days),
    )

    months = sorted({d.replace(day=1) for d in days})
    in_months = F.lit(False)
    for month in months:
        in_months = in_months | gold.month_filter(F.col("tx_date"), month, _next_month(month))
    stats = gold.customer_month_stats(silver.filter(in_months)).withColumn("generated_at", now)
    _replace(
        lake.table("gold/customer_stats"),
        stats.select(*schemas.GOLD_CUSTOMER_STATS.names),
        ["stats_month"],
        F.col("stats_month").isin([m.strftime("%Y-%m") for m in months]),
    )

    dated = of_days.withColumn("settlement_date", F.col("tx_date"))
    fees = gold.fee_settlement(dated, settings.fees, ("settlement_date",)).withColumn("generated_at", now)
    _replace(
        lake.table("gold/fee_settlement"),
        fees.select(*schemas.GOLD_FEE_SETTLEMENT.names),
        ["settlement_date"],
        F.col("settlement_date").isin(days),
    )


GOLD_TABLES = ["gold/daily_summary", "gold/customer_stats", "gold/fee_settlement"]


def run(
    lake: Lake,
    topic: DataFrame,
    first: dt.date | None = None,
    until: dt.date | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """Run all stages for the ingest days [first, until): one day by default, and yesterday
    (in UTC) if none is named.

    Returns and appends to the ``runs`` table one row per stage with status and
    duration. A failing stage stops the run and raises after it was recorded.
    """
    settings = settings or Settings()
    first = first or dt.datetime.now(dt.UTC).date() - dt.timedelta(days=1)
    until = until or first + dt.timedelta(days=1)
    rows, days, failure = [], [], None

    def bronze():
        load_bronze(
            lake, topic_to_bronze(topic, first, until, settings.clock()), first, until, settings.bronze_keys
        )

    def silver():
        days.extend(build_silver(lake, first, until, settings))

    for stage, work in [("bronze", bronze), ("silver", silver), ("gold", lambda: build_gold(lake, days, settings))]:
        started = time.time()
        try:
            work()
            rows.append((stage, first, until, "SUCCESS", round(time.time() - started, 3), None))
        except Exception as error:  # noqa: BLE001 - recorded, then raised
            failure = error
            rows.append((stage, first, until, "FAILED", round(time.time() - started, 3), str(error)))
            break
    schema = "stage STRING, first_day DATE, until_day DATE, status STRING, seconds DOUBLE, error STRING"
    outcome = lake.spark.createDataFrame(rows, schema)
    lake.table("runs").append(outcome)
    if failure:
        raise failure
    return outcome


def gold_not_empty(lake: Lake) -> DataFrame:
    """One row per gold table: does it hold rows?"""
    found = [(n, lake.table(n).exists() and not lake.table(n).read().isEmpty()) for n in GOLD_TABLES]
    return lake.spark.createDataFrame(found, "table_name STRING, has_rows BOOLEAN")


def publish_day(lake: Lake, name: str, day_column: str, day: dt.date, path: str) -> DataFrame:
    """Write one day of a gold table as a report."""
    rows = lake.table(name).read().filter(F.col(day_column) == F.lit(day))
    rows.write.mode("overwrite").json(path)
    return rows


def quality_report_json(lake: Lake, path: str) -> None:
    """Quality reports as JSON files, one folder per first day."""
    lake.table("quality_reports").read().write.mode("overwrite").partitionBy("first_day").json(path)
