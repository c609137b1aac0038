"""Fraud rules: three per-user rules over the trailing minute and the per-record
rules of the transaction consumers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.text import mapping
from txlake.functions.times import iso_seconds
from txlake.operators.trailing import HOT_ROWS, trailing_totals


@dataclass(frozen=True)
class AlertRules:
    """Thresholds of the per-user rules (fixed values as defaults). Texts follow them."""

    span_seconds: int = 60
    high_amount: float = 5_000_000.0
    burst_count: int = 3
    sum_amount: float = 10_000_000.0
    block_seconds: int | None = None

    @property
    def span_text(self) -> str:
        minutes, rest = divmod(self.span_seconds, 60)
        return f"{self.span_seconds}초" if rest else f"{minutes}분"

    @property
    def high_amount_text(self) -> str:
        amount = self.high_amount
        text = f"{amount / 10_000:,.0f}만원" if amount and amount % 10_000 == 0 else f"{amount:,.10g}원"
        return f"단건 {text} 초과 거래"

    @property
    def burst_text(self) -> str:
        return f"{self.span_text} 내 %d건 연속 거래"

    @property
    def sum_text(self) -> str:
        return f"{self.span_text} 내 거래 합계 %.0f원 초과"


@dataclass(frozen=True)
class RecordRules:
    """Thresholds and texts of the per-record rules (fixed values as defaults)."""

    thresholds: dict[str, float] = field(
        default_factory=lambda: {"KRW": 50_000_000.0, "USD": 50_000.0, "JPY": 5_000_000.0}
    )
    cash_share: float = 0.5
    flagged_text: str = "프로듀서 이상 플래그"
    high_text: str = "고액 거래(%s %s)"
    cash_text: str = "ATM 고액 출금"


def _alert(rule_id: str, text: Column, severity: str, amount: Column, count: Column) -> Column:
    return F.struct(
        F.lit(rule_id).alias("rule_id"),
        text.alias("rule_description"),
        F.lit(severity).alias("severity"),
        amount.cast("double").alias("trigger_amount"),
        count.cast("bigint").alias("event_count"),
    )


def alert_structs(rules: AlertRules, amount: Column, count: Column, total: Column) -> Column:
    """Array with one entry per rule, null where the rule does not hold; one row
    may raise several alerts."""
    high = F.when(
        amount >= rules.high_amount,
        _alert("RULE-002", F.lit(rules.high_amount_text), "HIGH", amount, F.lit(1)),
    )
    burst = F.when(
        count >= rules.burst_count,
        _alert("RULE-001", F.format_string(rules.burst_text, count), "HIGH", amount, count),
    )
    summed = F.when(
        total > rules.sum_amount,
        _alert("RULE-003", F.format_string(rules.sum_text, total), "MEDIUM", total, count),
    )
    return F.array(high, burst, summed)


def alert_id(rule: Column, event_id: Column) -> Column:
    """Same alert, same id, however often the job runs."""
    return F.concat(F.lit("ALERT-"), F.sha2(F.concat_ws("|", rule, event_id), 256))


def explode_alerts(
    df: DataFrame, rules: AlertRules, key: str, ts: str, row_id: str, amount: str
) -> DataFrame:
    """Alerts of rows that carry ``trailing_count`` and ``trailing_total``."""
    value = F.coalesce(F.col(amount), F.lit(0.0))
    alerts = alert_structs(rules, value, F.col("trailing_count"), F.col("trailing_total"))
    event_id = F.col(row_id).cast("string")
    found = df.select(
        F.col(key).alias("user_id"),
        event_id.alias("trigger_event_id"),
        F.col(ts).alias("_at"),
        F.explode(alerts).alias("a"),
    ).filter(F.col("a").isNotNull())
    return found.select(
        alert_id(F.col("a.rule_id"), F.col("trigger_event_id")).alias("alert_id"),
        "a.rule_id",
        "a.rule_description",
        "user_id",
        "a.severity",
        "trigger_event_id",
        "a.trigger_amount",
        "a.event_count",
        iso_seconds(F.col("_at")).alias("detected_at"),
    )


def user_alerts(
    df: DataFrame,
    rules: AlertRules = AlertRules(),
    key: str = "user_id",
    ts: str = "ts",
    row_id: str = "event_id",
    amount: str = "amount",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Per-user alerts over bounded input; rows without a user are ignored."""
    rows = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, ts, row_id, amount)
    totals = trailing_totals(rows, key, ts, row_id, amount, rules.span_seconds, rules.block_seconds, hot_rows)
    return explode_alerts(totals, rules, key, ts, row_id, amount)


def alert_text() -> Column:
    """Alert as a readable line."""
    return F.format_string(
        "[%s] %s | user=%d, severity=%s,amount=%.0f, events=%d",
        "rule_id",
        "rule_description",
        "user_id",
        "severity",
        "trigger_amount",
        "event_count",
    )


def record_conditions(rules: RecordRules) -> dict[str, Column]:
    """Rule name -> condition on one transaction; an unknown currency has no
    threshold, so amount rules never hold for it."""
    limit = mapping(rules.thresholds, F.col("currency"))
    amount = F.col("amount")
    cash = (F.upper("tx_type") == "WITHDRAWAL") & (F.col("channel") == "ATM")
    found = {
        "flagged": F.col("is_suspicious"),
        "high": amount > limit,
        "cash": cash & (amount > limit * rules.cash_share),
    }
    return {name: F.coalesce(c, F.lit(False)) for name, c in found.items()}


def _is_suspicious(conditions: dict[str, Column]) -> Column:
    return conditions["flagged"] | conditions["high"] | conditions["cash"]


def record_alerts(df: DataFrame, rules: RecordRules = RecordRules()) -> DataFrame:
    """Suspicious transactions with their reasons and a risk level. Texts are only
    built for rows that a plain boolean filter has let through."""
    holds = record_conditions(rules)
    shown = F.format_number(F.col("amount"), 0)
    reasons = F.array(
        F.when(holds["flagged"], F.lit(rules.flagged_text)),
        F.when(holds["high"], F.format_string(rules.high_text, F.col("currency"), shown)),
        F.when(holds["cash"], F.lit(rules.cash_text)),
    )
    return (
        df.filter(_is_suspicious(holds))
        .withColumn("reasons", F.array_compact(reasons))
        .select(
            "tx_id",
            "user_id",
            "amount",
            "currency",
            "reasons",
            F.when(F.size("reasons") >= 2, "HIGH").otherwise("MEDIUM").alias("risk_level"),
        )
    )


def record_counters(rules: RecordRules = RecordRules()) -> dict[str, Column]:
    """Measures of processed and suspicious rows, for an observation of a stream."""
    return {"processed": F.count(F.lit(1)), "alerts": F.count_if(_is_suspicious(record_conditions(rules)))}


def record_rates(df: DataFrame, rules: RecordRules = RecordRules()) -> DataFrame:
    """Processed and suspicious counts with their ratio, one row."""
    hits = F.count_if(_is_suspicious(record_conditions(rules)))
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("processed"),
        hits.alias("alerts"),
        F.round(F.try_divide(hits.cast("double") * 100, n), 2).alias("alert_rate"),
    )
