"""Declarative data-quality rules.

Rules are plain dictionaries. All of them become columns of one plan; the report
is one aggregation over the evaluated rows. Only a uniqueness rule shuffles.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.text import labels

# The rules of the daily silver job.
DEFAULT_RULES = [
    {
        "id": "CMP-001",
        "name": "필수 필드 null 체크",
        "type": "completeness",
        "severity": "critical",
        "fields": ["tx_id", "user_id", "tx_type", "amount", "timestamp"],
    },
    {
        "id": "UNQ-001",
        "name": "거래 ID 중복 체크",
        "type": "uniqueness",
        "severity": "critical",
        "key_fields": ["tx_id"],
        "strategy": "keep_latest",
    },
    {
        "id": "VLD-001",
        "name": "거래 유형 허용값 체크",
        "type": "validity",
        "severity": "critical",
        "field": "tx_type",
        "allowed_values": ["PAYMENT", "REFUND", "TRANSFER", "WITHDRAWAL"],
    },
    {
        "id": "VLD-002",
        "name": "거래 금액 범위 체크",
        "type": "validity",
        "severity": "warning",
        "field": "amount",
        "min_value": 100,
        "max_value": 50_000_000,
    },
    {
        "id": "VLD-003",
        "name": "거래 상태 허용값 체크",
        "type": "validity",
        "severity": "critical",
        "field": "status",
        "allowed_values": ["SUCCESS", "FAILED", "PENDING"],
    },
    {
        "id": "VLD-004",
        "name": "금액 양수 체크",
        "type": "validity",
        "severity": "critical",
        "field": "amount",
        "min_value": 0,
    },
    {
        "id": "TML-001",
        "name": "타임스탬프 범위 체크",
        "type": "timeliness",
        "severity": "warning",
        "field": "timestamp",
        "max_delay_hours": 48,
    },
]

# Beyond this a double no longer tells cents apart; NaN and infinity are beyond it too.
MONEY_RULE = {
    "id": "VLD-005",
    "name": "금액 계산 가능 체크",
    "type": "validity",
    "severity": "critical",
    "field": "amount",
    "min_value": -1e15,
    "max_value": 1e15,
}

# Rule fields that are called differently in the parsed rows.
FIELD_ALIASES = {"timestamp": "event_timestamp"}

PASS_RATE = 0.99


def load_rules(path: str) -> list[dict]:
    """Rules from a YAML file with a top-level ``rules`` list."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)["rules"]


def _resolve(name: str, columns: list[str], aliases: dict[str, str]) -> str:
    if name in columns:
        return name
    if aliases.get(name) in columns:
        return aliases[name]
    raise ValueError(f"quality rule names an unknown field: {name}")


def _row_condition(rule: dict, columns: list[str], aliases: dict[str, str], as_of: datetime | Column) -> Column:
    """True where the rule is violated, for rules that look at one row."""
    kind = rule["type"]
    if kind == "completeness":
        names = [_resolve(n, columns, aliases) for n in rule["fields"]]
        violated = F.lit(False)
        for name in names:
            violated = violated | F.col(name).isNull()
        return violated
    value = F.col(_resolve(rule["field"], columns, aliases))
    if kind == "timeliness":
        moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
        limit = moment - F.expr(f"INTERVAL {int(rule['max_delay_hours'])} HOURS")
        violated = value < limit
    elif "allowed_values" in rule:
        violated = ~value.isin(list(rule["allowed_values"]))
    else:
        violated = F.lit(False)
        if "min_value" in rule:
            violated = violated | (value < rule["min_value"])
        if "max_value" in rule:
            violated = violated | (value > rule["max_value"])
    # A null is the business of the completeness rule.
    return F.coalesce(violated, F.lit(False))


def _mark_losers(df: DataFrame, rule: dict, order: list[str], critical: Column) -> DataFrame:
    """Adds a flag for rows beaten by a newer row with the same key.

    Rows free of other critical violations win over others. The winner of each
    key is found by an aggregation; the rows meet their winner in a join on key
    *and* order columns, so the copies of one key spread over all tasks.
    """
    keys, flag = rule["key_fields"], f"_v_{rule['id']}"
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    ranked = df.withColumn("_place", F.struct((~critical).alias("ok"), *order))
    winners = (
        ranked.filter(has_key)
        .groupBy(*keys)
        .agg(F.max("_place").alias("_place"))
        .withColumn("_won", F.lit(True))
        .alias("w")
    )
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"r.{k}") == F.col(f"w.{k}"))
    same = same & F.col("r._place.ok").eqNullSafe(F.col("w._place.ok"))
    for o in order:
        same = same & F.col(f"r._place.{o}").eqNullSafe(F.col(f"w._place.{o}"))
    joined = ranked.alias("r").join(winners, same, "left")
    key_known = F.lit(True)
    for k in keys:
        key_known = key_known & F.col(f"r.{k}").isNotNull()
    lost = key_known & F.col("w._won").isNull()
    kept = [F.col(f"r.{c}").alias(c) for c in df.columns]
    return joined.select(*kept, lost.alias(flag))


def evaluate(
    df: DataFrame,
    rules: list[dict] = DEFAULT_RULES,
    as_of: datetime | Column | None = None,
    latest_by: list[str] | None = None,
    aliases: dict[str, str] = FIELD_ALIASES,
) -> DataFrame:
    """All rows with the ids of the rules they violate.

    Adds ``critical_violations`` and ``warning_violations`` (arrays),
    ``is_quarantined``, ``is_anomaly`` and ``quality_flags`` (warnings as text).
    ``latest_by`` lists what makes a row newer for uniqueness rules and has to
    tell any two copies apart; ``as_of`` is "now" for timeliness rules.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    columns = list(df.columns)
    simple = [r for r in rules if r["type"] != "uniqueness"]
    unique = [r for r in rules if r["type"] == "uniqueness"]
    out = df.withColumns(
        {f"_v_{r['id']}": _row_condition(r, columns, aliases, as_of) for r in simple}
    )
    broken = F.lit(False)
    for r in simple:
        if r["severity"] == "critical":
            broken = broken | F.col(f"_v_{r['id']}")
    for r in unique:
        r = r | {"key_fields": [_resolve(k, columns, aliases) for k in r["key_fields"]]}
        if not latest_by:
            raise ValueError("uniqueness rules need latest_by")
        out = _mark_losers(out, r, latest_by, broken)

    def ids(severity: str) -> Column:
        return labels({r["id"]: F.col(f"_v_{r['id']}") for r in rules if r["severity"] == severity})

    def any_of(severity: str) -> Column:
        found = F.lit(False)
        for r in rules:
            if r["severity"] == severity:
                found = found | F.col(f"_v_{r['id']}")
        return found

    odd = any_of("warning")
    return out.withColumns(
        {
            "critical_violations": ids("critical"),
            "warning_violations": ids("warning"),
            "is_quarantined": any_of("critical"),
            "is_anomaly": odd,
            "quality_flags": F.when(odd, F.array_join(ids("warning"), ",")),
        }
    ).drop(*[f"_v_{r['id']}" for r in rules])


def clean_rows(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(~F.col("is_quarantined")).drop(
        "critical_violations", "warning_violations", "is_quarantined"
    )


def quarantined_rows(evaluated: DataFrame) -> DataFrame:
    """Rejected rows with the ids of the rules that rejected them."""
    return evaluated.filter("is_quarantined").drop("is_quarantined", "is_anomaly", "quality_flags")


def totals(evaluated: DataFrame) -> DataFrame:
    """Input, output, quarantined and flagged row counts, one row."""
    bad, odd = F.col("is_quarantined"), F.col("is_anomaly")
    return evaluated.agg(
        F.count(F.lit(1)).alias("total_input_records"),
        F.count_if(~bad).alias("total_output_records"),
        F.count_if(bad).alias("quarantined_records"),
        F.count_if(~bad & odd).alias("flagged_records"),
    )


def report(evaluated: DataFrame, rules: list[dict] = DEFAULT_RULES) -> DataFrame:
    """One row per rule: failures, pass rate and PASS/FAIL, from one aggregation."""
    violated = F.concat("critical_violations", "warning_violations")
    counts = [F.count_if(F.array_contains(violated, r["id"])).alias(f"_f{i}") for i, r in enumerate(rules)]
    one_row = evaluated.agg(F.count(F.lit(1)).alias("total_records"), *counts)
    entries = F.array(
        *[
            F.struct(
                F.lit(r["id"]).alias("rule_id"),
                F.lit(r.get("name", r["id"])).alias("rule_name"),
                F.lit(r["severity"]).alias("severity"),
                F.col(f"_f{i}").alias("failed_records"),
            )
            for i, r in enumerate(rules)
        ]
    )
    passed = F.col("total_records") - F.col("failed_records")
    rate = passed.cast("double") / F.greatest(F.col("total_records"), F.lit(1))
    return (
        one_row.select("total_records", F.inline(entries))
        .withColumn("passed_records", passed)
        .withColumn("pass_rate", F.when(F.col("total_records") == 0, 0.0).otherwise(rate))
        .withColumn("verdict", F.when(F.col("pass_rate") >= PASS_RATE, "PASS").otherwise("FAIL"))
    )


def gates(
    counts: DataFrame, bronze_rows: Column, silver_rows: Column, quarantined: Column, gold_rows: Column
) -> DataFrame:
    """Pipeline alarms over a row of layer counts.

    Limits (fixed values): more than 5 % quarantined, more than 10 % lost from
    bronze to silver, no gold rows.
    """
    quarantine_rate = F.coalesce(F.try_divide(quarantined.cast("double"), bronze_rows), F.lit(0.0))
    loss = F.coalesce(F.try_divide((bronze_rows - silver_rows).cast("double"), bronze_rows), F.lit(0.0))

    def gate(name: str, observed: Column, ok: Column) -> Column:
        return F.struct(F.lit(name).alias("gate"), observed.alias("observed"), ok.alias("ok"))

    checks = F.array(
        gate("quarantine_rate", quarantine_rate, quarantine_rate <= 0.05),
        gate("bronze_to_silver_loss", loss, loss <= 0.10),
        gate("gold_rows", gold_rows.cast("double"), gold_rows > 0),
    )
    return counts.select(F.inline(checks))
