"""Three source shapes -> one standard event, with invalid rows set aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake import schemas
from txlake.functions import times
from txlake.functions.text import labels

# Source column (or dotted path) -> standard column.
API_FIELDS = {
    "event_id": "event_id",
    "event_type": "event_type",
    "user_id": "user_id",
    "amount": "amount",
    "currency": "currency",
    "merchant.id": "merchant_id",
    "merchant.name": "merchant_name",
    "merchant.category": "merchant_category",
    "channel": "channel",
    "status": "status",
    "is_suspicious": "is_suspicious",
    "timestamp": "event_timestamp",
    "source": "data_source",
}

SETTLEMENT_FIELDS = {
    "settlement_id": "event_id",
    "settlement_type": "event_type",
    "merchant_id": "merchant_id",
    "merchant_name": "merchant_name",
    "merchant_category": "merchant_category",
    "gross_amount": "amount",
    "fee_amount": "fee_amount",
    "net_amount": "net_amount",
    "currency": "currency",
    "tx_count": "tx_count",
    "settlement_date": "event_timestamp",
    "status": "status",
    "batch_id": "batch_id",
    "created_at": "created_at",
}

CUSTOMER_FIELDS = {
    "customer_id": "event_id",
    "user_id": "user_id",
    "name": "customer_name",
    "email": "customer_email",
    "phone": "customer_phone",
    "grade": "customer_grade",
    "is_active": "is_active",
    "created_at": "created_at",
    "updated_at": "event_timestamp",
}

API_DEFAULTS = {"schema_version": "1.0"}
SETTLEMENT_DEFAULTS = {
    "data_source": "settlement-csv",
    "schema_version": "1.0",
    "channel": "BATCH",
    "is_suspicious": "false",
}
CUSTOMER_DEFAULTS = {
    "event_type": "CUSTOMER_UPDATE",
    "data_source": "customer-db",
    "schema_version": "1.0",
    "channel": "DB_SYNC",
    "is_suspicious": "false",
}


def shift(
    df: DataFrame,
    fields: dict[str, str],
    defaults: dict[str, str],
    normalize_time,
    ingested_at: Column,
    source_system: str,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Rename, flatten and fill into the standard columns, every value as text.

    Types are applied by ``validate``, which can then tell an unreadable value
    from a missing one. ``carry`` names lineage columns that travel along.
    """
    picked = {target: F.col(source).cast("string") for source, target in fields.items()}
    picked["event_timestamp"] = normalize_time(picked["event_timestamp"])
    picked["ingested_at"] = ingested_at.cast("string")
    out = []
    for f in schemas.STANDARD_EVENT:
        value = picked.get(f.name, F.lit(None).cast("string"))
        if f.name in defaults:
            value = F.coalesce(value, F.lit(defaults[f.name]))
        out.append(value.alias(f.name))
    return df.select(*out, F.lit(source_system).alias("source_system"), *carry)


def from_api(df: DataFrame, ingested_at: Column, source_system: str = "payment-api", carry=()) -> DataFrame:
    return shift(
        df, API_FIELDS, API_DEFAULTS, times.normalize_offset_timestamp, ingested_at, source_system, carry
    )


def from_settlement(
    df: DataFrame, ingested_at: Column, source_system: str = "settlement-csv", carry=()
) -> DataFrame:
    return shift(
        df, SETTLEMENT_FIELDS, SETTLEMENT_DEFAULTS, times.normalize_day, ingested_at, source_system, carry
    )


def from_customer(
    df: DataFrame, ingested_at: Column, source_system: str = "customer-db", carry=()
) -> DataFrame:
    return shift(
        df,
        CUSTOMER_FIELDS,
        CUSTOMER_DEFAULTS,
        times.normalize_naive_timestamp,
        ingested_at,
        source_system,
        carry,
    )


def fan_in(*frames: DataFrame) -> DataFrame:
    """All sources as one relation; columns a source lacks are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def _violations(schema: T.StructType) -> dict[str, Column]:
    """Name of each possible defect and the condition under which a row has it."""
    found = {}
    for f in schema:
        text = F.col(f.name)
        if not f.nullable:
            found[f"missing:{f.name}"] = text.isNull()
        if not isinstance(f.dataType, T.StringType):
            found[f"type:{f.name}"] = text.isNotNull() & text.try_cast(f.dataType).isNull()
    return found


def validation_errors(schema: T.StructType = schemas.STANDARD_EVENT) -> Column:
    """Array of what is wrong with a row of text values, empty for a good row."""
    return labels(_violations(schema))


def validate(df: DataFrame, schema: T.StructType = schemas.STANDARD_EVENT) -> DataFrame:
    """Adds ``validation_errors`` and ``validation_status``; row count unchanged.

    The status is a plain boolean expression, so a filter on it does not build the
    array of reasons.
    """
    bad = reduce(lambda a, b: a | b, _violations(schema).values())
    return df.withColumn("validation_errors", validation_errors(schema)).withColumn(
        "validation_status", F.when(bad, "invalid").otherwise("valid")
    )


def typed(valid: DataFrame, schema: T.StructType = schemas.STANDARD_EVENT) -> DataFrame:
    """Valid rows with their declared types; other columns stay."""
    names = set(schema.names)
    rest = [c for c in valid.columns if c not in names]
    return valid.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], *rest)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed valid rows, rejected rows with their reasons) of a validated frame."""
    good = df.filter(F.col("validation_status") == "valid").drop("validation_errors")
    return typed(good), df.filter(F.col("validation_status") == "invalid")


def routed(df: DataFrame, valid_topic: str, invalid_topic: str, source_group: str, at: Column) -> DataFrame:
    """Routing columns of a validated frame: topic, key, time and source group."""
    good = F.col("validation_status") == "valid"
    return df.withColumns(
        {
            "kafka_topic": F.when(good, valid_topic).otherwise(invalid_topic),
            "kafka_key": F.col("event_id"),
            "validated_at": at,
            "source_group": F.lit(source_group),
        }
    )


def core_fields(df: DataFrame, document: str) -> DataFrame:
    """Five core fields by JSON path; ``matched`` is false when one is absent."""
    # The paths that every event document must have.
    paths = {
        "event_id": "$.event_id",
        "event_type": "$.event_type",
        "user_id": "$.user_id",
        "amount": "$.amount",
        "timestamp": "$.timestamp",
    }
    out = df.withColumns({n: F.get_json_object(F.col(document), p) for n, p in paths.items()})
    found = F.lit(True)
    for name in paths:
        found = found & F.col(name).isNotNull()
    return out.withColumn("matched", found)


def load_metadata(df: DataFrame, source: str, kind: str, batch_id: str, at: Column) -> DataFrame:
    """Columns that say when, whence and by which run a row was loaded."""
    return df.withColumns(
        {
            "_ingested_at": at,
            "_source": F.lit(source),
            "_migration_type": F.lit(kind),
            "_batch_id": F.lit(batch_id),
        }
    )


def partner_view(df: DataFrame, masked: dict[str, Column], dropped: list[str]) -> DataFrame:
    """Feed for partners: some columns masked, some left out."""
    return df.withColumns(masked).drop(*dropped)
