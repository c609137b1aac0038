"""Declared schemas of every layer.

Field names, order and types are the contract with upstream and downstream
systems; they are fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "BINARY": T.BinaryType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "MERCHANT": T.StructType([T.StructField(n, T.StringType()) for n in ("id", "name", "category")]),
}


def _schema(columns: str) -> T.StructType:
    """``name TYPE [NOT NULL], ...`` as a schema; needs no running session."""
    fields = []
    for column in columns.split(","):
        name, kind, *rest = column.split()
        fields.append(T.StructField(name, _TYPES[kind], rest != ["NOT", "NULL"]))
    return T.StructType(fields)


# Raw records ---------------------------------------------------------------

TOPIC_ROW = _schema(
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# Numbers are decoded as text and cast leniently later, so that numeric text
# passes and unreadable numbers can be told from missing ones.
RAW_EVENT = _schema(
    "tx_id STRING, user_id STRING, tx_type STRING, amount STRING, currency STRING, "
    "merchant_id STRING, merchant_category STRING, status STRING, timestamp STRING, source STRING"
)

API_PAYMENT = _schema(
    "event_id STRING, event_type STRING, user_id STRING, amount STRING, currency STRING, "
    "merchant MERCHANT, channel STRING, "
    "status STRING, is_suspicious STRING, timestamp STRING, source STRING"
)

API_ENVELOPE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("count", T.IntegerType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("data", T.ArrayType(API_PAYMENT)),
    ]
)

SETTLEMENT_CSV = _schema(
    "settlement_id STRING, batch_id STRING, merchant_id STRING, merchant_name STRING, "
    "merchant_category STRING, settlement_type STRING, gross_amount STRING, fee_amount STRING, "
    "net_amount STRING, currency STRING, tx_count STRING, settlement_date STRING, "
    "created_at STRING, status STRING"
)

CUSTOMER_ROW = _schema(
    "customer_id INT, user_id INT, name STRING, email STRING, phone STRING, grade STRING, "
    "is_active BOOLEAN, created_at STRING, updated_at STRING"
)

STREAM_EVENT = _schema(
    "event_id STRING, event_type STRING, user_id BIGINT, amount DOUBLE, currency STRING, "
    "status STRING, data_source STRING, event_timestamp STRING, schema_version STRING, "
    "ingested_at STRING, merchant_id STRING, merchant_name STRING, merchant_category STRING, "
    "channel STRING, is_suspicious BOOLEAN"
)

CDC_ROW = _schema(
    "settlement_id BIGINT, merchant_id BIGINT, settlement_date STRING, total_amount BIGINT, "
    "fee_amount BIGINT, net_amount BIGINT, tx_count INT, status STRING, processed_at STRING, "
    "completed_at STRING, created_at STRING, updated_at STRING, __op STRING, "
    "__source_ts_ms BIGINT, __deleted STRING, __db STRING, __table STRING"
)

# Standard event: the common shape of all three sources ----------------------

STANDARD_EVENT = _schema(
    "event_id STRING NOT NULL, event_type STRING NOT NULL, user_id INT, amount DOUBLE, "
    "currency STRING, merchant_id STRING, merchant_name STRING, merchant_category STRING, "
    "channel STRING, status STRING, is_suspicious BOOLEAN NOT NULL, "
    "event_timestamp STRING NOT NULL, ingested_at STRING, data_source STRING NOT NULL, "
    "schema_version STRING NOT NULL, created_at STRING, fee_amount DOUBLE, net_amount DOUBLE, "
    "tx_count INT, batch_id STRING, customer_name STRING, customer_email STRING, "
    "customer_phone STRING, customer_grade STRING, is_active BOOLEAN"
)

STANDARD_REQUIRED = [f.name for f in STANDARD_EVENT if not f.nullable]

# Layer tables ----------------------------------------------------------------

BRONZE = _schema(
    "kafka_key STRING, kafka_value STRING, kafka_topic STRING, kafka_partition INT, "
    "kafka_offset BIGINT, kafka_timestamp TIMESTAMP, ingest_date DATE, ingest_timestamp TIMESTAMP"
)

SILVER = _schema(
    "tx_id STRING, user_id STRING, tx_type STRING, amount DOUBLE, currency STRING, "
    "merchant_id STRING, merchant_category STRING, status STRING, event_timestamp TIMESTAMP, "
    "tx_date DATE, tx_hour INT, source_system STRING, is_anomaly BOOLEAN, quality_flags STRING, "
    "processed_timestamp TIMESTAMP"
)

GOLD_DAILY_SUMMARY = _schema(
    "summary_date DATE, tx_type STRING, total_count BIGINT, success_count BIGINT, "
    "failed_count BIGINT, total_amount DOUBLE, avg_amount DOUBLE, min_amount DOUBLE, "
    "max_amount DOUBLE, unique_users BIGINT, anomaly_count BIGINT, generated_at TIMESTAMP"
)

GOLD_CUSTOMER_STATS = _schema(
    "user_id STRING, stats_month STRING, total_tx_count BIGINT, total_amount DOUBLE, "
    "avg_amount DOUBLE, payment_count BIGINT, refund_count BIGINT, transfer_count BIGINT, "
    "anomaly_count BIGINT, first_tx_date DATE, last_tx_date DATE, generated_at TIMESTAMP"
)

GOLD_FEE_SETTLEMENT = _schema(
    "settlement_date DATE, merchant_id STRING, merchant_category STRING, "
    "total_payment_amount DOUBLE, total_refund_amount DOUBLE, net_amount DOUBLE, "
    "fee_rate DOUBLE, fee_amount DOUBLE, settlement_amount DOUBLE, tx_count BIGINT, "
    "generated_at TIMESTAMP"
)

WINDOW_RESULT = _schema(
    "event_type STRING, window_start STRING, window_end STRING, transaction_count BIGINT, "
    "total_amount DOUBLE, avg_amount DOUBLE, max_amount DOUBLE, min_amount DOUBLE"
)

FRAUD_ALERT = _schema(
    "alert_id STRING, rule_id STRING, rule_description STRING, user_id BIGINT, severity STRING, "
    "trigger_event_id STRING, trigger_amount DOUBLE, event_count BIGINT, detected_at STRING"
)
