"""Queries that write tables on the way: versions, merges, change feeds,
migration, medallion, file ingest. Each call works in its own folder below the
shared root, so that calls cannot disturb each other."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from txlake import schemas
from txlake.functions.money import money
from txlake.functions.text import json_value
from txlake.operators import cdc, gold, profile, reconcile
from txlake.operators import standardize as std
from txlake.plans import medallion, migration
from txlake.plans.inputs import CHANGES_SQL, TX_SQL, order_changes, transactions
from txlake.plans.queries_batch import (
    CANON_SQL,
    DAILY_SQL,
    LOADED_AT,
    api_rows,
    settlement_rows,
)
from txlake.plans.registry import query
from txlake.session import scratch
from txlake.sources import files
from txlake.sources.buckets import BucketTable
from txlake.sources.files import table
from txlake.sources.versioned import VersionedTable

# -- merges and versions -----------------------------------------------------------

SPLIT = dt.datetime(1998, 1, 1)
BEFORE = "o_orderdate < TIMESTAMP '1998-01-01'"


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )


def _early(spark, folder):
    moment = F.lit(SPLIT).cast("timestamp_ntz")
    return _orders(spark, folder).filter(F.col("o_orderdate") < moment)


def _fresh(spark, folder):
    """All orders as delivered later: prices have changed by one."""
    return _orders(spark, folder).withColumn(
        "o_totalprice", (money("o_totalprice") + F.lit(1)).cast("double")
    )


FRESH_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(28,8)) + 1 AS DOUBLE)"


def _table_with_early(spark, folder, name):
    target = VersionedTable(spark, scratch(spark, name))
    target.overwrite(_early(spark, folder), ["o_orderstatus"], operation="CREATE")
    return target


@query(
    "merge_insert_only",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN {BEFORE} THEN o_totalprice ELSE {FRESH_PRICE} END AS o_totalprice, o_orderdate FROM orders""",
)
def merge_insert_only(spark, folder):
    target = _table_with_early(spark, folder, "insert-only")
    target.insert_new(_fresh(spark, folder), ["o_orderkey"])
    target.insert_new(_fresh(spark, folder), ["o_orderkey"])
    return target.read()


@query(
    "merge_upsert",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, {FRESH_PRICE} AS o_totalprice, o_orderdate FROM orders",
)
def merge_upsert(spark, folder):
    target = _table_with_early(spark, folder, "upsert")
    target.upsert(_fresh(spark, folder), ["o_orderkey"])
    return target.read()


@query(
    "soft_delete",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_totalprice > 300000 THEN 'true' ELSE 'false' END AS deleted FROM orders""",
)
def soft_delete(spark, folder):
    target = VersionedTable(spark, scratch(spark, "soft-delete"))
    rows = _orders(spark, folder).select("o_orderkey", "o_orderstatus", "o_totalprice")
    target.overwrite(rows.withColumn("deleted", F.lit("false")), ["o_orderstatus"])
    gone = _orders(spark, folder).filter(F.col("o_totalprice") > 300_000)
    target.update_matching(gone, ["o_orderkey"], {"deleted": F.lit("true")})
    return target.read()


@query(
    "bucketed_upsert",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 50 = 1 OR NOT {BEFORE} THEN {FRESH_PRICE} ELSE o_totalprice END AS o_totalprice, o_orderdate FROM orders",
)
def bucketed_upsert(spark, folder):
    """Newer orders and one in fifty old ones with a new price, merged into the buckets of their keys."""
    target = BucketTable(spark, scratch(spark, "bucket-upsert"), ["o_orderkey"], 16)
    target.create(_early(spark, folder))
    moment = F.lit(SPLIT).cast("timestamp_ntz")
    target.upsert(_fresh(spark, folder).filter((F.col("o_orderkey") % 50 == 1) | ~(F.col("o_orderdate") < moment)))
    return target.read()


@query(
    "bucketed_soft_delete",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_totalprice > 300000 THEN 'true' ELSE 'false' END AS deleted FROM orders""",
)
def bucketed_soft_delete(spark, folder):
    target = BucketTable(spark, scratch(spark, "bucket-delete"), ["o_orderkey"], 16)
    rows = _orders(spark, folder).select("o_orderkey", "o_orderstatus", "o_totalprice")
    target.create(rows.withColumn("deleted", F.lit("false")))
    target.update_matching(rows.filter(F.col("o_totalprice") > 300_000), {"deleted": F.lit("true")})
    return target.read()


@query(
    "overwrite_partitions",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def overwrite_partitions(spark, folder):
    target = VersionedTable(spark, scratch(spark, "partitions"))
    rows = _orders(spark, folder).select("o_orderkey", "o_orderstatus", "o_totalprice")
    target.overwrite(rows, ["o_orderstatus"])
    cancelled = rows.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0))
    target.overwrite_partitions(cancelled, ["o_orderstatus"])
    return target.read()


@query(
    "schema_evolution",
    f"""SELECT o_orderkey, o_totalprice, NULL AS channel FROM orders WHERE {BEFORE}
UNION ALL SELECT o_orderkey, o_totalprice, 'WEB' FROM orders WHERE NOT ({BEFORE})""",
)
def schema_evolution(spark, folder):
    target = VersionedTable(spark, scratch(spark, "evolution"))
    target.overwrite(_early(spark, folder).select("o_orderkey", "o_totalprice"))
    moment = F.lit(SPLIT).cast("timestamp_ntz")
    rest = _orders(spark, folder).filter(F.col("o_orderdate") >= moment)
    rest = rest.select("o_orderkey", "o_totalprice", F.lit("WEB").alias("channel"))
    target.append(rest, merge_schema=True)
    return target.read()


def _two_versions(spark, folder, name):
    target = _table_with_early(spark, folder, name)
    moved = _fresh(spark, folder).filter("o_orderstatus <> 'O'")
    target.upsert(moved, ["o_orderkey"])
    return target


@query(
    "time_travel",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE {BEFORE}",
)
def time_travel(spark, folder):
    return _two_versions(spark, folder, "travel").read(version=0)


@query(
    "version_diff",
    f"""SELECT o_orderkey, CASE WHEN {BEFORE} THEN 'changed' ELSE 'added' END AS change FROM orders WHERE o_orderstatus <> 'O'""",
)
def version_diff(spark, folder):
    target = _two_versions(spark, folder, "diff")
    return reconcile.row_difference(target.read(version=0), target.read(), ["o_orderkey"])


@query(
    "version_summary",
    f"""SELECT COUNT(*) FILTER (WHERE NOT ({BEFORE}) AND o_orderstatus <> 'O') AS added, CAST(0 AS BIGINT) AS removed,
  COUNT(*) FILTER (WHERE {BEFORE} AND o_orderstatus <> 'O') AS changed, COUNT(*) FILTER (WHERE {BEFORE}) AS old_count,
  COUNT(*) FILTER (WHERE {BEFORE} OR o_orderstatus <> 'O') AS new_count,
  COUNT(*) FILTER (WHERE NOT ({BEFORE}) AND o_orderstatus <> 'O') AS delta FROM orders""",
)
def version_summary(spark, folder):
    target = _two_versions(spark, folder, "summary")
    return reconcile.version_summary(target.read(version=0), target.read(), ["o_orderkey"])


@query(
    "table_history",
    f"""SELECT CAST(2 AS BIGINT) AS version, 'RESTORE' AS operation, CAST(NULL AS BIGINT) AS rows_written
UNION ALL SELECT 1, 'MERGE', COUNT(*) FILTER (WHERE o_orderstatus <> 'O' OR {BEFORE}) FROM orders
UNION ALL SELECT 0, 'CREATE', COUNT(*) FILTER (WHERE {BEFORE}) FROM orders""",
)
def table_history(spark, folder):
    target = _two_versions(spark, folder, "history")
    target.restore(0)
    rows = F.try_element_at("metrics", F.lit("rows_written"))
    return target.history(3).select("version", "operation", rows.alias("rows_written"))


@query(
    "restore_version",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE {BEFORE}",
)
def restore_version(spark, folder):
    target = _two_versions(spark, folder, "restore")
    target.restore(0)
    return target.read()


@query(
    "compact_zorder",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem",
)
def compact_zorder(spark, folder):
    target = VersionedTable(spark, scratch(spark, "compact"))
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag"
    )
    target.overwrite(rows, ["l_returnflag"])
    target.compact(order_by=["l_partkey", "l_extendedprice"])
    return target.read()


@query(
    "vacuum",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN {FRESH_PRICE} ELSE o_totalprice END AS o_totalprice, o_orderdate
FROM orders WHERE {BEFORE} OR o_orderstatus <> 'O'""",
)
def vacuum(spark, folder):
    target = _two_versions(spark, folder, "vacuum")
    target.compact()
    target.vacuum(retention_hours=0)
    return target.read()


# -- change feeds --------------------------------------------------------------------


@query(
    "cdc_unwrap",
    f"""WITH {CHANGES_SQL} SELECT settlement_id, merchant_id, total_amount, status, op AS __op, ts_ms AS __source_ts_ms,
  CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted, 'shop' AS __db, 'orders' AS __table FROM changes""",
)
def cdc_unwrap(spark, folder):
    return cdc.unwrap(order_changes(spark, folder))


CDC_STATE_SQL = """
SELECT o_orderkey AS settlement_id, o_custkey AS merchant_id, o_totalprice AS total_amount,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'FAILED' ELSE 'PENDING' END AS status,
  CASE WHEN o_orderstatus = 'P' THEN 'true' ELSE 'false' END AS __deleted FROM orders"""


def _cdc_state(spark, folder, hard_delete=False):
    """Applies the feed in three batches: creates, updates, then deletes."""
    changes = cdc.unwrap(order_changes(spark, folder), position="offset")
    order, extras = ["__source_ts_ms", "__offset"], ("__offset",)
    at = F.lit(dt.datetime(2024, 1, 1))
    target = VersionedTable(spark, scratch(spark, "cdc"))
    for op in ["c", "u", "d"]:
        current = target.read() if target.exists() else None
        batch = changes.filter(F.col("__op") == op)
        target.overwrite(cdc.apply_changes(current, batch, ["settlement_id"], order, at, hard_delete, extras))
    return target.read()


@query("cdc_apply", CDC_STATE_SQL)
def cdc_apply(spark, folder):
    return _cdc_state(spark, folder).select(
        "settlement_id", "merchant_id", "total_amount", "status", "__deleted"
    )


@query("cdc_apply_one_batch", CDC_STATE_SQL)
def cdc_apply_one_batch(spark, folder):
    changes = cdc.unwrap(order_changes(spark, folder), position="offset")
    state = cdc.apply_changes(
        None, changes, ["settlement_id"], ["__source_ts_ms", "__offset"], F.lit(dt.datetime(2024, 1, 1))
    )
    return state.select("settlement_id", "merchant_id", "total_amount", "status", "__deleted")


@query(
    "cdc_hard_delete",
    f"SELECT settlement_id, total_amount, status FROM ({CDC_STATE_SQL}) WHERE __deleted = 'false'",
)
def cdc_hard_delete(spark, folder):
    return _cdc_state(spark, folder, hard_delete=True).select("settlement_id", "total_amount", "status")


@query(
    "cdc_state_counts",
    f"SELECT status, __deleted, COUNT(*) AS row_count FROM ({CDC_STATE_SQL}) GROUP BY ALL",
)
def cdc_state_counts(spark, folder):
    return profile.count_by(_cdc_state(spark, folder), "status", "__deleted")


# -- migration -----------------------------------------------------------------------


def _at():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


@query(
    "full_export",
    """SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer UNION ALL SELECT 'supplier', COUNT(*) FROM supplier
UNION ALL SELECT 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'TOTAL', (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM supplier) + (SELECT COUNT(*) FROM orders)""",
)
def full_export(spark, folder):
    lake = medallion.Lake(spark, scratch(spark, "export"))
    tables = {n: table(spark, folder, n) for n in ["customer", "supplier", "orders"]}
    return migration.full_export(lake, tables, "mysql.shop", "batch-1", _at())


@query(
    "migration_verify",
    """SELECT 'customer' AS table_name, COUNT(*) AS source_count, COUNT(*) AS target_count, CAST(0 AS BIGINT) AS missing_keys, CAST(0 AS BIGINT) AS extra_keys, 'PASS' AS verdict FROM customer
UNION ALL SELECT 'orders', COUNT(*), COUNT(*), 0, 0, 'PASS' FROM orders""",
)
def migration_verify(spark, folder):
    lake = medallion.Lake(spark, scratch(spark, "verify"))
    tables = {n: table(spark, folder, n) for n in ["customer", "orders"]}
    migration.full_export(lake, tables, "mysql.shop", "batch-1", _at())
    return migration.verify(
        lake, {"customer": (tables["customer"], ["c_custkey"]), "orders": (tables["orders"], ["o_orderkey"])}
    )


@query(
    "incremental_append",
    f"""SELECT o_orderkey, o_totalprice, o_orderdate, CASE WHEN {BEFORE} THEN 'batch-1' ELSE 'batch-2' END AS _batch_id,
  'incremental_append' AS _migration_type, 'mysql.shop' AS _source FROM orders""",
)
def incremental_append(spark, folder):
    target = VersionedTable(spark, scratch(spark, "incremental"))
    floor = dt.datetime(1900, 1, 1)

    def since(rows):
        return lambda last: rows.filter(F.col("o_orderdate") > F.lit(last).cast("timestamp_ntz"))

    for batch, rows in [("batch-1", _early(spark, folder)), ("batch-2", _orders(spark, folder))]:
        migration.incremental_append(target, since(rows), "o_orderdate", floor, "mysql.shop", batch, _at())
    # A repeated run finds nothing beyond the mark and adds nothing.
    again = since(_orders(spark, folder))
    migration.incremental_append(target, again, "o_orderdate", floor, "mysql.shop", "batch-3", _at())
    return target.read().select(
        "o_orderkey", "o_totalprice", "o_orderdate", "_batch_id", "_migration_type", "_source"
    )


@query(
    "last_modified_upsert",
    """SELECT o_orderkey, o_orderstatus, o_totalprice,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate ELSE GREATEST(o_orderdate, TIMESTAMP '1998-01-01') END AS updated_at FROM orders""",
)
def last_modified_upsert(spark, folder):
    """First load: early orders while all of them were still open; then the source
    has moved most of them on and received new ones."""
    target = VersionedTable(spark, scratch(spark, "modified"))
    first = _early(spark, folder).withColumn("o_orderstatus", F.lit("O"))
    first = first.withColumn("updated_at", F.col("o_orderdate"))
    closed_at = F.greatest("o_orderdate", F.lit(SPLIT).cast("timestamp_ntz"))
    now = _orders(spark, folder).withColumn(
        "updated_at", F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate")).otherwise(closed_at)
    )
    floor = dt.datetime(1900, 1, 1)
    for batch, rows in [("batch-1", first), ("batch-2", now)]:
        migration.last_modified_upsert(
            target,
            lambda last, rows=rows: rows.filter(F.col("updated_at") > F.lit(last).cast("timestamp_ntz")),
            "updated_at",
            ["o_orderkey"],
            floor,
            "mysql.shop",
            batch,
            _at(),
        )
    return target.read().select("o_orderkey", "o_orderstatus", "o_totalprice", "updated_at")


@query(
    "incremental_cursor",
    f"""SELECT o_orderkey, o_orderdate, CASE WHEN {BEFORE} AND (o_orderkey % 2 = 0 OR o_orderdate < (SELECT MAX(o_orderdate) FROM orders WHERE {BEFORE}))
  THEN 'batch-1' ELSE 'batch-2' END AS _batch_id FROM orders""",
)
def incremental_cursor(spark, folder):
    """The source adds rows with the very stamp of the mark after the first load; none is lost."""
    target = VersionedTable(spark, scratch(spark, "cursor"))
    early, rows = _early(spark, folder), _orders(spark, folder)
    newest = early.agg(F.max("o_orderdate")).first()[0]
    at_mark = F.col("o_orderdate") == F.lit(newest).cast("timestamp_ntz")
    first = early.filter(~at_mark | (F.col("o_orderkey") % 2 == 0))
    cursor = migration.Cursor("o_orderdate", ("o_orderkey",), dt.datetime(1900, 1, 1), dt.timedelta(days=1))
    for batch, source in [("batch-1", first), ("batch-2", rows), ("batch-3", rows)]:
        read_from = lambda start, source=source: source.filter(F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))
        migration.append_from(target, read_from, cursor, "mysql.shop", batch, _at())
    return target.read().select("o_orderkey", "o_orderdate", "_batch_id")


@query(
    "upsert_cursor",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'P' ELSE 'O' END AS o_orderstatus, TIMESTAMP '2024-01-01' AS updated_at FROM orders""",
)
def upsert_cursor(spark, folder):
    """All rows carry one stamp; a third of them arrives after the others, with that same stamp."""
    target = VersionedTable(spark, scratch(spark, "upsert-cursor"))
    stamp = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    late = F.col("o_orderkey") % 3 == 0
    rows = _orders(spark, folder).select("o_orderkey", F.when(late, "P").otherwise("O").alias("o_orderstatus"), stamp.alias("updated_at"))
    cursor = migration.Cursor("updated_at", ("o_orderkey",), dt.datetime(1900, 1, 1))
    for batch, source in [("batch-1", rows.filter(~late)), ("batch-2", rows)]:
        read_from = lambda start, source=source: source.filter(F.col("updated_at") >= F.lit(start).cast("timestamp_ntz"))
        migration.upsert_from(target, read_from, cursor, "mysql.shop", batch, _at())
    return target.read().select("o_orderkey", "o_orderstatus", "updated_at")


@query(
    "refresh_table",
    """SELECT table_name, row_count FROM (VALUES ('supplier', (SELECT COUNT(*) FROM supplier)), ('customer', (SELECT COUNT(*) FROM customer WHERE c_acctbal > 0))) v(table_name, row_count)""",
)
def refresh_table(spark, folder):
    """Two tables are exported, then one of them alone is read again."""
    lake = medallion.Lake(spark, scratch(spark, "refresh"))
    tables = {n: table(spark, folder, n) for n in ["customer", "supplier"]}
    migration.full_export(lake, tables, "mysql.shop", "batch-1", _at())
    migration.refresh_table(lake, "customer", tables["customer"].filter("c_acctbal > 0"), "mysql.shop", "batch-2", _at())
    return profile.table_counts({n: lake.table(f"migration/{n}").read() for n in tables})


PLANTED = "o_orderkey % 997 = 5"
LOST = "o_orderkey % 1499 = 7"
ADDED = "o_orderkey % 1999 = 11"


@query(
    "reconcile_tree",
    f"""SELECT o_orderkey, o_totalprice, 'source' AS side FROM orders WHERE {PLANTED} OR {LOST}
UNION ALL SELECT o_orderkey, {FRESH_PRICE}, 'target' FROM orders WHERE {PLANTED} AND NOT ({LOST})
UNION ALL SELECT -o_orderkey, o_totalprice, 'target' FROM orders WHERE {ADDED}""",
)
def reconcile_tree(spark, folder):
    """Changed, lost and added rows, found by going down a tree of checksums."""
    source = _orders(spark, folder)
    price = F.when(F.expr(PLANTED), (money("o_totalprice") + F.lit(1)).cast("double")).otherwise(F.col("o_totalprice"))
    target = source.filter(~F.expr(LOST)).withColumn("o_totalprice", price)
    target = target.unionByName(source.filter(ADDED).withColumn("o_orderkey", -F.col("o_orderkey")))
    trees = [scratch(spark, "tree"), scratch(spark, "tree")]
    tops = [reconcile.write_checksum_tree(df, "o_orderkey", path) for df, path in zip([source, target], trees)]
    found = reconcile.differing_rows(source, target, "o_orderkey", *trees, min(tops))
    return found.select("o_orderkey", "o_totalprice", "side")


@query(
    "monthly_users_sketched",
    f"""WITH {TX_SQL} SELECT strftime(tx_date, '%Y-%m') AS stats_month, tx_type, COUNT(DISTINCT tx_date) AS days,
  COUNT(DISTINCT user_id) AS exact_users, TRUE AS within_two_percent FROM tx GROUP BY 1, 2""",
)
def monthly_users_sketched(spark, folder):
    """Daily sketches are kept as a table; a month's users come from them, beside the exact number."""
    tx, path = transactions(spark, folder), scratch(spark, "sketches")
    gold.daily_user_sketches(tx).write.partitionBy("summary_date").parquet(path)
    month = F.date_format("summary_date", "yyyy-MM").alias("stats_month")
    merged = gold.unique_users(spark.read.parquet(path), month, F.col("tx_type"))
    exact = tx.groupBy(F.date_format("tx_date", "yyyy-MM").alias("stats_month"), "tx_type").agg(
        F.count_distinct("user_id").alias("exact_users")
    )
    close = F.abs(F.col("unique_users") - F.col("exact_users")) <= 0.02 * F.col("exact_users")
    return merged.join(exact, ["stats_month", "tx_type"]).select(
        "stats_month", "tx_type", F.col("sketches").alias("days"), "exact_users", close.alias("within_two_percent")
    )


# -- medallion -------------------------------------------------------------------------

LAKE_RULES = [
    {"id": "CMP-001", "type": "completeness", "severity": "critical", "fields": ["tx_id", "user_id", "tx_type", "amount", "timestamp"]},
    {"id": "UNQ-001", "type": "uniqueness", "severity": "critical", "key_fields": ["tx_id"], "strategy": "keep_latest"},
    {"id": "VLD-001", "type": "validity", "severity": "critical", "field": "tx_type",
     "allowed_values": ["PAYMENT", "REFUND", "TRANSFER", "WITHDRAWAL"]},
    {"id": "VLD-002", "type": "validity", "severity": "warning", "field": "amount", "min_value": 1, "max_value": 150},
    {"id": "VLD-003", "type": "validity", "severity": "critical", "field": "status", "allowed_values": ["SUCCESS", "FAILED", "PENDING"]},
    {"id": "VLD-004", "type": "validity", "severity": "critical", "field": "amount", "min_value": 0},
]


def as_topic(tx):
    """Transactions as topic rows, the way a producer would have sent them."""
    event = F.struct(
        "tx_id",
        F.col("user_id").cast("string").alias("user_id"),
        "tx_type",
        "amount",
        "currency",
        "merchant_id",
        "merchant_category",
        "status",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        F.lit("api").alias("source"),
    )
    return tx.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(event).cast("binary").alias("value"),
        F.lit("events.ingested").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _lake(spark, folder, name):
    lake = medallion.Lake(spark, scratch(spark, name))
    topic = as_topic(transactions(spark, folder))
    settings = medallion.Settings(rules=LAKE_RULES, now=_at())
    first, last = topic.agg(F.to_date(F.min("timestamp")), F.to_date(F.max("timestamp"))).first()
    medallion.run(lake, topic, first, last + dt.timedelta(days=1), settings)
    return lake, topic, settings


SILVER_SQL = f"""{TX_SQL.replace("tx AS (", "all_tx AS (")},
tx AS (SELECT * REPLACE ((amount < 1 OR amount > 150) AS is_anomaly, CAST(user_id AS VARCHAR) AS user_id) FROM all_tx WHERE tx_type <> 'ERROR')"""


@query("medallion_gold", f"WITH {SILVER_SQL} {DAILY_SQL}")
def medallion_gold(spark, folder):
    lake, _, _ = _lake(spark, folder, "medallion")
    return lake.table("gold/daily_summary").read().drop("generated_at")


@query(
    "backfill_idempotent",
    f"""WITH {SILVER_SQL} SELECT user_id, strftime(tx_date, '%Y-%m') AS stats_month, COUNT(*) AS total_tx_count,
  CAST(ROUND(SUM(CAST(amount AS DECIMAL(28,8))), 6) AS DOUBLE) AS total_amount, COUNT(*) FILTER (WHERE is_anomaly) AS anomaly_count,
  CAST(MIN(tx_date) AS VARCHAR) AS first_tx_date, CAST(MAX(tx_date) AS VARCHAR) AS last_tx_date FROM tx GROUP BY ALL""",
)
def backfill_idempotent(spark, folder):
    """All days at once, then two of them again: the result must not change."""
    lake, topic, settings = _lake(spark, folder, "backfill")
    for day in [dt.date(2024, 1, 10), dt.date(2024, 1, 11)]:
        medallion.run(lake, topic, day, settings=settings)
    stats = lake.table("gold/customer_stats").read()
    return stats.select(
        "user_id", "stats_month", "total_tx_count", "total_amount", "anomaly_count", "first_tx_date", "last_tx_date"
    )


@query(
    "medallion_layers",
    """SELECT 'bronze' AS table_name, COUNT(*) AS row_count FROM events
UNION ALL SELECT 'silver', COUNT(*) FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'quarantine', COUNT(*) FROM events WHERE event_type = 'error'""",
)
def medallion_layers(spark, folder):
    lake, _, _ = _lake(spark, folder, "layers")
    return profile.table_counts({n: lake.table(n).read() for n in ["bronze", "silver", "quarantine"]})


@query(
    "gold_not_empty",
    """SELECT t AS table_name, (SELECT COUNT(*) FROM events WHERE event_type <> 'error') > 0 AS has_rows
FROM (VALUES ('gold/daily_summary'), ('gold/customer_stats'), ('gold/fee_settlement')) v(t)""",
)
def gold_not_empty(spark, folder):
    lake, _, _ = _lake(spark, folder, "not-empty")
    return medallion.gold_not_empty(lake)


@query(
    "publish_day",
    f"""WITH {SILVER_SQL} SELECT tx_type, total_count, total_amount FROM ({DAILY_SQL}) WHERE summary_date = '2024-01-15'""",
)
def publish_day(spark, folder):
    lake, _, _ = _lake(spark, folder, "publish")
    out = scratch(spark, "report")
    medallion.publish_day(lake, "gold/daily_summary", "summary_date", dt.date(2024, 1, 15), out)
    schema = "tx_type STRING, total_count BIGINT, total_amount DOUBLE"
    return spark.read.schema(schema).json(out)


# -- file ingest -------------------------------------------------------------------------


@query(
    "csv_ingest",
    f"""WITH {CANON_SQL} SELECT event_id, event_type, CAST(amount AS DOUBLE) AS amount, CAST(tx_count AS INTEGER) AS tx_count,
  event_timestamp, batch_id FROM files WHERE TRY_CAST(tx_count AS INTEGER) IS NOT NULL""",
)
def csv_ingest(spark, folder):
    path = scratch(spark, "csv")
    settlement_rows(spark, folder).select(*schemas.SETTLEMENT_CSV.names).write.option("header", "true").csv(path)
    landed = files.settlement_csv(spark, path, pattern="*.csv")
    good, _ = std.split_valid(std.validate(std.from_settlement(landed, F.lit(LOADED_AT), carry=("filename",))))
    return good.select("event_id", "event_type", "amount", "tx_count", "event_timestamp", "batch_id")


@query(
    "api_envelope_ingest",
    f"""WITH {CANON_SQL} SELECT event_id, event_type, user_id, amount, merchant_id, merchant_name, is_suspicious, event_timestamp FROM api""",
)
def api_envelope_ingest(spark, folder):
    """Events landed as API responses of one element each, then unfolded again."""
    path = scratch(spark, "api")
    rows = api_rows(spark, folder)
    envelope = rows.select(
        F.lit("ok").alias("status"),
        F.lit(1).alias("count"),
        F.col("timestamp").alias("fetched_at"),
        F.array(F.struct(*schemas.API_PAYMENT.names)).alias("data"),
    )
    envelope.write.json(path)
    events = files.api_payments(spark, path)
    return std.from_api(events, F.lit(LOADED_AT)).select(
        "event_id", "event_type", "user_id", "amount", "merchant_id", "merchant_name", "is_suspicious", "event_timestamp"
    )


@query(
    "jsonl_bronze",
    """SELECT event_type, COUNT(*) AS row_count, COUNT(*) AS distinct_offsets FROM events GROUP BY event_type""",
)
def jsonl_bronze(spark, folder):
    """JSON lines loaded twice by insert-only merge: nothing doubles."""
    path = scratch(spark, "jsonl")
    # Dropping the id makes equal lines possible, as in real exports.
    lines = table(spark, folder, "events").select("user_id", "event_type", "value", "props")
    lines.select(json_value(*lines.columns).alias("value")).write.text(path)
    bronze = VersionedTable(spark, scratch(spark, "bronze"))
    for _ in range(2):
        rows = files.json_lines_bronze(spark, path, "events.ingested", dt.date(2024, 1, 1), _at())
        bronze.insert_new(rows, files.FILE_BRONZE_KEYS, ["ingest_date"], distinct=True)
    kind = F.get_json_object("kafka_value", "$.event_type").alias("event_type")
    return bronze.read().groupBy(kind).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("kafka_offset").alias("distinct_offsets")
    )
