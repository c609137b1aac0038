"""Moving relational tables into the lake and keeping them in step.

Readers are passed in as functions, usually built from ``sources.jdbc``; the
logic is the same for any source that gives DataFrames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators import latest, reconcile
from txlake.operators.standardize import load_metadata
from txlake.plans.medallion import Lake
from txlake.sources.versioned import VersionedTable

META = ["_ingested_at", "_source", "_migration_type", "_batch_id"]


def full_export(
    lake: Lake, tables: dict[str, DataFrame], source: str, batch_id: str, at: Column
) -> DataFrame:
    """Write every table whole; returns rows written per table and in total."""
    written = []
    for name, df in tables.items():
        target = lake.table(f"migration/{name}")
        loaded = load_metadata(df, source, "jdbc_full_export", batch_id, at)
        target.overwrite(loaded, [], operation="FULL EXPORT")
        written.append((name, target.metrics()["rows_written"]))
    written.append(("TOTAL", sum(n for _, n in written)))
    return lake.spark.createDataFrame(written, "table_name STRING, row_count BIGINT")


def high_water_mark(target: VersionedTable, column: str, floor):
    """Largest loaded value of a column, ``floor`` for an absent or empty table."""
    if not target.exists():
        return floor
    top = target.read().agg(F.max(column)).first()[0]
    return floor if top is None else top


@dataclass(frozen=True)
class Cursor:
    """Where a load goes on: the largest stamp that has been loaded, and the keys beyond which
    a stamp has no more rows.

    A stamp alone loses rows: those that the source commits later with the mark's own stamp,
    or with a slightly older one. So the source is read from ``overlap`` before the mark on,
    the mark included, and rows that the target holds with the same key and stamp are left
    out. Only the target's rows from there on are looked at.
    """

    column: str
    keys: tuple[str, ...]
    floor: object
    overlap: dt.timedelta | int | None = None

    def start(self, target: VersionedTable):
        mark = high_water_mark(target, self.column, self.floor)
        return mark if self.overlap is None or mark == self.floor else mark - self.overlap

    def fresh(self, target: VersionedTable, read_from: Callable[[object], DataFrame]) -> DataFrame:
        """Rows of the source that the target doesn't hold; ``read_from`` includes its argument."""
        start = self.start(target)
        rows = read_from(start)
        if not target.exists():
            return rows
        held = target.read()
        kind = held.schema[self.column].dataType
        names = [*self.keys, self.column]
        loaded = held.filter(F.col(self.column) >= F.lit(start).cast(kind)).select(
            *[F.col(c).alias(f"_held_{i}") for i, c in enumerate(names)]
        )
        same = [F.col(c).eqNullSafe(F.col(f"_held_{i}")) for i, c in enumerate(names)]
        return rows.join(loaded, reduce(lambda a, b: a & b, same), "left_anti")


def append_from(
    target: VersionedTable, read_from: Callable[[object], DataFrame], cursor: Cursor, source: str, batch_id: str, at: Column
) -> int:
    """Append what is new by a cursor; a repeated run adds nothing."""
    fresh = cursor.fresh(target, read_from)
    if target.exists() and fresh.isEmpty():
        return 0
    target.append(load_metadata(fresh, source, "incremental_append", batch_id, at))
    return target.metrics()["rows_written"]


def upsert_from(
    target: VersionedTable, read_from: Callable[[object], DataFrame], cursor: Cursor, source: str, batch_id: str, at: Column
) -> int:
    """Upsert what was modified by a cursor: the newest row of each key wins."""
    fresh = cursor.fresh(target, read_from)
    if target.exists() and fresh.isEmpty():
        return 0
    newest = latest.keep_latest(fresh, list(cursor.keys), [F.desc(cursor.column)])
    target.upsert(load_metadata(newest, source, "last_modified_upsert", batch_id, at), list(cursor.keys))
    return target.metrics()["rows_written"]


def incremental_append(
    target: VersionedTable,
    read_since: Callable[[object], DataFrame],
    column: str,
    floor,
    source: str,
    batch_id: str,
    at: Column,
) -> int:
    """Append rows beyond the target's high-water mark; for insert-only sources.

    The mark comes from the target itself, so a lost run is simply repeated.
    """
    fresh = read_since(high_water_mark(target, column, floor))
    if target.exists() and fresh.isEmpty():
        return 0
    target.append(load_metadata(fresh, source, "incremental_append", batch_id, at))
    return target.metrics()["rows_written"]


def last_modified_upsert(
    target: VersionedTable,
    read_since: Callable[[object], DataFrame],
    column: str,
    keys: list[str],
    floor,
    source: str,
    batch_id: str,
    at: Column,
) -> int:
    """Upsert rows modified since the target's high-water mark."""
    changed = read_since(high_water_mark(target, column, floor))
    newest = latest.keep_latest(changed, keys, [F.desc(column)])
    if target.exists() and changed.isEmpty():
        return 0
    target.upsert(load_metadata(newest, source, "last_modified_upsert", batch_id, at), keys)
    return target.metrics()["rows_written"]


def verify(lake: Lake, sources: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Counts and keys of every source table against the lake, one row per table."""
    out = None
    for name, (df, keys) in sources.items():
        row = reconcile.reconcile(df, lake.table(f"migration/{name}").read(), keys, name)
        out = row if out is None else out.unionByName(row)
    return out


def refresh_table(
    lake: Lake, name: str, df: DataFrame, source: str, batch_id: str, at: Column
) -> DataFrame:
    """Full refresh of one table chosen by the caller; returns its row count."""
    return full_export(lake, {name: df}, source, batch_id, at).filter(F.col("table_name") != "TOTAL")
