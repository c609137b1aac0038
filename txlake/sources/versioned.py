"""Versioned tables on plain Parquet.

A table is a folder ``data/commit=<n>/<partition folders>`` of Parquet files
written by Spark, and one small JSON record per version that says which of
those folders make up the version. Writers never touch older folders, so every
version stays readable until ``vacuum``; a lost writer leaves only an unlisted
folder. Reading resolves a version to its folders and hands them to
``spark.read.parquet``: pruning, pushdown and statistics are Spark's own.

One writer at a time is assumed; the version record is created exclusively, so
a second writer of the same version fails instead of overwriting.
"""

from __future__ import annotations

import json
import time
import uuid
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.operators.clustering import z_value
from txlake.sources import fs

# Rows that one task of a clustering rewrite sorts on average; narrow rows compress well, so
# the bytes of the files alone do not bound what a task holds.
SORTED_ROWS = 1 << 21

HISTORY_SCHEMA = "version BIGINT, timestamp_ms BIGINT, operation STRING, metrics MAP<STRING, BIGINT>"


@dataclass
class Version:
    version: int
    timestamp_ms: int
    operation: str
    schema: T.StructType
    partition_by: list[str]
    # partition folder (empty for an unpartitioned table) -> commit folders
    folders: dict[str, list[str]]
    metrics: dict[str, int] = field(default_factory=dict)
    # commit folder -> number of partition folders it was written with
    sizes: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "timestamp_ms": self.timestamp_ms,
                "operation": self.operation,
                "schema": self.schema.json(),
                "partition_by": self.partition_by,
                "folders": self.folders,
                "metrics": self.metrics,
                "sizes": self.sizes,
            }
        )

    @staticmethod
    def from_json(text: str) -> Version:
        raw = json.loads(text)
        raw["schema"] = T.StructType.fromJson(json.loads(raw["schema"]))
        return Version(**raw)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def null_safe_equal(left: str, right: str, keys: Iterable[str]) -> Column:
    condition = None
    for key in keys:
        one = F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
        condition = one if condition is None else condition & one
    return condition


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._data = f"{self.path}/data"
        self._log = f"{self.path}/_versions"

    # -- versions --------------------------------------------------------------

    def _versions(self) -> list[int]:
        names = [n for n, _, _ in fs.files(self.spark, self._log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self._versions())

    def latest_version(self) -> int:
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no table at {self.path}")
        return versions[-1]

    def _load(self, version: int | None = None) -> Version:
        number = self.latest_version() if version is None else version
        return Version.from_json(fs.read_text(self.spark, f"{self._log}/{number:012d}.json"))

    def version_at(self, timestamp_ms: int) -> int:
        """Newest version committed at or before a point in time."""
        versions = self._versions()
        newer = bisect_right(versions, timestamp_ms, key=lambda v: self._load(v).timestamp_ms)
        if newer == 0:
            raise ValueError(f"{self.path} has no version as of {timestamp_ms}")
        return versions[newer - 1]

    def metrics(self, version: int | None = None) -> dict[str, int]:
        """What the writer of a version noted, for instance ``rows_written``."""
        return self._load(version).metrics

    def history(self, limit: int | None = None) -> DataFrame:
        """One row per version, newest first."""
        rows = self.spark.createDataFrame(
            [
                (v.version, v.timestamp_ms, v.operation, v.metrics)
                for v in map(self._load, self._versions())
            ],
            HISTORY_SCHEMA,
        )
        rows = rows.select(
            "version", F.timestamp_millis("timestamp_ms").alias("timestamp"), "operation", "metrics"
        ).orderBy(F.desc("version"))
        return rows if limit is None else rows.limit(limit)

    # -- reading ---------------------------------------------------------------

    def read(self, version: int | None = None, timestamp_ms: int | None = None) -> DataFrame:
        if version is None and timestamp_ms is not None:
            version = self.version_at(timestamp_ms)
        return self._frame(self._load(version))

    def _paths(self, v: Version, only: set[str] | None = None) -> list[str]:
        by_commit: dict[str, list[str]] = {}
        for part, commits in v.folders.items():
            if only is None or part in only:
                for commit in commits:
                    by_commit.setdefault(commit, []).append(part)
        paths = []
        for commit, parts in by_commit.items():
            # A commit that is live as a whole is named once, not folder by folder.
            if len(parts) == v.sizes.get(commit):
                paths.append(f"{self._data}/{commit}")
            else:
                paths.extend(f"{self._data}/{commit}/{part}" for part in parts)
        return paths

    def _frame(self, v: Version, only: set[str] | None = None) -> DataFrame:
        paths = self._paths(v, only)
        if not paths:
            return self.spark.createDataFrame([], v.schema)
        read_schema = T.StructType(list(v.schema) + [T.StructField("commit", T.StringType())])
        return (
            self.spark.read.schema(read_schema)
            .option("basePath", self._data)
            .parquet(*paths)
            .select(*v.schema.names)
        )

    # -- writing ---------------------------------------------------------------

    def _write(self, df: DataFrame, partition_by: list[str], spread: bool = True):
        """Write one commit folder; returns its name, partition folders and row count."""
        commit = f"commit={uuid.uuid4().hex}"
        seen = Observation()
        out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if partition_by and spread:
            # Few files per partition; adaptive execution splits a hot partition.
            out = out.hint("rebalance", *[F.col(c) for c in partition_by])
        writer = out.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        target = f"{self._data}/{commit}"
        writer.parquet(target)
        return commit, fs.folders(self.spark, target, len(partition_by)), self._observed(seen, target)

    def _observed(self, seen: Observation, target: str) -> int:
        try:
            return int(seen.get["rows"])
        except Py4JJavaError:
            # A plan found empty at run time reports no metrics; the footers tell.
            written = self.spark.read.schema("dummy INT").parquet(target)
            return written.count()

    def _commit(self, v: Version) -> int:
        fs.create_text(self.spark, f"{self._log}/{v.version:012d}.json", v.to_json())
        return v.version

    def _next(self, base: Version | None, operation, schema, partition_by, folders, metrics, sizes=None):
        used = {c for commits in folders.values() for c in commits}
        known = (base.sizes if base else {}) | (sizes or {})
        return Version(
            version=0 if base is None else base.version + 1,
            timestamp_ms=int(time.time() * 1000),
            operation=operation,
            schema=schema,
            partition_by=partition_by,
            folders=folders,
            metrics=metrics,
            sizes={c: n for c, n in known.items() if c in used},
        )

    def overwrite(
        self,
        df: DataFrame,
        partition_by: list[str] | None = None,
        operation: str = "OVERWRITE",
        spread: bool = True,
        metrics: dict[str, int] | None = None,
    ) -> int:
        """Replace everything, schema included. ``metrics`` are noted with the version."""
        base = self._load() if self.exists() else None
        parts = partition_by if partition_by is not None else (base.partition_by if base else [])
        commit, names, rows = self._write(df, parts, spread)
        folders = {n: [commit] for n in names}
        noted = {"rows_written": rows} | (metrics or {})
        return self._commit(
            self._next(base, operation, _nullable(df.schema), parts, folders, noted, {commit: len(names)})
        )

    def append(self, df: DataFrame, partition_by: list[str] | None = None, merge_schema: bool = False) -> int:
        """Add rows; ``merge_schema`` lets new columns in, older rows read them as null."""
        if not self.exists():
            return self.overwrite(df, partition_by, operation="CREATE")
        base = self._load()
        schema = self._evolved(base.schema, df.schema, merge_schema)
        commit, names, rows = self._write(self._aligned(df, schema), base.partition_by)
        folders = {k: list(v) for k, v in base.folders.items()}
        for name in names:
            folders.setdefault(name, []).append(commit)
        return self._commit(
            self._next(
                base, "APPEND", schema, base.partition_by, folders, {"rows_written": rows}, {commit: len(names)}
            )
        )

    def overwrite_partitions(self, df: DataFrame, partition_by: list[str], operation="OVERWRITE PARTITIONS") -> int:
        """Replace only the partitions that occur in ``df``."""
        if not self.exists():
            return self.overwrite(df, partition_by, operation="CREATE")
        base = self._load()
        commit, names, rows = self._write(self._aligned(df, base.schema), base.partition_by)
        folders = {k: v for k, v in base.folders.items() if k not in set(names)}
        folders.update({n: [commit] for n in names})
        metrics = {"rows_written": rows, "partitions_replaced": len(names)}
        return self._commit(
            self._next(
                base, operation, base.schema, base.partition_by, folders, metrics, {commit: len(names)}
            )
        )

    def replace_where(self, df: DataFrame, keep: Column, touched: Column, operation: str) -> int:
        """Rewrite the partitions selected by ``touched`` (a predicate on partition
        columns) as their rows that satisfy ``keep`` plus ``df``."""
        base = self._load()
        only = self._matching(base, touched)
        kept = self._frame(base, only).filter(keep)
        return self._rewrite(base, only, kept.unionByName(self._aligned(df, base.schema)), operation)

    def _listing(self, v: Version) -> DataFrame:
        """One row per partition folder with its typed partition values."""
        types = {f.name: f.dataType for f in v.schema}
        listing = self.spark.createDataFrame([(n,) for n in v.folders], "folder STRING")
        for i, name in enumerate(v.partition_by):
            raw = F.element_at(F.split("folder", "/"), i + 1)
            text = F.url_decode(F.regexp_replace(F.split(raw, "=", 2)[1], r"\+", "%2B"))
            text = F.nullif(text, F.lit("__HIVE_DEFAULT_PARTITION__"))
            listing = listing.withColumn(name, text.cast(types[name]))
        return listing

    def _matching(self, v: Version, predicate: Column | None) -> set[str]:
        """Partition folders whose values satisfy a predicate; all without one."""
        if predicate is None or not v.partition_by:
            return set(v.folders)
        return {r.folder for r in self._listing(v).filter(predicate).select("folder").collect()}

    def _touched(self, v: Version, df: DataFrame, keys: list[str], predicate: Column | None) -> set[str]:
        """Partition folders that may hold a match of ``df``. Where the partition
        columns belong to the key, these are the partitions that occur in ``df``."""
        if predicate is not None or not v.partition_by or not set(v.partition_by) <= set(keys):
            return self._matching(v, predicate)
        named = df.select(*v.partition_by).distinct().alias("d")
        same = null_safe_equal("l", "d", v.partition_by)
        found = self._listing(v).alias("l").join(named, same, "left_semi")
        return {r.folder for r in found.select("folder").collect()}

    def _rewrite(self, base: Version, only: set[str], df: DataFrame, operation: str) -> int:
        commit, names, rows = self._write(df, base.partition_by)
        folders = {k: v for k, v in base.folders.items() if k not in only}
        for name in names:
            folders[name] = folders.get(name, []) + [commit]
        metrics = {"rows_written": rows, "partitions_replaced": len(only)}
        return self._commit(
            self._next(
                base, operation, base.schema, base.partition_by, folders, metrics, {commit: len(names)}
            )
        )

    @staticmethod
    def _evolved(old: T.StructType, new: T.StructType, merge_schema: bool) -> T.StructType:
        extra = [f for f in new if f.name not in old.names]
        if extra and not merge_schema:
            raise ValueError(f"columns not in the table: {[f.name for f in extra]}")
        return _nullable(T.StructType(list(old) + extra))

    @staticmethod
    def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
        """Table columns in table order and type, absent ones as null."""
        return df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema
            ]
        )

    # -- merges ----------------------------------------------------------------

    def insert_new(
        self,
        df: DataFrame,
        keys: list[str],
        partition_by: list[str] | None = None,
        touched: Column | None = None,
        distinct: bool = False,
    ) -> int:
        """Insert-only merge: rows whose key is not there yet. ``touched`` is a
        predicate on partition columns that holds for every possible match;
        ``distinct`` says that no key occurs twice in ``df``, which saves a shuffle."""
        if not distinct:
            df = df.dropDuplicates(keys)
        if not self.exists():
            return self.overwrite(df, partition_by, operation="CREATE")
        base = self._load()
        target = self._frame(base, self._touched(base, df, keys, touched)).select(*keys)
        fresh = df.alias("s").join(target.alias("t"), null_safe_equal("s", "t", keys), "left_anti")
        return self.append(fresh)

    def upsert(
        self,
        df: DataFrame,
        keys: list[str],
        partition_by: list[str] | None = None,
        touched: Column | None = None,
    ) -> int:
        """Update-all / insert-all merge by copy-on-write.

        ``df`` must hold one row per key. Only partitions selected by ``touched``
        are read and rewritten. Without it these are the partitions that occur in
        ``df``, if the partition columns belong to the key, and else all of them.
        """
        if not self.exists():
            return self.overwrite(df, partition_by, operation="CREATE")
        base = self._load()
        only = self._touched(base, df, keys, touched)
        source = self._aligned(df, base.schema)
        survivors = (
            self._frame(base, only)
            .alias("t")
            .join(
                source.select(*keys).alias("s"),
                null_safe_equal("t", "s", keys),
                "left_anti",
            )
        )
        return self._rewrite(base, only, survivors.unionByName(source), "MERGE")

    def update_matching(self, df: DataFrame, keys: list[str], assign: dict[str, Column]) -> int:
        """Set the given columns on rows whose key occurs in ``df``."""
        base = self._load()
        marked = df.select(*keys).distinct().withColumn("_hit", F.lit(True))
        joined = self._frame(base).alias("t").join(
            marked.alias("s"), null_safe_equal("t", "s", keys), "left"
        )
        hit = F.col("s._hit").isNotNull()
        types = {f.name: f.dataType for f in base.schema}
        changed = joined.select(
            *[
                (
                    F.when(hit, assign[n].cast(types[n])).otherwise(F.col(f"t.{n}"))
                    if n in assign
                    else F.col(f"t.{n}")
                ).alias(n)
                for n in base.schema.names
            ]
        )
        return self._rewrite(base, set(base.folders), changed, "UPDATE")

    # -- maintenance -----------------------------------------------------------

    def restore(self, version: int) -> int:
        """Make an older version current; nothing is copied."""
        old, now = self._load(version), self._load()
        return self._commit(
            self._next(
                now,
                "RESTORE",
                old.schema,
                old.partition_by,
                old.folders,
                {"restored_version": version},
                old.sizes,
            )
        )

    def compact(
        self, order_by: list[str] | None = None, files: int | None = None, file_bytes: int = 256 << 20
    ) -> int:
        """Rewrite into few, clustered files; content stays the same.

        With ``order_by`` rows are range-partitioned on a Z-order value of those
        columns plus a hash, so a very frequent value still spreads over files. Unless
        ``files`` says how many, a file holds ``file_bytes`` or ``SORTED_ROWS`` rows.
        """
        base = self._load()
        df = self._frame(base)
        if order_by:
            spread = F.xxhash64(*base.schema.names)
            ranged = df.withColumn("_z", z_value(df, order_by)).withColumn("_spread", spread)
            keys = [F.col(c) for c in base.partition_by] + [F.col("_z"), F.col("_spread")]
            if files is None:
                size = sum(fs.size(self.spark, p) for p in self._paths(base))
                files = max(1, -(-size // file_bytes), -(-df.count() // SORTED_ROWS))
            df = ranged.repartitionByRange(files, *keys).sortWithinPartitions(*keys).drop("_z", "_spread")
        elif not base.partition_by:
            df = df.hint("rebalance")
        return self.overwrite(df, base.partition_by, operation="OPTIMIZE", spread=not order_by)

    def vacuum(self, retention_hours: float = 168, now_ms: int | None = None) -> list[str]:
        """Delete commit folders that no version within the retention uses.

        The current version and the folders of commits still being written
        (younger than the retention) are always kept.
        """
        now_ms = int(time.time() * 1000) if now_ms is None else now_ms
        limit = now_ms - int(retention_hours * 3_600_000)
        versions = [self._load(v) for v in self._versions()]
        kept = [v for v in versions if v.timestamp_ms >= limit]
        # The version that was current when the retention began is readable too.
        older = [v for v in versions if v.timestamp_ms < limit]
        kept += older[-1:]
        live = {c for v in kept for commits in v.folders.values() for c in commits}
        known = {c for v in versions for commits in v.folders.values() for c in commits}
        removed = []
        for name in fs.folders(self.spark, self._data, 1):
            if name in live:
                continue
            if name not in known and fs.modified(self.spark, f"{self._data}/{name}") >= limit:
                continue
            fs.delete_folder(self.spark, f"{self._data}/{name}")
            removed.append(name)
        return removed
