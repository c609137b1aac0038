"""Keyed tables of which a change rewrites only what it touches.

The table is a Parquet folder partitioned by a hash of the key. A change reads and
rewrites the buckets of its own keys, by a dynamic overwrite; the files of all other
buckets stay as they are. The new rows are written aside first, so a run that fails
before the overwrite leaves the table as it was, and one that fails during it is mended by
running the same change again. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.operators.cdc import apply_changes
from txlake.session import scratch
from txlake.sources import fs

BUCKET = "key_bucket"


class BucketTable:
    """A table with one row per key in ``buckets`` folders.

    The number of buckets is part of the table: a bucket should fit one task well, so it
    grows with the table that is planned for.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def exists(self) -> bool:
        return fs.exists(self.spark, self.path) and bool(fs.folders(self.spark, self.path, 1))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def create(self, df: DataFrame) -> None:
        """Write the table whole; ``df`` has one row per key."""
        self._write(df.withColumn(BUCKET, self._bucket()), "overwrite")

    def _write(self, placed: DataFrame, mode: str) -> None:
        # Files of a bucket come from few tasks; large buckets are split among several.
        spread = placed.hint("rebalance", BUCKET)
        spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the keys of some rows: at most as many as the table has."""
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())

    def part(self, numbers: list[int]) -> DataFrame:
        """The rows of some buckets; the others are not read."""
        return self._stored().filter(F.col(BUCKET).isin(numbers)).drop(BUCKET)

    def replace(self, numbers: list[int], rows: DataFrame) -> None:
        """Put ``rows`` in place of some buckets. ``rows`` may be made from those buckets."""
        path = scratch(self.spark, "buckets")
        rows.withColumn(BUCKET, self._bucket()).write.parquet(path)
        ready = self.spark.read.schema(rows.withColumn(BUCKET, self._bucket()).schema).parquet(path)
        filled = {r[0] for r in ready.select(BUCKET).distinct().collect()}
        if not filled <= set(numbers):
            raise ValueError(f"rows of other buckets: {sorted(filled - set(numbers))}")
        if filled:
            self._write(ready, "overwrite")
        for n in set(numbers) - filled:
            fs.delete_folder(self.spark, f"{self.path}/{BUCKET}={n}")
        fs.delete_folder(self.spark, path)

    def upsert(self, rows: DataFrame) -> int:
        """Replace or add rows by key (one row per key); returns the number of buckets rewritten."""
        if not self.exists():
            self.create(rows)
            return self.buckets
        numbers = self.touched(rows)
        if numbers:
            kept = self._without(self.part(numbers), rows)
            self.replace(numbers, kept.unionByName(rows))
        return len(numbers)

    def _without(self, current: DataFrame, rows: DataFrame) -> DataFrame:
        keys = rows.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(self.keys)])
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
        return current.join(keys, same, "left_anti")

    def update_matching(self, rows: DataFrame, values: dict[str, Column]) -> int:
        """Set columns of the rows whose keys are among ``rows``; returns the number of buckets rewritten.

        Keys that the table doesn't hold touch nothing.
        """
        marked = rows.select(*self.keys).distinct()
        held = self._matching(self.part(self.touched(marked)), marked)
        numbers = self.touched(held)
        if numbers:
            current = self.part(numbers)
            changed = self._matching(current, marked).withColumns(values)
            self.replace(numbers, self._without(current, marked).unionByName(changed))
        return len(numbers)

    def _matching(self, current: DataFrame, rows: DataFrame) -> DataFrame:
        keys = rows.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(self.keys)])
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
        return current.join(keys, same, "left_semi")

    def apply(
        self,
        changes: DataFrame,
        order: list[str],
        applied_at: Column,
        hard_delete: bool = False,
        extras: tuple[str, ...] = (),
    ) -> int:
        """Apply a batch of a change feed, last change wins; returns the number of buckets rewritten."""
        if not self.exists():
            self.create(apply_changes(None, changes, self.keys, order, applied_at, hard_delete, extras))
            return self.buckets
        numbers = self.touched(changes)
        if numbers:
            current = self.part(numbers)
            self.replace(numbers, apply_changes(current, changes, self.keys, order, applied_at, hard_delete, extras))
        return len(numbers)


class ApplyToBuckets:
    """Batch handler: a change feed into a ``BucketTable``. A replayed batch gives the same rows."""

    def __init__(self, table: BucketTable, order: list[str], applied_at: Column | None = None, extras: tuple[str, ...] = ()):
        self.table, self.order, self.applied_at, self.extras = table, order, applied_at, extras

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        at = F.current_timestamp() if self.applied_at is None else self.applied_at
        # The micro-batch is read once, into a folder of its own.
        spark = batch.sparkSession
        path = scratch(spark, f"changes-{batch_id}")
        batch.write.parquet(path)
        self.table.apply(spark.read.schema(batch.schema).parquet(path), self.order, at, extras=self.extras)
        fs.delete_folder(spark, path)
