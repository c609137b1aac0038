"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.session import scratch

# Spark removes the shuffle files of a finished write when this is on, so that the
# disk in use is that of the largest step and not the sum of all steps.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

PARQUET_CODEC = "spark.sql.parquet.compression.codec"

# Rows per Arrow batch: bounds what a Python worker holds of the texts at once.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS_VALUE = "1000"

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tune(spark: SparkSession) -> SparkSession:
    """Session settings for the operators of this package."""
    spark.conf.set(ARROW_ROWS, ARROW_ROWS_VALUE)
    return spark


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder, or to ``path``, and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def compressed(spark: SparkSession, codec: str = "zstd") -> Iterator[None]:
    """Parquet files written meanwhile are compressed so; tighter than by default."""
    before = spark.conf.get(PARQUET_CODEC, None)
    spark.conf.set(PARQUET_CODEC, codec)
    try:
        yield
    finally:
        spark.conf.unset(PARQUET_CODEC) if before is None else spark.conf.set(PARQUET_CODEC, before)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Pure ASCII takes the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    """Number of words between ASCII blanks; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the table doesn't have, made from the given ones."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_identity(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """128 bits that name a row by id and text; equal only for repeated rows."""
    return (
        F.xxhash64(doc_id, text),
        F.xxhash64(F.lit(7), text, F.coalesce(doc_id.cast("string"), F.lit("null"))),
    )


def numbered(df: DataFrame, by: Iterable[str], name: str) -> DataFrame:
    """Number all rows from 0 without gaps in the order of the columns.

    Rows are dealt out by range and numbered where they lie; the numbers of earlier
    partitions are added from a table with one row per partition. No task holds more
    than its range. Ties fall in any order.
    """
    place, (number,) = "__place", fresh(df, name)
    order = [F.col(c).asc_nulls_first() for c in by]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = staged(placed.withColumn(place, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(place), 33)
    counts = table.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    # One row per partition of the shuffle: some ten thousand at most.
    rows = sorted((r["__part"], r["__rows"]) for r in counts.collect())
    starts, total = [], 0
    for key, count in rows:
        starts.append((key, total))
        total += count
    kind = T.StructType([T.StructField("__part", T.LongType()), T.StructField("__start", T.LongType())])
    offsets = df.sparkSession.createDataFrame(starts, kind)
    inside = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        table.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(number, F.col("__start") + inside)
        .drop("__part", "__start", place)
    )
