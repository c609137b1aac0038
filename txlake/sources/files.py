"""File sources: landed topics, watched CSV folders, API responses, JSON lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table ``<folder>/<name>.parquet`` (a file or a folder of files)."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream; files that arrive later are picked up."""
    schema = table(spark, folder, name).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A stream cannot start from the path of one file, but from a pattern that
    # matches it; the same pattern also matches a folder of that name.
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parque[t]")


def topic_files(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """A topic landed as Parquet files with the Kafka column contract."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schemas.TOPIC_ROW).parquet(path)


def settlement_csv(
    spark: SparkSession,
    folder: str,
    streaming: bool = False,
    archive: str | None = None,
    pattern: str = "settlement_*.csv",
) -> DataFrame:
    """Settlement files of a watched folder, all columns as text.

    As a stream every file is read once; with ``archive`` it is moved there
    after its batch has been committed. Files should be moved into the folder
    when they are complete. The file name stays with each row.
    """
    reader = (spark.readStream if streaming else spark.read).schema(schemas.SETTLEMENT_CSV)
    reader = reader.option("header", "true").option("pathGlobFilter", pattern)
    if streaming and archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(folder).withColumn("filename", F.col("_metadata.file_name"))


def api_payments(
    spark: SparkSession, path: str, streaming: bool = False, one_per_file: bool = False
) -> DataFrame:
    """One row per element of the ``data`` array of landed API responses.

    Responses are JSON lines, or one document per file (``one_per_file``).
    """
    reader = (spark.readStream if streaming else spark.read).schema(schemas.API_ENVELOPE)
    return (
        reader.option("multiLine", one_per_file)
        .json(path)
        .select("fetched_at", F.explode("data").alias("event"))
        .select("event.*", "fetched_at")
    )


def json_lines_bronze(
    spark: SparkSession, path: str, topic: str, ingest_date: dt.date | str, ingest_time: Column
) -> DataFrame:
    """JSON lines dressed as bronze rows, with an identity that survives a re-run.

    A line is identified by its file, its text and its number among the equal
    lines of that file: ``kafka_key`` holds file and number, ``kafka_offset`` a
    hash of all three. Hashes may collide in a very large load, so merges of
    file-based bronze rows use ``FILE_BRONZE_KEYS``.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    counted = lines.groupBy("file", "value").agg(F.count(F.lit(1)).alias("copies"))
    numbered = _number_copies(counted, ["file", "value"])
    day = F.lit(str(ingest_date)).cast("date")
    return numbered.select(
        F.concat_ws("#", "file", "copy").alias("kafka_key"),
        F.col("value").alias("kafka_value"),
        F.lit(topic).alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.xxhash64("file", "value", "copy").alias("kafka_offset"),
        ingest_time.alias("kafka_timestamp"),
        day.alias("ingest_date"),
        ingest_time.alias("ingest_timestamp"),
    )


FILE_BRONZE_KEYS = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_key", "kafka_value"]

COPIES_PER_TASK_ROW = 10_000


def _number_copies(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Turn ``copies`` = n into n rows numbered 0..n-1.

    A line that makes up much of the input would unfold in one task, so counts are
    first cut into ranges, which are spread before they unfold.
    """
    size = F.lit(COPIES_PER_TASK_ROW).cast("bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, size)
    ranges = counted.withColumn("start", F.explode(starts)).repartition("start", *keys)
    last = F.least(F.col("start") + size, F.col("copies")) - 1
    return ranges.select(*keys, F.explode(F.sequence(F.col("start"), last)).alias("copy"))


def decode_json(df: DataFrame, value: Column, schema: T.StructType, into: str = "data") -> DataFrame:
    """Bytes or text -> typed struct; unknown properties are ignored.

    ``_corrupt`` holds the text of documents that do not fit the schema, so the
    caller can route them; a null value (tombstone) gives a null struct. Select
    the fields of ``schema`` from the struct: it also carries the reject text, so
    that a document is parsed once.
    """
    with_reject = T.StructType(list(schema) + [T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(
        value.cast("string"),
        with_reject,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return df.withColumn(into, parsed).withColumn("_corrupt", F.col(f"{into}._corrupt_record"))
