"""Relational sources.

``full_scan`` splits on a numeric key, ``changed_since`` pushes a high-water
mark into the database. Both only declare a DataFrame; rows move on executors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def bounds_query(table: str, column: str) -> str:
    return f"(SELECT MIN({column}) AS min_val, MAX({column}) AS max_val FROM {table}) t"


def literal(value) -> str:
    """SQL literal for a watermark; text is quoted, quotes inside it doubled."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"not usable as a watermark: {value!r}")
    if isinstance(value, (int, float)):
        return str(value)
    if isinstance(value, dt.datetime):
        return "'" + value.strftime("%Y-%m-%d %H:%M:%S.%f") + "'"
    return "'" + str(value).replace("'", "''") + "'"


def since_query(table: str, column: str, last, inclusive: bool = False) -> str:
    """Rows beyond a mark; ``inclusive`` takes those at the mark as well."""
    return f"(SELECT * FROM {table} WHERE {column} {'>=' if inclusive else '>'} {literal(last)}) t"


def full_scan(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    column: str | None = None,
    partitions: int = 4,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Whole table, in ``partitions`` key ranges when a numeric column is named."""
    properties = {"fetchsize": str(fetch_size)} | properties
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    low, high = spark.read.jdbc(url, bounds_query(table, column), properties=properties).first()
    if low is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=int(low),
        upperBound=int(high) + 1,
        numPartitions=partitions,
        properties=properties,
    )


def changed_since(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str, last, inclusive: bool = False
) -> DataFrame:
    """Rows whose ``column`` is beyond the high-water mark; ``inclusive`` for ``migration.Cursor``."""
    return spark.read.jdbc(url, since_query(table, column, last, inclusive), properties=properties)
