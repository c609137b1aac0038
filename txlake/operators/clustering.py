"""Z-order value for clustering files by several columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 6


def _bucket(c: Column, bounds: list) -> Column:
    """How many of the ascending bounds lie at or below the value, found by halving."""

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(c < bounds[middle], pick(low, middle)).otherwise(pick(middle + 1, high))

    return F.when(c.isNull(), 0).otherwise(pick(0, len(bounds)))


def z_value(df: DataFrame, columns: list[str]) -> Column:
    """Interleaved bits of the columns' quantile buckets.

    Quantiles (one approximate pass, a fixed number of values per column) rather
    than minimum and maximum: outliers do not squeeze all rows into one bucket.
    Text is ranked by its first six bytes; that only steers the clustering,
    the rows stay whole.
    """
    numeric = {c: _numeric(df, c) for c in columns}
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    row = df.agg(*[F.percentile_approx(numeric[c], shares, 1000).alias(c) for c in columns]).first()
    parts = []
    for at, c in enumerate(columns):
        bounds = sorted(set(row[c] or []))
        bucket = _bucket(numeric[c], bounds).cast("bigint")
        for bit in range(BITS):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("bigint"))
            parts.append(F.shiftleft(one, bit * len(columns) + at))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _numeric(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")
