"""Comparing two tables or two versions of one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.session import scratch


def key_counts(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key on either side: one grouping of both tables, no join."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = source.select(*keys, one.alias("_s"), none.alias("_t")).unionByName(
        target.select(*keys, none.alias("_s"), one.alias("_t"))
    )
    return both.groupBy(*keys).agg(F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"))


def key_difference(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, with ``side`` = missing (in the target) or extra."""
    counts = key_counts(source, target, keys)
    missing, extra = F.col("target_rows") == 0, F.col("source_rows") == 0
    return counts.filter(missing | extra).select(
        *keys, F.when(missing, "missing").otherwise("extra").alias("side")
    )


def reconcile(source: DataFrame, target: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row: counts on both sides, missing and extra keys, overall verdict."""
    s, t = F.col("source_rows"), F.col("target_rows")
    row = key_counts(source, target, keys).agg(
        F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias("source_count"),
        F.coalesce(F.sum(t), F.lit(0)).cast("bigint").alias("target_count"),
        F.count_if((s > 0) & (t == 0)).alias("missing_keys"),
        F.count_if((s == 0) & (t > 0)).alias("extra_keys"),
    )
    same = F.col("source_count") == F.col("target_count")
    good = same & (F.col("missing_keys") == 0) & (F.col("extra_keys") == 0)
    return row.select(
        F.lit(name).alias("table_name"), "*", F.when(good, "PASS").otherwise("FAIL").alias("verdict")
    )


def checksum(df: DataFrame, columns: list[Column], method: str = "xxhash64") -> DataFrame:
    """Row count and sum of row hashes; independent of row order.

    ``md5`` gives values that other systems can reproduce from the same text
    rendering: both halves of md5 over the values, each with its length in front and
    ``~`` for null, joined by ``|``, summed as numbers.
    """
    count = F.count(F.lit(1)).alias("row_count")
    total = lambda c: F.coalesce(F.sum(c.cast("decimal(28,0)")), F.lit(0)).cast("string")
    if method != "md5":
        return df.agg(count, total(F.xxhash64(*columns)).alias("checksum"))

    def shown(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))

    hashed = df.select(F.md5(F.concat_ws("|", *[shown(c) for c in columns])).alias("_m"))
    half = lambda start: F.conv(F.substring("_m", start, 16), 16, 10)
    return hashed.agg(count, F.concat(total(half(1)), F.lit(":"), total(half(17))).alias("checksum"))


def sample_difference(
    source: DataFrame, target: DataFrame, keys: list[str], one_in: int = 100
) -> DataFrame:
    """Rows that differ within a sample of keys chosen by hash on both sides alike.

    The sampling operator of the migration check; ``one_in=1`` compares everything.
    """
    chosen = F.pmod(F.xxhash64(*keys), F.lit(one_in)) == 0
    s, t = source.filter(chosen), target.filter(chosen).select(*source.columns)
    return (
        s.exceptAll(t)
        .withColumn("side", F.lit("source"))
        .unionByName(t.exceptAll(s).withColumn("side", F.lit("target")))
    )


def row_difference(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Added, removed and changed keys between two versions."""
    rest = [c for c in old.columns if c not in keys and c in new.columns]
    o = old.select(*keys, F.struct(F.lit(1).alias("_there"), *rest).alias("_row")).alias("o")
    n = new.select(*keys, F.struct(F.lit(1).alias("_there"), *rest).alias("_row")).alias("n")
    pair = None
    for k in keys:
        one = F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        pair = one if pair is None else pair & one
    before, after = F.col("o._row"), F.col("n._row")
    change = (
        F.when(before.isNull(), "added")
        .when(after.isNull(), "removed")
        .when(~before.eqNullSafe(after), "changed")
    )
    joined = o.join(n, pair, "full_outer")
    return joined.select(
        *[F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys],
        change.alias("change"),
    ).filter(F.col("change").isNotNull())


def version_summary(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of two versions and of the rows between them, one row."""
    changes = row_difference(old, new, keys).select("change")
    rows = changes.unionByName(old.select(F.lit("old").alias("change")))
    rows = rows.unionByName(new.select(F.lit("new").alias("change")))
    names = {"added": "added", "removed": "removed", "changed": "changed", "old": "old_count", "new": "new_count"}
    counts = rows.agg(*[F.count_if(F.col("change") == k).alias(v) for k, v in names.items()])
    return counts.withColumn("delta", F.col("new_count") - F.col("old_count"))


# Keys in one leaf of a checksum tree, and children of one node.
LEAF_KEYS = 1024
FANOUT = 32

# Ranges up to this number become filters that reach the scan; more of them are joined.
MOST_INTERVALS = 500


def write_checksum_tree(
    df: DataFrame, key: str, path: str, leaf: int = LEAF_KEYS, fanout: int = FANOUT
) -> int:
    """Row counts and checksums of all ranges of a whole-number key, level by level; returns the top level.

    Level 0 has one row per ``leaf`` keys, each further level one per ``fanout`` ranges of
    the level below. Written once per version of a table, so that comparing two versions
    reads no rows but where they differ. Null keys make up a range of their own.
    """
    spark = df.sparkSession
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
    sums = df.groupBy(F.floor(F.col(key) / leaf).alias("range")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(row).alias("checksum")
    )
    level = 0
    while True:
        target = f"{path}/level={level}"
        sums.repartitionByRange(F.col("range").asc_nulls_first()).sortWithinPartitions("range").write.mode("overwrite").parquet(target)
        below = spark.read.parquet(target)
        low, high = below.agg(F.min("range"), F.max("range")).first()
        if low is None or high - low < fanout:
            return level
        level += 1
        sums = below.groupBy(F.floor(F.col("range") / fanout).alias("range")).agg(
            F.sum("row_count").alias("row_count"), F.sum("checksum").alias("checksum")
        )


def differing_ranges(spark, old: str, new: str, top: int, fanout: int = FANOUT) -> DataFrame:
    """Ranges of level 0 in which two checksum trees differ.

    From level ``top`` on down, only the children of differing ranges are read. Both
    trees must have that level (the lower one of their tops).
    """
    schema = "range BIGINT, row_count BIGINT, checksum DECIMAL(38,0)"
    names = ["range", "row_count", "checksum"]
    found = None
    for level in range(top, -1, -1):
        sides = []
        for path in (old, new):
            rows = spark.read.schema(schema).parquet(f"{path}/level={level}")
            if found is not None:
                low, high = found.agg(F.min("range"), F.max("range")).first()
                if low is not None:
                    inside = F.col("range").between(low * fanout, high * fanout + fanout - 1)
                    rows = rows.filter(inside | F.col("range").isNull())
                parents = found.select(F.col("range").alias("_parent"))
                rows = rows.join(parents, F.floor(F.col("range") / fanout).eqNullSafe(F.col("_parent")), "left_semi")
            sides.append(rows.select(*names))
        one = F.lit(1)
        both = sides[0].withColumn("_side", one).unionByName(sides[1].withColumn("_side", -one))
        # Equal rows of the two sides cancel out.
        odd = both.groupBy(*names).agg(F.sum("_side").alias("_n")).filter("_n <> 0")
        path = scratch(spark, "ranges")
        odd.select("range").distinct().write.parquet(path)
        found = spark.read.schema("range BIGINT").parquet(path)
        if found.isEmpty():
            break
    return found


def rows_in_ranges(df: DataFrame, key: str, ranges: DataFrame, leaf: int = LEAF_KEYS) -> DataFrame:
    """Rows whose key lies in one of the ranges of level 0.

    Up to ``MOST_INTERVALS`` ranges (neighbours count as one) are filters that the scan can
    use to skip; more are joined, behind a filter on their bounds. Both give the same rows.
    """
    known = ranges.limit(MOST_INTERVALS + 1).collect()
    place = F.floor(F.col(key) / leaf)
    if len(known) <= MOST_INTERVALS:
        numbers = sorted(r["range"] for r in known if r["range"] is not None)
        runs: list[list[int]] = []
        for n in numbers:
            if runs and runs[-1][1] == n - 1:
                runs[-1][1] = n
            else:
                runs.append([n, n])
        wanted = F.col(key).isNull() if any(r["range"] is None for r in known) else F.lit(False)
        for a, b in runs:
            wanted = wanted | F.col(key).between(a * leaf, b * leaf + leaf - 1)
        return df.filter(wanted)
    low, high = ranges.agg(F.min("range"), F.max("range")).first()
    near = df.filter(F.col(key).between(low * leaf, high * leaf + leaf - 1) | F.col(key).isNull())
    return near.join(ranges.select(F.col("range").alias("_range")), place.eqNullSafe(F.col("_range")), "left_semi")


def differing_rows(
    source: DataFrame, target: DataFrame, key: str, source_tree: str, target_tree: str, top: int
) -> DataFrame:
    """Rows that only one side has, read from the ranges in which the trees differ."""
    ranges = differing_ranges(source.sparkSession, source_tree, target_tree, top)
    s = rows_in_ranges(source, key, ranges)
    t = rows_in_ranges(target.select(*source.columns), key, ranges)
    return (
        s.exceptAll(t)
        .withColumn("side", F.lit("source"))
        .unionByName(t.exceptAll(s).withColumn("side", F.lit("target")))
    )
