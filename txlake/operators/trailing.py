"""Count and sum over the trailing seconds before each row of a key.

A window partitioned by key alone would put a hot key into one task. Rows are
therefore grouped by key and time block; rows near the end of a block are copied
into the next one as context and dropped again afterwards. With blocks much
longer than the trailing span few rows are copied.

A key with very many rows in one block goes another way. Its rows are grouped by
panes, of which many make up a span: what lies between a row's own pane and the one
its span begins in is a sum of panes, and only in those two are rows put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from txlake.functions.money import as_double, money
from txlake.functions.times import floor_to, micros
from txlake.session import scratch

SECOND = 1_000_000

# Rows of a key in one block from which it is worked off by panes, and panes of a span
# (a power of two up to 64 divides any number of seconds into whole microseconds).
HOT_ROWS = 1_000_000
PANES = 64


def trailing_totals(
    df: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    amount: str,
    span: int,
    block: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Adds ``trailing_count`` and ``trailing_total``: the row itself and the rows
    of its key up to ``span`` seconds (inclusive) before it, in (ts, row_id) order.

    Rows with equal time count in row_id order, so a later peer is not seen by an earlier
    one. Keys with more than ``hot_rows`` rows in a block are counted first and worked off
    by panes; without ``hot_rows`` nothing is counted and all go by blocks.
    """
    width = (block or 10 * span) * SECOND
    if width < span * SECOND:
        raise ValueError("a block must not be shorter than the trailing span")
    hot = None if hot_rows is None else _hot_keys(df, key, ts, width, hot_rows)
    if hot is None:
        return _by_blocks(df, key, ts, row_id, amount, span, width)
    usual = _by_blocks(df.join(hot, key, "left_anti"), key, ts, row_id, amount, span, width)
    dense = _by_panes(df.join(hot, key, "left_semi"), key, ts, row_id, amount, span)
    return usual.unionByName(dense.select(*usual.columns))


def _hot_keys(df: DataFrame, key: str, ts: str, width: int, hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows in one block; none if there is no such key."""
    block = floor_to(micros(F.col(ts)), width).alias("_block")
    counted = df.filter(F.col(key).isNotNull()).groupBy(key, block).agg(F.count(F.lit(1)).alias("_n"))
    keys = counted.filter(F.col("_n") > hot_rows).select(key).distinct()
    path = scratch(df.sparkSession, "hot-keys")
    keys.write.parquet(path)
    found = df.sparkSession.read.schema(keys.schema).parquet(path)
    return None if found.isEmpty() else found


def _by_blocks(df: DataFrame, key: str, ts: str, row_id: str, amount: str, span: int, width: int) -> DataFrame:
    """Both totals as differences of two running ones (everything up to this row minus
    everything older than the span), which costs one step per row; a frame that slides
    on both ends would be evaluated anew for each row."""
    home = floor_to(F.col("_at"), width)
    near_end = F.col("_at") >= home + (width - span * SECOND)
    blocks = F.when(near_end, F.array(home, home + width)).otherwise(F.array(home))
    value = F.coalesce(money(amount), F.lit(0))

    placed = (
        df.withColumns({"_at": micros(F.col(ts)), "_value": value})
        .withColumn("_block", F.explode(blocks))
    )
    in_block = Window.partitionBy(key, "_block")
    so_far = in_block.orderBy("_at", row_id).rowsBetween(Window.unboundedPreceding, 0)
    expired = in_block.orderBy("_at").rangeBetween(
        Window.unboundedPreceding, -(span * SECOND) - 1
    )
    count = F.count(F.lit(1)).over(so_far) - F.count(F.lit(1)).over(expired)
    total = F.sum("_value").over(so_far) - F.coalesce(F.sum("_value").over(expired), F.lit(0))
    return (
        placed.withColumns({"trailing_count": count, "trailing_total": as_double(total)})
        .filter(F.col("_block") == home)
        .drop("_at", "_value", "_block")
    )


def _by_panes(df: DataFrame, key: str, ts: str, row_id: str, amount: str, span: int) -> DataFrame:
    """The same totals for dense keys: own pane up to the row, plus the panes of the span before
    it, less what is older than the span in the first of these.

    No task puts more rows in order than one key has in one pane.
    """
    width = span * SECOND // PANES
    rows = df.withColumns(
        {"_at": micros(F.col(ts)), "_value": F.coalesce(money(amount), F.lit(0))}
    ).withColumn("_pane", F.floor(F.col("_at") / width))
    so_far = Window.partitionBy(key, "_pane").orderBy("_at", row_id).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumns({"_own_n": F.count(F.lit(1)).over(so_far), "_own": F.sum("_value").over(so_far)})

    # Sums of the panes of one span before each pane, in blocks of panes with the last span as context.
    block = 10 * PANES
    panes = rows.groupBy(key, "_pane").agg(F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_sum"))
    home = F.floor(F.col("_pane") / block)
    near_end = F.pmod(F.col("_pane"), F.lit(block)) >= block - PANES
    panes = panes.withColumn("_block", F.explode(F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))))
    earlier = Window.partitionBy(key, "_block").orderBy("_pane").rangeBetween(-PANES, -1)
    before = (
        panes.withColumns({"_before_n": F.sum("_n").over(earlier), "_before": F.sum("_sum").over(earlier)})
        .filter(F.col("_block") == home)
        .select(key, "_pane", "_before_n", "_before")
    )

    # Where the span of a row begins: all that is older in that pane has expired.
    edge = F.col("_at") - span * SECOND
    edges = rows.select(key, edge.alias("_at")).distinct().withColumn("_pane", F.floor(F.col("_at") / width))
    none = F.lit(0).cast(rows.schema["_value"].dataType)
    both = rows.select(key, "_pane", "_at", "_value", F.lit(1).alias("_row")).unionByName(
        edges.withColumns({"_value": none, "_row": F.lit(0)})
    )
    older = Window.partitionBy(key, "_pane").orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0)
    expired = (
        both.withColumns({"_gone_n": F.sum("_row").over(older), "_gone": F.sum("_value").over(older)})
        .filter("_row = 0")
        .select(key, F.col("_at").alias("_edge"), "_gone_n", "_gone")
    )
    joined = own.withColumn("_edge", edge).join(before, [key, "_pane"]).join(expired, [key, "_edge"])
    zero = F.lit(0)
    count = F.col("_own_n") + F.coalesce("_before_n", zero) - F.col("_gone_n")
    total = F.col("_own") + F.coalesce("_before", none) - F.col("_gone")
    return joined.select(*df.columns, count.alias("trailing_count"), as_double(total).alias("trailing_total"))
