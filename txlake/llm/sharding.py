"""K-d tree partitioning of documents into shards of near equal bytes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import fresh, numbered, staged

SHARDS = 16

# A coordinate is 24 bits of the metadata value and 38 bits of the group's hash, which
# cuts through ties.
VALUE_BITS, TIE_BITS = 24, 38
STEP_BITS = 16

# Groups of equal texts above this part of a shard are dealt out in pieces ...
TORN_FROM = 1 / 8
# ... of this part of a shard. A cut is exact enough when no more than this lies in its last bin.
PIECE = 1 / 256
# The table of torn groups is broadcast up to so many shards, each of which has room for 8.
BROADCAST_LEAVES = 1 << 14

# Metadata dimensions, each scaled to [0, 1): size on a logarithmic scale, language, source.
DIMENSIONS = ("d_size", "d_lang", "d_source")


def _points(rows: DataFrame) -> DataFrame:
    """One weighted point per group of equal texts (and piece of a heavy group)."""
    return rows.groupBy("size", "text_crc32", "mark", "piece").agg(
        F.sum("size").alias("weight"),
        F.min("size_value").alias("d_size"),
        F.min("lang_value").alias("d_lang"),
        F.min("source_value").alias("d_source"),
    )


def _crossings(points: DataFrame, keys: list[str], shift: int, goals) -> DataFrame:
    """The first bin of each histogram at which its sum reaches the goal, with its bounds.

    ``points`` has ``at``, a place below 2^(shift + STEP_BITS); bins are its upper bits.
    """
    bins = points.groupBy(*keys, F.shiftright("at", shift).alias("bin")).agg(F.sum("weight").alias("weight"))
    whole, up_to = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("bin")
    return (
        bins.withColumn("sum", F.sum("weight").over(up_to))
        .withColumn("all", F.sum("weight").over(whole))
        .withColumn("lowest", F.min("bin").over(whole))
        .withColumn("highest", F.max("bin").over(whole))
        .filter(F.col("sum") >= goals)
        .withColumn("rank", F.row_number().over(up_to))
        .filter("rank = 1")
    )


def _cuts(points: DataFrame, limit: float) -> DataFrame:
    """For each open node its widest dimension and the coordinate where its weight divides.

    A node with n leaves divides at the fraction (n // 2) / n of its weight. Histograms of
    65,536 bins, of all nodes and dimensions at once, give the widths and the bin with the
    weighted quantile; where that bin is still heavy, a histogram of the bin follows.
    Result: (node, dim, at), one row per open node.
    """
    here = points.filter("leaves > 1")
    shift = VALUE_BITS + TIE_BITS - STEP_BITS
    each = here.withColumn("dim", F.explode(F.array(*[F.lit(d) for d in range(len(DIMENSIONS))])))
    each = each.withColumn("at", coordinate(F.col("dim")))
    goal = F.col("all") * F.floor(F.col("leaves") / 2) / F.col("leaves")
    row = F.struct(
        "dim",
        F.shiftleft("bin", shift).alias("low"),
        (F.col("sum") - F.col("weight")).alias("before"),
        "weight",
        goal.cast("double").alias("goal"),
        F.lit(shift).alias("shift"),
    )
    width = F.struct(F.col("highest") - F.col("lowest"), -F.col("dim"))
    crossings = _crossings(each, ["node", "leaves", "dim"], shift, goal)
    found = staged(crossings.groupBy("node").agg(F.max_by(row, width).alias("c")).select("node", "c.*"), "cuts")
    while shift > 0:
        heavy = found.filter(F.col("weight") > F.lit(limit)).filter(F.col("shift") == shift)
        if heavy.isEmpty():
            break
        span, step = 1 << shift, min(STEP_BITS, shift)
        shift -= step
        open_ = heavy.drop("weight", "shift")
        inside = here.join(open_, "node").withColumn("at", coordinate(F.col("dim")) - F.col("low"))
        inside = inside.filter(F.col("at").between(0, span - 1))
        closer = _crossings(inside, open_.columns, shift, F.col("goal") - F.col("before")).select(
            "node",
            "dim",
            (F.col("low") + F.shiftleft("bin", shift)).alias("low"),
            (F.col("before") + F.col("sum") - F.col("weight")).alias("before"),
            "weight",
            "goal",
            F.lit(shift).alias("shift"),
        )
        found = staged(found.join(heavy.select("node"), "node", "left_anti").unionByName(closer), "cuts")
    # Cut on the nearer side of the bin.
    beyond = F.col("goal") - F.col("before") > F.col("weight") / 2
    bin_width = F.pow(F.lit(2.0), F.col("shift")).cast("long")
    return found.select("node", "dim", F.when(beyond, F.col("low") + bin_width).otherwise(F.col("low")).alias("at"))


def coordinate(dimension):
    """Position of a point along a dimension (a column with its number)."""
    values = F.array(*[(F.col(d) * F.lit(float((1 << VALUE_BITS) - 1))).cast("long") for d in DIMENSIONS])
    value = F.element_at(values, dimension + 1)
    tie = F.shiftrightunsigned(F.xxhash64("mark", "text_crc32", "size", "piece"), 64 - TIE_BITS)
    return F.shiftleft(value, TIE_BITS) + tie


def shards(
    docs: DataFrame,
    count: int | None = SHARDS,
    target_bytes: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """Shard and slot of each document.

    A k-d tree over the metadata (size, language, source) halves the bytes at weighted
    medians along the widest dimension, until ``count`` leaves are reached, or enough
    leaves of ``target_bytes``. Equal texts are one point of the tree and stay together;
    only groups heavier than 1/8 of a shard are dealt out, in pieces of 1/256. The widths are
    those of the values within [0, 1); ties along a dimension are cut by hash. Cuts are
    rows of a table, one per node, so that the plan doesn't grow with the leaves.

    Columns: all that identify the row (``doc_id``, ``size``, ``text_crc32``), then
    ``shard`` and ``slot`` (from 0 without gaps). Null texts are empty: size 1; a very long
    text is one point, and makes its shard that much larger. Null language, source or id
    are values of their own. Repeated rows keep their own slots. Further columns are not
    read, whatever their names.
    An empty table gives no rows; shards may be empty when there are few documents.
    """
    words = F.coalesce(F.col(text), F.lit(""))
    unit = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")) / F.lit(float(1 << 32))
    size = F.octet_length(words).cast("long") + F.lit(1)
    rows = staged(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            size.alias("size"),
            F.crc32(words.cast("binary")).alias("text_crc32"),
            F.xxhash64(words).alias("mark"),
            F.least(F.log2(size.cast("double")) / F.lit(32.0), F.lit(0.999999)).alias("size_value"),
            unit(lang).alias("lang_value"),
            unit(source).alias("source_value"),
        ),
        "shard_rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    leaves = count or max(1, math.ceil(total / target_bytes))
    limit = max(1.0, total / leaves * PIECE)

    # At most leaves / TORN_FROM groups can be as heavy as that.
    heavy = (
        rows.groupBy("size", "text_crc32", "mark")
        .agg(F.sum("size").alias("all"), F.count("*").alias("copies"))
        .filter((F.col("all") > F.lit(total / leaves * TORN_FROM)) & (F.col("copies") > 1))
        .withColumn("pieces", F.ceil(F.col("all") / F.lit(limit)))
        .drop("all", "copies")
    )
    heavy = F.broadcast(heavy) if leaves <= BROADCAST_LEAVES else heavy
    keys = ["size", "text_crc32", "mark"]
    # The row's own hash deals it to a piece; rows that repeat whole share one.
    spread = F.pmod(F.xxhash64("doc_id", "lang_value", "source_value"), F.col("pieces"))
    rows = staged(
        rows.join(heavy, keys, "left").withColumn("piece", F.coalesce(spread, F.lit(0).cast("long"))).drop("pieces"),
        "shard_pieces",
    )
    # Nodes are named by their first leaf.
    points = _points(rows).withColumn("node", F.lit(0)).withColumn("leaves", F.lit(leaves))
    points = staged(points, "shard_points")
    half = F.floor(F.col("leaves") / 2).cast("int")
    for _ in range((leaves - 1).bit_length()):
        right = F.coalesce(coordinate(F.col("dim")) >= F.col("at"), F.lit(False))
        divided = points.join(_cuts(points, limit), "node", "left").select(
            *[c for c in points.columns if c not in ("node", "leaves")],
            F.when(right, F.col("node") + half).otherwise(F.col("node")).alias("node"),
            F.when(F.col("leaves") <= 1, F.col("leaves")).when(right, F.col("leaves") - half).otherwise(half).alias("leaves"),
        )
        points = staged(divided, "shard_nodes")
    placed = points.withColumnRenamed("node", "shard").select(*keys, "piece", "shard")
    out = rows.join(placed, [*keys, "piece"]).select("doc_id", "size", "text_crc32", "mark", "shard")
    ranked = numbered(out, ["shard", "text_crc32", "mark", "doc_id"], "__rank")
    ranked = staged(ranked, "shard_ranks")
    first = ranked.groupBy("shard").agg(F.min("__rank").alias("__first"))
    slot = (F.col("__rank") - F.col("__first")).alias("slot")
    return ranked.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", slot, "mark")


def with_shards(docs: DataFrame, count: int = SHARDS, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents with their shard and slot as two more columns.

    Rows meet their place by id and text; rows equal in both are interchangeable and take
    the places in turn.
    """
    shard, slot, *keys, turn = fresh(docs, "shard", "slot", "__a", "__b", "__c", "__turn")
    places = shards(docs, count, doc_id=doc_id, text=text, **names)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))

    def keyed(df: DataFrame, key, mark, crc) -> DataFrame:
        named = zip(keys, (F.xxhash64(key, mark), mark, crc), strict=True)
        return df.withColumns({name: c for name, c in named}).withColumn(turn, nth)

    words = F.coalesce(F.col(text), F.lit(""))
    left = keyed(docs, F.col(doc_id), F.xxhash64(words), F.crc32(words.cast("binary")))
    right = keyed(places.withColumnsRenamed({"shard": shard, "slot": slot}), F.col("doc_id"), F.col("mark"), F.col("text_crc32"))
    joined = left.join(right.select(*keys, turn, shard, slot), [*keys, turn])
    return joined.select(*[F.col(f"`{x}`") for x in docs.columns], shard, slot)
