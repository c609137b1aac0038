"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import ascii_lower, staged

BLOCK = 4096

# Seeds tried for the 128-bit keys of blocks; the first without a clash is taken.
SEEDS = range(1, 33)


def _blocks(text: Column, size: int) -> Column:
    """The text cut into blocks of a fixed number of characters; an empty text has one."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.char_length(text) > 0, cut).otherwise(F.array(F.lit("")))


def _names(things: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Integer names of distinct things: sorted where they lie, then counted."""
    return staged(
        things.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()).drop("block"), name
    )


def _block_names(docs: DataFrame, size: int) -> tuple[DataFrame, int]:
    """(k1, k2, name) for each distinct block, and the seed whose keys tell all blocks apart.

    Texts are shuffled once, by the distinct blocks; from then on two 64-bit keys stand
    for a block. That no two blocks share their keys is counted, not assumed.
    """
    blocks = docs.select(F.explode(_blocks(F.col("norm"), size)).alias("block"))
    for seed in SEEDS:
        k1, k2 = _keys(F.col("block"), seed)
        names = _names(blocks.distinct().withColumn("k1", k1).withColumn("k2", k2), ["block"], "block_names")
        if names.groupBy("k1", "k2").count().filter("count > 1").isEmpty():
            return names, seed
    raise RuntimeError("no seed tells the blocks apart")


def _keys(block: Column, seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(seed), block), F.xxhash64(block, F.lit(-seed))


def identities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document with an integer identity (level, name), equal for equal texts only.

    Texts are lower-cased (A-Z) and cut into blocks; distinct blocks are sorted into
    integer names. Adjacent pairs of names are named again, level by level, until each
    document has one name. Equal texts have as many blocks and so end on the same level.

    Columns: uid (unique per row), doc_id, text_sha256, level, name.
    """
    docs = docs.select(
        F.col(doc_id).alias("doc_id"), ascii_lower(F.coalesce(F.col(text), F.lit(""))).alias("norm")
    )
    names, seed = _block_names(docs, block)
    key = lambda b: F.struct(*[k.alias(n) for k, n in zip(_keys(b, seed), ("k1", "k2"), strict=True)])
    rows = staged(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.sha2("norm", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("norm"), block), key).alias("keys"),
        ),
        "block_rows",
    )
    level = staged(
        rows.select("uid", F.size("keys").alias("left"), F.posexplode("keys").alias("pos", "key"))
        .select("uid", "left", "pos", F.col("key.k1").alias("k1"), F.col("key.k2").alias("k2"))
        .join(names, ["k1", "k2"])
        .select("uid", "left", "pos", "name"),
        "level",
    )
    depth, done = 0, []
    longest = level.agg(F.max("left")).first()[0] or 0
    while longest > 0:
        done.append(level.filter("left = 1").select("uid", F.lit(depth).alias("level"), "name"))
        if longest == 1:
            break
        even = F.col("pos") % 2 == 0
        pairs = (
            level.filter("left > 1")
            .groupBy("uid", F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.max("left").alias("left"),
                F.max(F.when(even, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("b"),
            )
        )
        pairs = staged(pairs, "pairs")
        named = _names(pairs.select("a", "b").distinct(), ["a", "b"], "pair_names")
        level = staged(
            pairs.join(named, ["a", "b"]).select("uid", F.shiftright(F.col("left") + 1, 1).alias("left"), "pos", "name"),
            "level",
        )
        depth, longest = depth + 1, (longest + 1) // 2
    if not done:
        return rows.select("uid", "doc_id", "text_sha256", F.lit(0).alias("level"), F.lit(0).cast("long").alias("name"))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return rows.drop("keys").join(found, "uid")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with
    the largest doc_id stays. Null texts are empty. A null id is smaller than any other;
    among rows with the same text and id exactly one stays. An empty table gives no rows.
    """
    found = staged(identities(docs, doc_id, text, block), "identities")
    least = F.lit(-(1 << 63)).cast("long")
    groups = staged(
        found.groupBy("level", "name").agg(
            F.max("doc_id").alias("keep_id"),
            F.max_by("uid", F.coalesce(F.col("doc_id"), least)).alias("keep_uid"),
            F.count("*").alias("group_size"),
        ),
        "groups",
    )
    return found.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256"
    )
