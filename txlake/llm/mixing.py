"""Mix sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import fresh, staged, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Target of each source: its weight's share of all sizes, at most ``most`` times its own size.

    ``sizes`` has source and size (one row per document). Sources are taken by code
    point, null last, and weigh ``weights`` in turn. What a source cannot take is shared
    among the others by weight, until none is above its limit. A source without words
    has the target 0; an empty table has no rows.

    The table has one row per source. Each round of sharing reads two sums from it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    table = staged(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(turn, (F.row_number().over(order) - 1) % len(weights) + 1)),
        "sources",
    )
    limit = F.col("source_size") * F.lit(float(most))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, -1
    while True:
        # At a level, a source takes level * weight, or its limit if that is less.
        over = F.lit(False) if level is None else limit <= F.lit(level) * F.col("weight")
        spent, open_weight, count = table.agg(
            F.sum(F.when(over, limit).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.sum(F.when(over, 1).otherwise(0)),
        ).first()
        if not open_weight or count == full:
            break
        full, level = count, (total - spent) / open_weight
    share = F.lit(level or 0.0) * F.col("weight")
    return table.withColumn("target", F.least(limit, share))


def coin(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id, or from the text where there is no id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mixture(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document with the number of copies that the mix takes.

    Words are summed per source; a source's rate is its target over its size; a document
    is taken floor(rate) times, and once more if its hash-seeded coin falls below the rest.
    Columns: doc_id, size, source_size, target, rate, copies, taken.

    Null or empty texts have size 0 and are taken by the same rule (0 words). Documents
    without a source form a source of their own, last in the order. Repeated rows share
    one coin. Rows without an id take the coin of their text. A very long text is one row
    like any other: its words are counted where it lies. An empty table gives no rows.
    Further columns are not read, whatever their names.
    """
    sized = staged(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            coin(F.col(doc_id), F.col(text), seed).alias("coin"),
        ),
        "sized",
    )
    targets = source_targets(sized, weights, most).withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rate", rate)
        .withColumn("copies", whole + F.when(F.col("coin") < F.col("rate") - whole, 1).otherwise(0))
        .select(
            "doc_id", "size", "source_size", "target", "rate", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def repeat_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """The documents of the mix: each row as often as ``mixture`` takes it, all columns kept."""
    named = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    targets = source_targets(named, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    of, per, copy = fresh(docs, "__of", "__rate", "__copy")
    rates = targets.select(F.col("source").alias(of), rate.alias(per))
    whole = F.floor(per)
    copies = whole + F.when(coin(F.col(doc_id), F.col(text), seed) < F.col(per) - whole, 1).otherwise(0)
    joined = docs.join(rates, F.col(source).eqNullSafe(F.col(of)))
    repeated = joined.withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
