"""Change-data-capture feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = ["__op", "__source_ts_ms", "__deleted", "__db", "__table"]


def unwrap(
    envelopes: DataFrame, before="before", after="after", source="source", op="op", position: str | None = None
) -> DataFrame:
    """Change envelope -> last row image plus ``__`` columns.

    A delete keeps its last image and gets ``__deleted = 'true'``. Tombstones
    (no envelope at all) are dropped. ``position`` names the column with the place in
    the feed, kept as ``__offset``: it orders changes of the same millisecond.
    """
    rows = envelopes.filter(F.col(op).isNotNull())
    rows = rows.withColumn("_image", F.coalesce(F.col(after), F.col(before)))
    return rows.select(
        "_image.*",
        F.col(op).alias("__op"),
        F.col(f"{source}.ts_ms").alias("__source_ts_ms"),
        F.when(F.col(op) == "d", "true").otherwise("false").alias("__deleted"),
        F.col(f"{source}.db").alias("__db"),
        F.col(f"{source}.table").alias("__table"),
        *([] if position is None else [F.col(position).alias("__offset")]),
    )


def is_delete(flag: str = "__deleted") -> Column:
    return F.coalesce(F.col(flag) == "true", F.lit(False))


def split(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes); a missing flag means upsert."""
    return changes.filter(~is_delete()), changes.filter(is_delete())


def net_changes(
    changes: DataFrame, keys: list[str], order: list[str], of_last: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key: the last image in ``order`` and whether the key ends deleted.

    A delete often carries no more than the key, so the image comes from the last
    row that is not a delete and only falls back to the delete's own image; the
    ``of_last`` columns always come from the last change. Aggregation combines per
    task, so a key with very many changes stays cheap.
    """
    columns = [c for c in changes.columns if c not in keys]
    at = F.struct(*order)
    image = F.struct(*columns)
    kept = F.when(~is_delete(), at)
    out = changes.groupBy(*keys).agg(
        F.max_by(image, at).alias("_last"),
        F.max_by(image, kept).alias("_image"),
    )
    ends_deleted = F.coalesce(F.col("_last.__deleted") == "true", F.lit(False))
    return out.select(
        *keys,
        *[
            (F.col("_last") if c in of_last else F.coalesce("_image", "_last"))[c].alias(c)
            for c in columns
            if c != "__deleted"
        ],
        F.when(ends_deleted, "true").otherwise("false").alias("__deleted"),
        F.col("_image").isNotNull().alias("_has_image"),
    )


def apply_changes(
    current: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    order: list[str],
    applied_at: Column,
    hard_delete: bool = False,
    extras: tuple[str, ...] = (),
) -> DataFrame:
    """State of a table after a batch of changes, with last-change-wins.

    Soft delete keeps the row, sets ``__deleted`` and the apply time. A delete of
    a key that was never seen changes nothing. ``order`` must tell the changes
    of one key apart, for instance by source time and offset. ``extras`` are
    columns of the changes that do not belong to the table.
    """
    net = net_changes(changes, keys, order, extras).withColumn("_cdc_ingested_at", applied_at)
    columns = [c for c in net.columns if c not in ("_has_image", *extras)]
    deleted = F.col("__deleted") == "true"
    if current is None:
        fresh = net.filter(F.col("_has_image")).select(*columns)
        return fresh.filter(~deleted) if hard_delete else fresh

    # Known rows and new keys are handled apart, because a full outer join always
    # shuffles both sides: here a small set of changes can be broadcast (adaptive
    # execution decides by its size) and the table stays where it is.
    def same_key(left: str, right: str) -> Column:
        return reduce(
            lambda a, b: a & b,
            [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys],
        )

    marked = net.withColumn("_change", F.lit(True)).alias("s")
    joined = current.alias("t").join(marked, same_key("t", "s"), "left")
    changed = F.col("s._change").isNotNull()
    new_image = changed & F.col("s._has_image")
    flags = {"__deleted", "_cdc_ingested_at"}
    known = joined.select(
        *[
            F.when(changed if c in flags else new_image, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in columns
        ]
    )
    seen = current.select(*keys).alias("t").join(net.select(*keys).alias("s"), same_key("t", "s"), "left_semi")
    fresh = net.filter("_has_image").alias("s").join(seen.alias("k"), same_key("s", "k"), "left_anti")
    out = known.unionByName(fresh.select(*columns))
    return out.filter(F.coalesce(F.col("__deleted") != "true", F.lit(True))) if hard_delete else out
