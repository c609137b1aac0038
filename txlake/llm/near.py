"""Near duplicates: a join on the Jaccard similarity of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.llm import words
from txlake.llm.common import fresh, numbered, row_identity, staged
from txlake.llm.components import components

# Similarity from which documents link, as a fraction.
NUMERATOR, DENOMINATOR = 75, 100

# Shingles that linked documents must share among their first ones, as a part of all.
# More of them mean more entries and fewer candidates.
SHARED = 10

# Texts are cut into words in slices of so many bytes.
SLICE = 1 << 18

# A tile compares two blocks of sets. A block has BLOCK sets of up to WIDE shingles, half as
# many of up to twice the size, and so on: 16 MB at most, unless one set alone is larger.
BLOCK = 2048
WIDE = 512

# Shingles in a row on their way to a tile; longer sets take several rows.
PIECE = 4096

SIGNATURE = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("cid", T.LongType()),
        T.StructField("first", T.ArrayType(T.LongType())),
    ]
)


def _signature(numerator: int, denominator: int, size: int):
    """Arrow function: size and key of a text's shingle set, and its first shingles by number.

    Of n shingles, a linked document shares at least o = ceil(t n). So two linked sets
    share at least k of their first n - o + k shingles, for any k: these are kept, with
    k a tenth of n. A set that the same task has met before is a copy, and gets none.
    """
    k = words.kernel(size, SLICE)
    part = SHARED

    def signature(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        met = set()
        for texts in batches:
            sizes, keys, firsts = [], [], []
            for s in k.sets(texts):
                n = len(s)
                key = int(k.mix(k.mix(s).sum(dtype=np.uint64).reshape(1) + np.uint64(n)).view(np.int64)[0])
                sizes.append(n)
                keys.append(key)
                if n == 0 or key in met:
                    firsts.append(s[:0].view(np.int64))
                else:
                    met.add(key)
                    firsts.append(s[: n + (-numerator * n // denominator) - (-n // part)].view(np.int64))
            ends = np.cumsum([0] + [len(f) for f in firsts]).astype(np.int32)
            flat = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["n", "cid", "first"],
            )

    return F.arrow_udf(signature, SIGNATURE)


def _shingles(size: int):
    """Arrow function: the distinct shingles of a text."""
    k = words.kernel(size, SLICE)

    def shingles(texts: pa.Array) -> pa.Array:
        return pa.array([s.view("int64") for s in k.sets(texts)], pa.list_(pa.int64()))

    return F.arrow_udf(shingles, T.ArrayType(T.LongType()))


def _bound(n, numerator: int, denominator: int):
    """Shingles that a set of n shares with any set it links with, at least."""
    return F.ceil(n * F.lit(numerator) / F.lit(denominator))


def _meeting(signatures: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(cid, n) of the sets that can have a link, as far as their first shingles tell.

    The incidence of sets and shingles, taken by columns: a set counts the columns that it
    doesn't have to itself. Copies of a set from several tasks count too often; that lets
    more sets through, never fewer.
    """
    entries = signatures.select("cid", "n", F.explode("first").alias("h"))
    counts = staged(entries.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1").select("h"), "shared_columns")
    # What the smallest possible partner shares at least of the first shingles.
    need = F.greatest(F.ceil(_bound(F.col("n"), numerator, denominator) / F.lit(SHARED)), F.lit(1))
    return entries.join(counts, "h").groupBy("cid", "n").agg(F.count("*").alias("s")).filter(F.col("s") >= need).select("cid", "n")


def _sets(texts: DataFrame, numerator: int, denominator: int, size: int) -> DataFrame:
    """(cid, n, set): the shared shingles of each set that can have a link, rarest first.

    The incidence of sets and shingles, without the columns of a single set and then without
    the sets whose shared columns are fewer than any link needs. What is left out adds
    nothing to an overlap of two sets that are left.
    """
    split = _shingles(size)
    entries = texts.select("cid", split("text").alias("set")).select("cid", F.size("set").alias("n"), F.explode("set").alias("h"))
    counts = staged(entries.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "columns")
    of_set = Window.partitionBy("cid", "n")
    shared = entries.join(counts, "h").withColumn("s", F.count("*").over(of_set))
    shared = shared.filter(F.col("s") >= _bound(F.col("n"), numerator, denominator))
    ordered = F.sort_array(F.collect_list(F.struct("df", "h")))
    return staged(shared.groupBy("cid", "n").agg(ordered.getField("h").alias("set")), "sets")


def _clumps(sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(cid, n, set, clump): sets that any link can join have the same clump.

    Of s shared columns of which a link needs o, linked sets have one of the s - o + 1 rarest
    in common. These columns join sets into clumps: each set hangs on the smallest set of
    the column, so a column of k sets makes k - 1 edges and no pairs.
    """
    few = F.size("set") - _bound(F.col("n"), numerator, denominator) + 1
    keys = sets.select("cid", F.explode(F.slice("set", F.lit(1), few.cast("int"))).alias("h"))
    hubs = keys.groupBy("h").agg(F.min("cid").alias("hub"), F.max("cid").alias("top")).filter("hub < top").select("h", "hub")
    edges = keys.join(hubs, "h").filter("cid <> hub").select(F.col("cid").alias("x"), F.col("hub").alias("y"))
    found = staged(components(edges), "clumps")
    return sets.join(found.select(F.col("node").alias("cid"), F.col("root").alias("clump")), "cid")


def _tiles(clumped: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(one, two, side, cid, n, part): the sets of each pair of blocks, in pieces.

    The sets of a clump are cut by size into blocks; blocks of one clump meet if their sizes
    allow a link. ``one`` and ``two`` name the blocks by the number of their first set, and
    ``side`` says to which of them a set belongs.
    """
    band = F.greatest(F.floor(F.log2(F.col("n") / F.lit(WIDE))), F.lit(0)).cast("int")
    rows = numbered(clumped.withColumn("band", band), ["clump", "band", "n", "cid"], "at")
    starts = rows.groupBy("clump", "band").agg(F.min("at").alias("start"))
    height = F.greatest(F.expr(f"shiftright({BLOCK}, least(band, 30))"), F.lit(1)).cast("long")
    place = F.col("at") - F.pmod(F.col("at") - F.col("start"), height)
    rows = staged(rows.join(starts, ["clump", "band"]).select("clump", "cid", "n", "set", place.alias("block")), "blocks")
    blocks = rows.groupBy("clump", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    left = blocks.select("clump", F.col("block").alias("one"), "high")
    right = blocks.select("clump", F.col("block").alias("two"), "low")
    pairs = left.join(right, "clump").filter((F.col("one") <= F.col("two")) & (F.col("high") * denominator >= F.col("low") * numerator))
    pairs = staged(pairs.select("one", "two"), "tiles")
    sides = pairs.select("one", "two", F.col("one").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.filter("one < two").select("one", "two", F.col("two").alias("block"), F.lit(1).alias("side"))
    )
    dealt = rows.join(sides, "block")
    starts_of = F.sequence(F.lit(1), F.size("set"), F.lit(PIECE))
    return dealt.select("one", "two", "side", "cid", "n", "set", F.explode(starts_of).alias("from")).select(
        "one", "two", "side", "cid", "n", F.slice("set", F.col("from"), F.lit(PIECE)).alias("part")
    )


def _product(numerator: int, denominator: int):
    """Function over batches sorted by tile: the links within each tile.

    A tile is the product of two blocks of the incidence of sets and shingles. Columns that
    many sets have are multiplied as dense matrices, the others add one for each pair of
    sets that they hold. Pairs whose overlap is below the bound of their sizes are discarded.
    For each set that links there is one row (cid, hub, links): the smallest set that it
    is connected with in the tile, and the number of its links in the tile.
    """
    columns, budget = 2048, 1 << 20
    schema = pa.schema([("cid", pa.int64()), ("hub", pa.int64()), ("links", pa.int64())])

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def overlaps(a, b):
            """Shared columns of each set of a with each of b, given (set, column) of their entries."""
            (rows_a, of_a, high), (rows_b, of_b, wide) = a, b
            names, at = np.unique(np.concatenate([of_a, of_b]), return_inverse=True)
            at_a, at_b = at[: len(of_a)], at[len(of_a) :]
            df_a, df_b = np.bincount(at_a, minlength=len(names)), np.bincount(at_b, minlength=len(names))
            both = np.zeros((high, wide), np.int32)
            meet = df_a * df_b
            hot = meet * 64 > high * wide
            number = np.cumsum(hot) - 1
            for first in range(0, int(hot.sum()), columns):
                sides = []
                for rows, cols, height in ((rows_a, at_a, high), (rows_b, at_b, wide)):
                    here = hot[cols] & (number[cols] >= first) & (number[cols] < first + columns)
                    side = np.zeros((height, min(columns, int(hot.sum()) - first)), np.float32)
                    side[rows[here], number[cols[here]] - first] = 1
                    sides.append(side)
                both += (sides[0] @ sides[1].T).astype(np.int32)
            # The other columns: each entry of a with the run of its column in b.
            order = np.argsort(at_b, kind="stable")
            runs = np.cumsum(df_b) - df_b
            cold = ~hot[at_a] & (df_b[at_a] > 0)
            rows, cols = rows_a[cold], at_a[cold]
            ends = np.cumsum(df_b[cols])
            done = 0
            while done < len(rows):
                before = ends[done - 1] if done else 0
                to = max(done + 1, int(np.searchsorted(ends, before + budget, "right")))
                count = df_b[cols[done:to]]
                inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                partner = rows_b[order[np.repeat(runs[cols[done:to]], count) + inside]]
                np.add.at(both.reshape(-1), np.repeat(rows[done:to], count) * wide + partner, 1)
                done = to
            return both

        def block(rows):
            """(cids, sizes, entries) of the rows of a block."""
            cid = np.concatenate([r[0] for r in rows])
            n = np.concatenate([r[1] for r in rows])
            lengths = np.concatenate([r[2] for r in rows])
            names, first, of = np.unique(cid, return_index=True, return_inverse=True)
            return names, n[first], (np.repeat(of, lengths), np.concatenate([r[3] for r in rows]), len(names))

        def linked(tile):
            one = block(tile[0])
            same = not tile[1]
            two = one if same else block(tile[1])
            both = overlaps(one[2], two[2])
            link = np.empty(both.shape, bool)
            for at in range(0, len(both), 256):
                total = one[1][at : at + 256, None] + two[1][None]
                link[at : at + 256] = both[at : at + 256].astype(np.int64) * (numerator + denominator) >= numerator * total
            del both
            if same:
                np.fill_diagonal(link, False)
            links = [link.sum(1), link.sum(0)]
            hubs = [one[0].copy(), two[0].copy()]
            if same:
                hubs[1] = hubs[0]
            most = np.iinfo(np.int64).max
            while True:
                was = [h.copy() for h in hubs]
                for at in range(0, len(link), 256):
                    part = link[at : at + 256]
                    hubs[0][at : at + 256] = np.minimum(
                        hubs[0][at : at + 256], np.where(part, hubs[1][None], most).min(1)
                    )
                    hubs[1][:] = np.minimum(
                        hubs[1], np.where(part, hubs[0][at : at + 256, None], most).min(0)
                    )
                if all((h == w).all() for h, w in zip(hubs, was, strict=True)):
                    break
            out = [(one[0], hubs[0], links[0])] if same else [(one[0], hubs[0], links[0]), (two[0], hubs[1], links[1])]
            keep = [k > 0 for _, _, k in out]
            return [np.concatenate([o[i][k] for o, k in zip(out, keep, strict=True)]).astype(np.int64) for i in range(3)]

        def results():
            now, tile = None, ([], [])
            for batch in batches:
                one, two, side = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                cid, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 4))
                parts = batch.column(5)
                offsets = parts.offsets.to_numpy()
                values = parts.values.to_numpy(zero_copy_only=False)
                turns = np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (side[1:] != side[:-1])) + 1
                for at, to in zip([0, *turns], [*turns, len(one)], strict=True):
                    if at == to:
                        continue
                    if now != (one[at], two[at]):
                        if now is not None:
                            yield linked(tile)
                        now, tile = (one[at], two[at]), ([], [])
                    flat = values[offsets[at] : offsets[to]].copy()
                    tile[int(side[at])].append((cid[at:to].copy(), n[at:to].copy(), np.diff(offsets[at : to + 1]), flat))
            if now is not None:
                yield linked(tile)

        # Results of many small tiles go out together.
        held, rows = [], 0
        for found in results():
            held.append(found)
            rows += len(found[0])
            if rows >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], schema=schema)
                held, rows = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], schema=schema)

    return product


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    numerator: int = NUMERATOR,
    denominator: int = DENOMINATOR,
    size: int = words.SHINGLE,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, n_links, root, a and b.

    A document's set is that of its distinct shingles of ``size`` words (A-Z lower-cased);
    with fewer words it is the whole sequence, without words it is empty and links with
    nothing. Documents link when the Jaccard similarity of their sets is at least
    ``numerator / denominator``; component_id is the smallest doc_id reachable by links.

    Documents with equal sets are one class, and only classes are joined, as a blocked sparse
    product of classes by shingles. Sizes bound the overlap of a link, so the rarest columns
    of each class part the classes into clumps (see ``_meeting``, ``_sets`` and ``_clumps``);
    the classes of a clump are cut into blocks, and each pair of blocks is a tile, in which
    one task accumulates the overlaps of all its pairs and discards those below the bound.
    Out of a tile comes one row per class: no list of pairs is made, and no link is missed.
    ``n_links`` is the number of other classes that the document's class links with.

    ``a`` and ``b`` are the row's identity (see ``row_identity``); repeated rows share
    it. Null texts are empty; null ids never are a component's id unless all are null.
    A very long text's shingles are held by one task at a time. An empty table gives no
    rows. Further columns are not read, whatever their names.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    a, b = row_identity(F.col("doc_id"), F.col("text"))
    docs = docs.withColumn("a", a).withColumn("b", b)
    sign = _signature(numerator, denominator, size)
    signatures = staged(
        docs.withColumn("s", sign("text")).select(
            "doc_id", "a", "b", F.col("s.n").alias("n"), F.col("s.cid").alias("cid"), F.col("s.first").alias("first")
        ),
        "signatures",
    )
    meeting = staged(_meeting(signatures, numerator, denominator).select("cid"), "meeting")
    # One row stands for its class: the one with the smallest identity.
    reps = signatures.join(meeting, "cid", "left_semi").groupBy("cid").agg(F.min("a").alias("a"), F.min_by("b", "a").alias("b"))
    reps = staged(reps, "representatives")
    texts = staged(docs.select("a", "b", "text").join(reps, ["a", "b"]).select("cid", "text"), "candidate_texts")
    if texts.count() > reps.count():  # repeated rows
        texts = staged(texts.dropDuplicates(["cid"]), "candidate_texts")
    sets = _sets(texts, numerator, denominator, size)
    tiles = _tiles(_clumps(sets, numerator, denominator), numerator, denominator)
    tiles = tiles.repartition("one", "two").sortWithinPartitions("one", "two", "side")
    links = staged(tiles.mapInArrow(_product(numerator, denominator), "cid long, hub long, links long"), "links")
    roots = components(links.select(F.col("cid").alias("x"), F.col("hub").alias("y"))).withColumnRenamed("node", "cid")
    roots = roots.join(links.groupBy("cid").agg(F.sum("links").alias("n_links")), "cid")

    members = staged(
        signatures.drop("first")
        .join(roots, "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
        .withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))),
        "members",
    )
    least = staged(members.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")), "least_ids")
    return members.join(least, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("cid").alias("class_id"),
        "n_links",
        "root",
        "a",
        "b",
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """One document of each component, the one with the smallest id; all columns are kept.

    A null id is larger than any other. Of rows with the same id in a component the one
    with the smallest identity stays, and of repeated rows one. Documents without words
    are in no component and stay, all of them.
    """
    found = staged(near_duplicates(docs, doc_id, text, **names), "components")
    last = F.lit((1 << 63) - 1).cast("long")
    order = F.coalesce(F.col("doc_id").cast("long"), last)
    worded = found.filter("n_shingles > 0").withColumn("order", order)
    least = staged(worded.groupBy("root").agg(F.min("order").alias("least")), "least_orders")
    first = worded.join(least, "root").filter("order = least").groupBy("root").agg(F.min("a").alias("a"), F.min_by("b", "a").alias("b"))
    stay = first.select("a", "b", F.lit(True).alias("once")).unionByName(
        found.filter("n_shingles = 0").select("a", "b", F.lit(False).alias("once")).distinct()
    )
    one, two, once, turn = fresh(docs, "__a", "__b", "__once", "__turn")
    stay = staged(stay.toDF(one, two, once), "staying")
    a, b = row_identity(F.col(doc_id), F.col(text))
    joined = docs.withColumn(one, a).withColumn(two, b).join(stay, [one, two])
    numbered = joined.withColumn(turn, F.row_number().over(Window.partitionBy(one, two).orderBy(F.lit(0))))
    return numbered.filter(~F.col(once) | (F.col(turn) == 1)).select(*[F.col(f"`{c}`") for c in docs.columns])
