"""Benchmark decontamination by SimHash of item-sized windows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from txlake.llm import words
from txlake.llm.common import fresh, row_identity, staged

NUMERATOR, DENOMINATOR = 75, 100

# Fingerprints have 64 bits in 8 blocks. Two within 23 bits agree in some block up to 2
# bits. A window of similarity 0.75 is 11 bits from its item on average, with a standard
# deviation of 3; see tests/llm for the measured loss.
BLOCKS, RADIUS = 8, 23

# Items go to the tasks in chunks of at most so many bytes of text.
CHUNK_BYTES = 8 << 20

# Windows meet items in tables of at most so many entries.
TABLE = 1 << 22


def _searcher(ids: list, texts: list, kind: T.DataType, numerator: int, denominator: int, size: int, radius: int):
    """Iterator function over texts: the items that each text contains, and the best similarity."""
    k = words.kernel(size)
    result = T.StructType([T.StructField("items", T.ArrayType(kind)), T.StructField("similarity", T.DoubleType())])
    list_type = pa.list_(to_arrow_type(kind))

    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        u = np.uint64
        bits = np.arange(64, dtype=u)
        near = np.array([[(a ^ b).bit_count() <= radius // BLOCKS for b in range(256)] for a in range(256)])

        def planes(shingles):
            """Running sums of the bits of shingles: a row more than there are shingles."""
            out = np.zeros((len(shingles) + 1, 64), np.int32)
            np.cumsum((shingles[:, None] >> bits) & u(1), axis=0, out=out[1:], dtype=np.int32)
            return out

        def prints(sums, length):
            """SimHash of windows from their bit sums: the majority of each bit."""
            return ((2 * sums > length).astype(u) << bits).sum(axis=1, dtype=u)

        # The items: id, number of shingles, fingerprint, and distinct shingles with counts.
        names, sizes, marks, weights = [], [], [], []
        at = 0
        for offsets, data in k.slices(pa.array(texts, pa.string())):
            shingles, made = k.shingles(*k.words(offsets, data))
            place = 0
            for m in made:
                s = shingles[place : place + m]
                place += m
                if m:
                    names.append(ids[at])
                    sizes.append(int(m))
                    marks.append(prints(planes(s)[-1:], m)[0])
                    weights.append(np.unique(s, return_counts=True))
                at += 1
        sizes, marks = np.array(sizes, np.int64), np.array(marks, u)
        # Postings: for each shingle of the benchmark the items that have it.
        every = np.concatenate([w[0] for w in weights]) if weights else np.zeros(0, u)
        holders = np.repeat(np.arange(len(weights)), [len(w[0]) for w in weights])
        order = np.argsort(every, kind="stable")
        vocabulary, first = np.unique(every[order], return_index=True)
        holders, ends_of = holders[order], np.append(first[1:], len(every))
        mask = np.zeros(1 << 20, bool)
        mask[vocabulary & u((1 << 20) - 1)] = True

        def similarity(window, item):
            """Weighted Jaccard: each shingle weighs as often as it occurs."""
            values, counts = np.unique(window, return_counts=True)
            _, i, j = np.intersect1d(values, item[0], assume_unique=True, return_indices=True)
            least = np.minimum(counts[i], item[1][j]).sum()
            return least, counts.sum() + item[1].sum() - least

        def look(s, place):
            """Items in one text, given its shingles and each one's place in the vocabulary, or -1."""
            seen = {}
            before = np.concatenate(([0], np.cumsum(place >= 0)))
            # Only items that share a shingle with the text can be in it.
            known = np.unique(place[place >= 0])
            sharing = np.unique(np.concatenate([holders[first[v] : ends_of[v]] for v in known]))
            sums = None
            for length in np.unique(sizes[sharing]):
                items = sharing[sizes[sharing] == length]
                width = min(int(length), len(s))
                # A window can reach the similarity only with so many of the items' shingles.
                need = -(-numerator * (length + width) // (numerator + denominator))
                if before[-1] < need:
                    continue
                starts = np.flatnonzero(before[width:] - before[:-width] >= need)
                if not len(starts):
                    continue
                sums = planes(s) if sums is None else sums
                # For each block and value: the items whose block is within the tolerance.
                tables = [near[:, ((marks[items] >> u(8 * b)) & u(255)).astype(np.int64)] for b in range(BLOCKS)]
                step = max(1, TABLE // max(64, len(items)))
                for at in range(0, len(starts), step):
                    part = starts[at : at + step]
                    marked = prints(sums[part + width] - sums[part], width)
                    some = np.zeros((len(part), len(items)), bool)
                    for b in range(BLOCKS):
                        some |= tables[b][((marked >> u(8 * b)) & u(255)).astype(np.int64)]
                    w, i = np.nonzero(some)
                    close = np.bitwise_count(marked[w] ^ marks[items[i]]) <= radius
                    for start, item in zip(part[w[close]], items[i[close]], strict=True):
                        least, most = similarity(s[start : start + width], weights[item])
                        if denominator * least >= numerator * most:
                            seen[names[item]] = max(seen.get(names[item], 0.0), float(least / most))
            return seen

        for texts_ in batches:
            lists, best = [], []
            for offsets, data in k.slices(texts_):
                shingles, made = k.shingles(*k.words(offsets, data))
                places = np.full(len(shingles), -1, np.int64)
                sure = np.flatnonzero(mask[shingles & u((1 << 20) - 1)])
                if len(sure):
                    place = np.minimum(np.searchsorted(vocabulary, shingles[sure]), len(vocabulary) - 1)
                    places[sure] = np.where(vocabulary[place] == shingles[sure], place, -1)
                ends = np.cumsum(made)
                totals = np.concatenate(([0], np.cumsum(places >= 0)))
                for m, end in zip(made, ends, strict=True):
                    seen = look(shingles[end - m : end], places[end - m : end]) if totals[end] > totals[end - m] else {}
                    lists.append(sorted(seen))
                    best.append(max(seen.values(), default=0.0))
            yield pa.StructArray.from_arrays([pa.array(lists, list_type), pa.array(best, pa.float64())], names=["items", "similarity"])

    return F.arrow_udf(search, result)


def _chunks(benchmark: DataFrame, item_id: str, text: str, most: int) -> tuple[DataFrame, int]:
    """The items as a table of (id, text, chunk), and the number of chunks."""
    items = benchmark.select(F.col(item_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter("id is not null")
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    chunks = max(1, -(-2 * total // most)) if total > most else 1
    items = items.distinct().withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))
    if chunks == 1:
        return items, 1
    # In order of the chunks, so that reading one skips the rest.
    return staged(items.repartitionByRange("chunk").sortWithinPartitions("chunk"), "benchmark_chunks"), chunks


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    numerator: int = NUMERATOR,
    denominator: int = DENOMINATOR,
    size: int = words.SHINGLE,
    radius: int = RADIUS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The documents, all columns kept, with ``items`` and ``similarity`` as two more.

    A document contains an item when some window of it, as long as the item in shingles
    of ``size`` words (A-Z lower-cased), has a weighted Jaccard similarity of at least
    ``numerator / denominator`` with it; a shorter document is one window. Windows start
    at every word. Those with enough of the benchmark's shingles to reach the similarity
    at all are fingerprinted by SimHash; an index on 8 blocks finds the items of the same
    length within ``radius`` bits, and the exact similarity decides.

    ``items`` has the ids in order and in their own type, ``similarity`` the best one (0 if
    none). Texts of fewer than ``size`` words are one shingle, so a short item is found only
    as a whole short document; texts without words, null or empty, match nothing. Very long
    texts are read whole, their windows in tables of bounded size. Items without an id are
    left out, repeated items and rows change nothing, an empty benchmark finds nothing, and
    an empty table gives no rows. Columns that clash with the new ones keep their names. The
    benchmark is a table of chunks of ``chunk_bytes``, one pass over the documents for each;
    the driver holds one chunk at a time.
    """
    items, similarity = fresh(docs, "items", "similarity")
    table, chunks = _chunks(benchmark, item_id, item_text, chunk_bytes)
    kind = table.schema["id"].dataType
    (result,) = fresh(docs, "__found")

    def searcher(chunk: int):
        part = table.filter(F.col("chunk") == chunk).orderBy("id", "text").collect()
        return _searcher([r["id"] for r in part], [r["text"] for r in part], kind, numerator, denominator, size, radius)

    if chunks == 1:
        found = docs.withColumn(result, searcher(0)(F.col(text)))
        return found.withColumn(items, F.col(f"{result}.items")).withColumn(similarity, F.col(f"{result}.similarity")).drop(result)
    one, two, *more = fresh(docs, "__a", "__b", "__items", "__best")
    a, b = row_identity(F.col(doc_id), F.col(text))
    hits = None
    for chunk in range(chunks):
        part = docs.select(a.alias(one), b.alias(two), searcher(chunk)(F.col(text)).alias("f")).filter(F.size("f.items") > 0)
        part = staged(part.distinct(), "benchmark_hits")
        hits = part if hits is None else hits.unionByName(part)
    hits = hits.groupBy(one, two).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("f.items")))).alias(more[0]), F.max("f.similarity").alias(more[1])
    )
    joined = docs.withColumn(one, a).withColumn(two, b).join(hits, [one, two], "left")
    nothing = F.array().cast(T.ArrayType(kind))
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(more[0], nothing).alias(items),
        F.coalesce(more[1], F.lit(0.0)).alias(similarity),
    )


def clean(items: Column) -> Column:
    """Whether nothing was found."""
    return F.size(items) == 0


def without_items(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The documents that contain no item; all columns and repeated rows stay."""
    items, similarity = fresh(docs, "items", "similarity")
    return contamination(docs, benchmark, **names).filter(clean(F.col(items))).drop(items, similarity)
