"""Phrases whose words stand together more often than apart.

A word's id is a number of 64 bits. The ids of a run of two to four words are permuted
together, invertibly, so that they spread evenly: the first of them is the quotient and
the others are the remainder, kept in full. That makes a counting quotient filter that
loses nothing, held as sorted arrays. A task builds filters of its texts; all filters are
cut by quotient, and those of one range of quotients are merged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.llm import words
from txlake.llm.common import staged

# Fixed values of the registered query.
LONGEST = 4
LEAST = 30
TOP = 2000
PER_MILLION_PAIR = 2_000_000
INSIDE_PERCENT = 80
UNKNOWN = "und"

# Bytes of text that a task numbers at a time, at most one text part more.
SLICE_BYTES = 1 << 20

# Different words that a task counts before it sends them off, and rows of one Arrow batch.
WORDS_HELD = 1 << 17
BATCH_ROWS = 1 << 14

# Entries that a filter of one task holds before it is sent off, and that one merge reads on average.
FILTER_ENTRIES = 1 << 19
MERGE_ENTRIES = 1 << 19

# Ids of words start from this number; with another one if two words shared an id.
SEEDS = (1, 2, 3, 4)

# Salts of the top lists: a language's candidates are cut in so many parts first.
SALTS = 64

# Bits of the table that rules out runs whose parts are rare, in units of 32,768.
SIEVE_UNITS = 4096

COUNTS = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()), T.StructField("count", T.LongType())]
)
FILTER = T.StructType(
    [
        T.StructField("range", T.LongType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)
NAMES = ["a", "b", "c", "d"]
PACKED = T.StructType([T.StructField(c, T.LongType()) for c in (*NAMES, "f")])


def permutation() -> SimpleNamespace:
    """An invertible permutation of one to four 64-bit numbers, as arrays: each in turn is mixed into the next."""
    import numpy as np

    u = np.uint64
    keys = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]

    def mix(x):
        x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
        return x ^ (x >> u(31))

    def turns(n):
        return [(i, (i + 1) % n, k) for k in keys for i in range(n)] if n > 1 else []

    def forward(lanes):
        lanes = list(lanes)
        for i, j, k in turns(len(lanes)):
            lanes[j] = lanes[j] ^ mix(lanes[i] + u(k))
        return lanes

    def backward(lanes):
        lanes = list(lanes)
        for i, j, k in reversed(turns(len(lanes))):
            lanes[j] = lanes[j] ^ mix(lanes[i] + u(k))
        return lanes

    def bit(lanes):
        """Where the sieve notes a run."""
        lanes = forward(lanes)
        return (lanes[0] ^ (lanes[-1] >> u(7))) % u(SIEVE_UNITS * 32768)

    return SimpleNamespace(forward=forward, backward=backward, bit=bit, mix=mix)


def filters() -> SimpleNamespace:
    """Counting quotient filters as sorted arrays of (quotient and remainder, count)."""
    import numpy as np

    def sums(lanes, count):
        """Sort entries and add up the counts of equal ones."""
        order = np.lexsort(lanes[::-1])
        lanes, count = [x[order] for x in lanes], count[order]
        new = np.ones(len(count), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in lanes])
        first = np.flatnonzero(new)
        return [x[first] for x in lanes], np.add.reduceat(count, first) if len(first) else count

    def merged(parts):
        """The filter that holds what all the given ones hold."""
        return sums([np.concatenate(x) for x in zip(*(lanes for lanes, _ in parts))], np.concatenate([c for _, c in parts]))

    def packed(lanes, count):
        """Bytes of keys and of counts, these as narrow as the largest allows."""
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(count) or count.max() <= np.iinfo(k).max)
        width = bytes([np.dtype(kind).itemsize])
        return np.stack(lanes).tobytes(), width + count.astype(kind).tobytes()

    def unpacked(n, keys, counts):
        lanes = np.frombuffer(keys, np.uint64).reshape(n, -1)
        return list(lanes), np.frombuffer(counts, f"u{counts[0]}", offset=1).astype(np.int64)

    return SimpleNamespace(sums=sums, merged=merged, packed=packed, unpacked=unpacked)


def _cutter(part_bytes: int, between: bytes):
    """Function from a text to its parts in UTF-8, with ``between`` where a piece ends.

    A-Z are lower-cased and tabs become blanks. A text longer than ``part_bytes`` is cut
    where a piece ends, if one does.
    """
    plain = bytearray(range(256))
    plain[65:91] = plain[97:123]
    plain[9] = 32
    for end in b".,;:!?\n\x0b\x0c\r":
        plain[end] = 0xFF  # never in UTF-8
    plain = bytes(plain)

    def parts(text: str | None) -> Iterator[bytes]:
        data, at = (text or "").encode().translate(plain), 0
        while at < len(data):
            end = data.find(b"\xff", at + part_bytes) if len(data) - at > part_bytes else -1
            to = end + 1 if end >= 0 else len(data)
            yield data[at:to].replace(b"\xff", between)
            at = to

    return parts


def _numbers(seed: int):
    """Functions that number words: of texts with breaks as 0, and of single words."""
    import numpy as np

    k, u = words.kernel(slice_bytes=SLICE_BYTES), np.uint64
    # By a kernel of its own: one that has numbered words holds tables of some 30 MB, which
    # would travel with the job.
    brk = words.kernel(slice_bytes=1).words(np.array([0, 1]), np.frombuffer(b"\xff", np.uint8))[0][0]

    def code(langs: list[str]):
        """One number for each language."""
        numbers = {}
        for lang in langs:
            if lang not in numbers:
                data = b"lang:" + lang.encode().hex().encode()
                numbers[lang] = k.words(np.array([0, len(data)]), np.frombuffer(data, np.uint8))[0][0]
        return np.array([numbers[lang] for lang in langs], u)

    def ids(numbers, langs):
        out = k.mix((numbers ^ k.mix(langs + u(seed))) + u(0x9E3779B97F4A7C15))
        out[out == 0] = 1
        return out

    def texts(parts: list[bytes], langs: list[str]):
        """Ids of all words, 0 between pieces, in slices that end with texts."""
        of, at = code(langs), 0
        for offsets, data in k.slices(pa.array(parts, pa.binary())):
            numbers, counts = k.words(offsets, data)
            lang = np.repeat(of[at : at + len(counts)], counts)
            at += len(counts)
            out = ids(numbers, lang)
            out[numbers == brk] = 0
            yield out

    def single(found: list[bytes], langs: list[str]):
        """Id of each word."""
        numbers = [k.words(offsets, data)[0] for offsets, data in k.slices(pa.array(found, pa.binary()))]
        return ids(np.concatenate(numbers) if numbers else np.zeros(0, u), code(langs))

    return SimpleNamespace(texts=texts, single=single)


def _counted(part_bytes: int, held: int):
    """Arrow function: texts to (lang, word, count), added up for some words at a time."""
    parts = _cutter(part_bytes, b" ")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter, defaultdict

        counts = defaultdict(Counter)

        def rows():
            for lang, words in counts.items():
                found, number = list(words), list(words.values())
                for at in range(0, len(found), BATCH_ROWS):
                    some = pa.array(found[at : at + BATCH_ROWS], pa.binary()).cast(pa.string())
                    n = pa.array(number[at : at + BATCH_ROWS], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), some, n], COUNTS.names)
            counts.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                for data in parts(text.as_py()):
                    counts[lang].update(data.split())
                    if len(counts[lang]) >= held:
                        yield from rows()
        yield from rows()

    return counted


def _identified(seed: int):
    """Arrow function: adds the id of each word."""
    number = _numbers(seed)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            words = batch.column(batch.schema.names.index("word")).cast(pa.binary()).to_pylist()
            ids = number.single(words, batch.column(batch.schema.names.index("lang")).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids.view(np.int64))], [*batch.schema.names, "id"])

    return identified


def _filtered(n: int, seed: int, ranges: int, sieve: Broadcast, part_bytes: int, entries: int):
    """Arrow function: texts to the filters of their runs of ``n`` words, cut into ranges of quotients."""
    turn, cqf, number, parts = permutation(), filters(), _numbers(seed), _cutter(part_bytes, b" \xff ")

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np

        u = np.uint64
        table = np.frombuffer(zlib.decompress(sieve.value), np.uint8)

        def may_be_frequent(lanes):
            bit = turn.bit(lanes)
            return (table[(bit >> u(3)).astype(np.int64)] >> (bit & u(7)).astype(np.uint8)) & 1 == 1

        def sent(lanes, count):
            # The upper 32 bits of the quotient choose the range.
            part = ((lanes[0] >> u(32)) * u(ranges)) >> u(32)
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = np.append(starts[1:], len(part))
            for at in range(0, len(starts), 64):
                some = list(zip(starts[at : at + 64], ends[at : at + 64]))
                packs = [cqf.packed([x[a:b] for x in lanes], count[a:b]) for a, b in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[starts[at : at + 64]].astype(np.int64)),
                        pa.array([k for k, _ in packs], pa.binary()),
                        pa.array([c for _, c in packs], pa.binary()),
                    ],
                    FILTER.names,
                )

        held, size, waiting, langs, weight = [], 0, [], [], 0

        def add():
            nonlocal held, size, waiting, langs, weight
            for s in number.texts(waiting, langs):
                places = len(s) - n + 1
                if places <= 0:
                    continue
                whole = np.ones(places, bool)
                for i in range(n):
                    whole &= s[i : places + i] != 0
                a = np.flatnonzero(whole)
                # A run can only be frequent if both of its runs one word shorter are.
                a = a[may_be_frequent([s[a + i] for i in range(n - 1)])]
                a = a[may_be_frequent([s[a + i + 1] for i in range(n - 1)])]
                if len(a):
                    held.append(cqf.sums(turn.forward([s[a + i] for i in range(n)]), np.ones(len(a), np.int64)))
                    size += len(held[-1][1])
                if size >= entries:
                    held = [cqf.merged(held)]
                    size = len(held[0][1])
                    if size >= entries // 2:
                        yield from sent(*held[0])
                        held, size = [], 0
            waiting, langs, weight = [], [], 0

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                for data in parts(text.as_py()):
                    # A break after each part keeps texts apart.
                    waiting.append(data + b" \xff")
                    langs.append(lang.as_py())
                    weight += len(data)
                    if weight >= part_bytes:
                        yield from add()
        yield from add()
        if held:
            yield from sent(*cqf.merged(held))

    return filtered


def _merged(n: int, least: int):
    """Arrow function: all filters of one range of quotients to the runs seen often enough."""
    turn, cqf = permutation(), filters()

    def merged(table: pa.Table) -> pa.Table:
        import numpy as np

        found = zip(table.column("keys"), table.column("counts"))
        lanes, count = cqf.merged([cqf.unpacked(n, k.as_py(), c.as_py()) for k, c in found])
        often = count >= least
        ids = turn.backward([x[often] for x in lanes])
        ids += [np.zeros(len(ids[0]), np.uint64)] * (len(NAMES) - n)
        return pa.table([*(pa.array(x.view(np.int64)) for x in ids), pa.array(count[often])], names=PACKED.names)

    return merged


def run_counts(plain: DataFrame, n: int, seed: int, total: int, least: int, sieve: Broadcast) -> DataFrame:
    """(a, b, c, d, f): runs of ``n`` words by id, 0 where there is none, seen ``least`` times or more.

    ``total`` is the number of all words: there are no more runs, so it sets the number of ranges.
    """
    ranges = min(max(1, -(-total // MERGE_ENTRIES)), 1 << 31)
    cut = plain.mapInArrow(_filtered(n, seed, ranges, sieve, SLICE_BYTES, FILTER_ENTRIES), FILTER)
    return cut.groupBy("range").applyInArrow(_merged(n, least), PACKED)


def _sieve(frequent: DataFrame, n: int) -> Broadcast:
    """Bits of all frequent runs of ``n`` words, compressed: 4096 rows of 4 KB at most, whatever
    the table holds. Sent to each executor once; the caller destroys it."""
    turn = permutation()

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            lanes = [batch.column(i).to_numpy().view(np.uint64) for i in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(turn.bit(lanes).astype(np.int64))], ["bit"])

    numbers = frequent.select(*NAMES[:n]).mapInArrow(bits, "bit long")
    units = numbers.groupBy(F.floor(F.col("bit") / 32768).alias("unit")).agg(
        F.bitmap_construct_agg((F.col("bit") % 32768)).alias("data")
    )
    table = np.zeros((SIEVE_UNITS, 4096), np.uint8)
    for r in units.collect():
        table[r["unit"], : len(r["data"])] = np.frombuffer(bytes(r["data"]), np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(zlib.compress(table.tobytes(), 1))


def _identify(counted: DataFrame, least: int, seeds: tuple[int, ...] = SEEDS) -> tuple[int, DataFrame]:
    """A seed under which no frequent word shares its id with another word, and the frequent words with theirs."""
    for seed in seeds:
        schema = T.StructType([*counted.schema.fields, T.StructField("id", T.LongType())])
        known = counted.mapInArrow(_identified(seed), schema)
        shared = known.groupBy("id").agg(F.count("*").alias("n"), F.max("f").alias("f"))
        if shared.filter((F.col("n") > 1) & (F.col("f") >= least)).isEmpty():
            return seed, staged(counted.filter(F.col("f") >= least).mapInArrow(_identified(seed), schema), "frequent")
    raise RuntimeError("two words share an id under every seed")


def _key(names: list[str]) -> list[Column]:
    """Columns a to d from fewer names, filled up with 0."""
    zero = F.lit(0).cast("long")
    return [F.col(n) for n in names] + [zero] * (4 - len(names))


def scored(runs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Adds l, r and score of the lowest-scoring cut to all runs of two words and more.

    ``runs`` holds the counts of all frequent runs from one word on, with their length n.
    Parts of a frequent run are frequent, so each cut finds its two counts.
    """
    names = NAMES
    sides = []
    for n in range(2, longest + 1):
        of = runs.filter(F.col("n") == n)
        for k in range(1, n):
            for side, part in (("l", names[:k]), ("r", names[k:n])):
                key = F.struct(*[c.alias(x) for c, x in zip(_key(part), names)])
                sides.append(of.select(*names, "n", "f", F.lit(k).alias("k"), F.lit(side).alias("side"), key.alias("key")))
    cuts = sides[0]
    for s in sides[1:]:
        cuts = cuts.unionByName(s)
    counts = runs.select(F.struct(*names).alias("key"), F.col("f").alias("part"))
    together = (
        cuts.join(counts, "key")
        .groupBy(*names, "n", "f", "k")
        .agg(F.max(F.when(F.col("side") == "l", F.col("part"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("part"))).alias("r"))
    )
    # Products are decimals of up to 38 places; the division of whole numbers is exact.
    score = F.expr(f"cast(f as decimal(20,0)) * cast({PER_MILLION_PAIR} as decimal(10,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("m")
    return together.groupBy(*names, "n", "f").agg(lowest).select(*names, "n", "f", "m.l", "m.r", "m.score")


def standing_alone(runs: DataFrame, longest: int = LONGEST, percent: int = INSIDE_PERCENT) -> DataFrame:
    """Runs that no longer run holds most of the time, or all the time."""
    names = NAMES
    inner = []
    for n in range(3, longest + 1):
        of = runs.filter(F.col("n") == n)
        for m in range(2, n):
            for at in range(n - m + 1):
                inner.append(of.select(*[c.alias(x) for c, x in zip(_key(names[at : at + m]), names)], F.col("f").alias("longer")))
    parts = inner[0]
    for p in inner[1:]:
        parts = parts.unionByName(p)
    longer = parts.groupBy(*names).agg(F.max("longer").alias("longer"))
    return runs.join(longer, names, "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * percent)
    ).drop("longer")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    percent: int = INSIDE_PERCENT,
) -> DataFrame:
    """The ``top`` phrases of two to four words of each language.

    Texts are cut into pieces at ``.,;:!?`` and line ends, and into words at blanks and tabs,
    with A-Z lower-cased. Candidates are phrases seen ``least`` times in a language. The
    score is 2,000,000 a / (l + r), rounded down, for the worst cut into a first part seen l
    times and a rest seen r times. Candidates inside a longer one that is seen ``percent``
    percent as often or more are left out.
    Columns: lang, rank, phrase, a, l, r, n, score; n counts the language's words.

    Null and empty texts have no words; a null language is ``und``. Repeated rows count
    each time. Equal scores are ranked by a, then by the phrase's bytes. A very long text is
    cut where a piece ends, into parts of about 1 MB; one piece without an end is held whole.
    Ids are 64 bits wide; that no frequent word shares its id with any word is counted, with
    another seed if one does. An empty table, and a language without candidates,
    give no rows. Further columns are not read, whatever their names.
    """
    plain = docs.select(F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"))
    parts = plain.mapInArrow(_counted(SLICE_BYTES, WORDS_HELD), COUNTS)
    counted = staged(parts.groupBy("lang", "word").agg(F.sum("count").alias("f")), "words")
    totals = staged(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    seed, frequent = _identify(counted, least)
    zero = F.lit(0).cast("long")
    found = frequent.select(F.col("id").alias("a"), zero.alias("b"), zero.alias("c"), zero.alias("d"), "f")
    runs = found.withColumn("n", F.lit(1))
    for n in range(2, LONGEST + 1):
        sieve = _sieve(found, n - 1)
        found = staged(run_counts(plain, n, seed, total, least, sieve), f"runs{n}")
        sieve.destroy()
        runs = runs.unionByName(found.withColumn("n", F.lit(n)))
    alone = standing_alone(runs.filter("n > 1"), percent=percent).select(*NAMES)
    kept = staged(scored(runs).join(alone, NAMES), "scored")
    # Words again, in their order.
    ids = kept.select("*", F.posexplode(F.array(*NAMES)).alias("at", "id")).filter("id <> 0")
    phrases = (
        ids.join(frequent.select("id", "word", "lang"), "id")
        .groupBy(*NAMES, "f", "l", "r", "score", "lang")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
        .select("lang", F.array_join("w.word", " ").alias("phrase"), F.col("f").alias("a"), "l", "r", "score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    best = phrases.withColumn("salt", salt).withColumn("place", first).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = best.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
