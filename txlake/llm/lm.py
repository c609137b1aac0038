"""Language-model scores by a weighted backoff automaton."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.llm import words
from txlake.llm.common import compressed, staged
from txlake.session import scratch
from txlake.sources import fs

HELD_OUT_OF, HELD_OUT = 7, 2

# Pairs and triples seen at least so often are arcs, and states if an arc starts there.
LEAST = 2
DISCOUNT = 0.5

# Text of a block in bytes: what one task scores with the block's own dictionary. A longer
# text is a block of its own.
BLOCK_BYTES = 8 << 20

# Passes in which the n-grams of each size are counted, and in which blocks are scored, one
# after another: the disk holds the shuffle of one pass.
COUNT_PASSES = {1: 1, 2: 1, 3: 1}
SCORE_PASSES = 6

# Passes, by the key of the first words, in which the arcs of each size are joined together.
ARC_PASSES = {2: 1, 3: 2}

# Bits of the table that rules out n-grams with rare parts, in units of 32,768 bits (16 MB in
# all). A larger corpus fills it up and then it rules out less; it never rules out too much.
SIEVE_UNITS = 4096

# Rows of n-grams that a task counts before it sends them off.
HELD_GRAMS = 3_000_000

# The key of an n-gram is that of its first words, xor that of its last ones turned by so
# many bits; the key of a word is its number.
TURNS = {2: 21, 3: 10}

GRAMS = T.StructType([T.StructField(n, T.LongType()) for n in ("size", "g", "a", "c")])
COUNTED = T.StructType(
    [T.StructField("range", T.LongType()), *[T.StructField(n, T.BinaryType()) for n in ("g", "a", "c")]]
)
KEYS = T.StructType([T.StructField(n, T.LongType()) for n in ("range", "block")] + [T.StructField("g", T.BinaryType())])
# The values are the weights and then the fails of the keys in their order, compressed.
FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("block", "range")] + [T.StructField("values", T.BinaryType())])
RANGES = T.StructType([T.StructField("range", T.LongType()), *[T.StructField(n, T.BinaryType()) for n in ("g", "values")]])

# Text in bytes for which n-grams get one more range of keys, each merged by one task.
RANGE_BYTES = 4 << 20


def _staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    with compressed(df.sparkSession):
        return staged(df, name, path)


def _end(k) -> int:
    """The number of the end token, which is no word's text."""
    return int(k.mix(np.array([0x5EED], np.uint64))[0].astype(np.int64))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == HELD_OUT


def _tokens():
    """Function: (number of each token, tokens of each text); an end follows each text."""
    k = words.kernel()
    end = _end(k)

    def tokens(texts):
        import numpy as np

        for offsets, data in k.slices(texts):
            numbers, counts = k.words(offsets, data)
            ends = np.cumsum(counts)
            yield np.insert(numbers.view(np.int64), ends, end), counts + 1

    return tokens


def _keys():
    """Function: the keys of the words, pairs and triples of some texts, and whether each
    pair and triple lies within one text (a pair stands where its first word stands)."""
    turns = dict(TURNS)

    def keys(numbers, sizes):
        import numpy as np

        def joined(first, last, size):
            r = turns[size]
            return first ^ ((last << np.uint64(r)) | (last >> np.uint64(64 - r)))

        one = numbers.view(np.uint64)
        text = np.repeat(np.arange(len(sizes)), sizes)
        two = joined(one[:-1], one[1:], 2)
        three = joined(two[:-1], two[1:], 3)
        inside = text[1:] == text[:-1]
        return text, one, two, inside, three, inside[1:] & inside[:-1]

    return keys


def _sieve(grams: DataFrame) -> Broadcast:
    """Bits of the keys of all given n-grams, compressed: ``SIEVE_UNITS`` rows of 4 KB at most,
    whatever the table holds. Sent to each executor once; the caller destroys it."""
    bit = F.pmod(F.col("g"), F.lit(SIEVE_UNITS * 32768))
    units = grams.groupBy(F.floor(bit / 32768).alias("unit")).agg(F.bitmap_construct_agg(bit % 32768).alias("data"))
    table = np.zeros((SIEVE_UNITS, 4096), np.uint8)
    for r in units.collect():
        table[r["unit"], : len(r["data"])] = np.frombuffer(bytes(r["data"]), np.uint8)
    return grams.sparkSession.sparkContext.broadcast(zlib.compress(table.tobytes(), 1))


def _sifter(sieve: Broadcast):
    """Function made inside a task: which keys may be among those of the sieve."""
    units = SIEVE_UNITS

    def make():
        import zlib

        import numpy as np

        table = np.frombuffer(zlib.decompress(sieve.value), np.uint8)

        def may_be(g):
            bit = g % np.uint64(units * 32768)
            return (table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

        return may_be

    return make


def _firsts():
    """Function: where each key of a sorted array stands first."""

    def firsts(g):
        import numpy as np

        new = np.ones(len(g), bool)
        np.not_equal(g[1:], g[:-1], out=new[1:])
        return new

    return firsts


def _values():
    """Functions: weights and fails to compressed bytes, and those of some keys back."""

    def pack(weight, fail):
        import numpy as np
        import pyarrow as pa

        return pa.compress(np.concatenate([weight, fail]).tobytes(), codec="zstd", asbytes=True)

    def unpack(blob, keys):
        import numpy as np
        import pyarrow as pa

        return np.frombuffer(pa.decompress(blob, decompressed_size=16 * keys, codec="zstd"), np.float64).reshape(2, keys)

    return pack, unpack


def _ranged():
    """Function: (range, from, to) of sorted keys that are cut into equal ranges by their upper bits."""

    def ranged(g, ranges):
        import numpy as np

        part = ((g >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        starts = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
        return list(zip(part[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(g)]))

    return ranged


def _range_of(ranges: int) -> Column:
    """The same range of a key column."""
    return F.shiftright(F.shiftrightunsigned("g", 32) * F.lit(ranges), 32)


def _count_grams(size: int, turn: int, passes: int, ranges: int, sieve: Broadcast | None):
    """N-grams of one size and pass, counted for each task: sorted arrays of key, key of the
    first words and count for each range of keys.

    Only those whose two parts, one word shorter, may be in the sieve.
    """
    ranged, firsts = _ranged(), _firsts()
    tokens, keys, make = _tokens(), _keys(), sieve and _sifter(sieve)
    most = HELD_GRAMS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        may_be = make() if make else None
        held, rows = [], 0

        def flush():
            if not held:
                return
            g, a = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            # A word is its own first part.
            order = np.argsort(g) if size > 1 else None
            g = g[order] if size > 1 else np.sort(g)
            first = np.flatnonzero(firsts(g))
            c = np.diff(first, append=len(g))
            g, a = g[first], a[order[first]] if size > 1 else g[first]
            cut = ranged(g, ranges)
            for i in range(0, len(cut), 64):
                some = cut[i : i + 64]
                blobs = [pa.array([x[b:e].tobytes() for _, b, e in some], pa.binary()) for x in (g, a, c)]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _, _ in some], pa.int64()), *blobs], names=["range", "g", "a", "c"])

        for batch in batches:
            for numbers, sizes in tokens(batch.column("text")):
                _, one, two, inside2, three, inside3 = keys(numbers, sizes)
                whole = {1: one, 2: two, 3: three}[size]
                now = whole % np.uint64(passes) == turn
                shorter = whole
                if size > 1:
                    now &= inside2 if size == 2 else inside3
                    shorter = one if size == 2 else two
                now = np.flatnonzero(now)
                if may_be is not None:
                    now = now[may_be(shorter[now])]
                    now = now[may_be(shorter[now + 1])]
                held.append((whole[now], shorter[now]))
                rows += len(now)
                if rows > most:
                    yield from flush()
                    rows = 0
        yield from flush()

    return count


def _merge_grams(size: int, least: int):
    """Arrow function: the counts of one range from all tasks to the n-grams seen often enough."""

    def merge(table: pa.Table) -> pa.Table:
        import numpy as np

        whole = lambda name, kind: np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])
        g, a, c = whole("g", np.uint64), whole("a", np.int64), whole("c", np.int64)
        order = np.argsort(g, kind="stable")
        g = g[order]
        first = np.flatnonzero(np.diff(g, prepend=g[:1] + np.uint64(1)))
        total = np.add.reduceat(c[order], first)
        often = total >= least
        first = first[often]
        columns = [np.full(len(first), size), g[first].view(np.int64), a[order][first], total[often]]
        return pa.table([pa.array(x) for x in columns], names=["size", "g", "a", "c"])

    return merge


def _packed():
    """Arrow function: the rows of the automaton of one range as arrays in the order of keys."""
    pack, _ = _values()

    def packed(range_: tuple, table: pa.Table) -> pa.Table:
        import numpy as np

        g = table.column("g").to_numpy().view(np.uint64)
        order = np.argsort(g)
        values = pack(*(table.column(n).to_numpy()[order] for n in ("weight", "fail")))
        return pa.table([pa.array([range_[0].as_py()], pa.int64()), *(pa.array([v], pa.binary()) for v in (g[order].tobytes(), values))], names=["range", "g", "values"])

    return packed


def _look_up():
    """Cogrouped function: of one range, what the automaton holds for each block's keys, in their
    order. The weight of a key that it lacks is not a number."""
    pack, unpack = _values()

    def look_up(keys: pa.Table, automaton: pa.Table) -> pa.Table:
        import numpy as np

        known = np.frombuffer(automaton.column("g")[0].as_py(), np.uint64) if automaton.num_rows else np.zeros(0, np.uint64)
        weights, fails = unpack(automaton.column("values")[0].as_py(), len(known)) if automaton.num_rows else np.zeros((2, 0))
        out = []
        for blob in keys.column("g"):
            g = np.frombuffer(blob.as_py(), np.uint64)
            place = np.searchsorted(known, g)
            has = place < len(known)
            has[has] = known[place[has]] == g[has]
            weight, fail = np.full(len(g), np.nan), np.zeros(len(g))
            weight[has], fail[has] = weights[place[has]], fails[place[has]]
            out.append(pack(weight, fail))
        return pa.table([keys.column("block"), keys.column("range"), pa.array(out, pa.binary())], names=["block", "range", "values"])

    return look_up


def _block_numbers(block_bytes: int):
    """Arrow function: the block of each text, by the bytes that a task has met so far."""

    def number(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        from pyspark import TaskContext

        part, met = TaskContext.get().partitionId() << 33, 0
        for sizes in batches:
            n = sizes.to_numpy(zero_copy_only=False).astype(np.int64)
            ends = met + np.cumsum(n)
            # A text belongs where it begins, so a block is a text too long at most.
            yield pa.array(part + (ends - n) // block_bytes)
            met = int(ends[-1]) if len(ends) else met

    return F.arrow_udf(number, T.LongType())


def _wanted(sieve: Broadcast):
    """Function made inside a task: for each slice of some texts, tokens of each text, where the
    pairs and triples stand that may be in the sieve, the sorted distinct keys of the words and
    of these, and, if ``places``, the place of each one's key among them."""
    firsts = _firsts()
    tokens, keys, make = _tokens(), _keys(), _sifter(sieve)

    def ready():
        import numpy as np

        may_be = make()

        def wanted(texts, places):
            for numbers, sizes in tokens(texts):
                _, one, two, inside2, three, inside3 = keys(numbers, sizes)
                at2, at3 = np.flatnonzero(inside2), np.flatnonzero(inside3)
                at2, at3 = at2[may_be(two[at2])], at3[may_be(three[at3])]
                every = np.concatenate([one, two[at2], three[at3]])
                if not places:
                    g = np.sort(every)
                    yield sizes, at2, at3, g[firsts(g)], None
                    continue
                order = np.argsort(every)
                g = every[order]
                new = firsts(g)
                place = np.empty(len(g), np.int32 if len(g) < 1 << 31 else np.int64)
                place[order] = np.cumsum(new) - 1
                yield sizes, at2, at3, g[new], place

        return wanted

    return ready


def _pass_of(block: str, passes: int) -> Column:
    """The pass of a block: the blocks of a task follow each other, and so go to all passes alike."""
    task, inside = F.shiftright(block, 33), F.col(block).bitwiseAND(F.lit((1 << 33) - 1))
    return F.pmod(task + inside, F.lit(passes))


def _block_keys(ranges: int, sieve: Broadcast):
    """The keys of each block's words, and of its pairs and triples that may be in the sieve, as
    one sorted array for each range of keys."""
    ranged, firsts, ready = _ranged(), _firsts(), _wanted(sieve)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        wanted = ready()

        def flush(block, parts):
            g = np.sort(np.concatenate(parts))
            g = g[firsts(g)]
            cut = ranged(g, ranges)
            for i in range(0, len(cut), 64):
                some = cut[i : i + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r for r, _, _ in some], pa.int64()),
                        pa.array([block] * len(some), pa.int64()),
                        pa.array([g[b:e].tobytes() for _, b, e in some], pa.binary()),
                    ],
                    names=["range", "block", "g"],
                )

        block, parts = None, []
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if a == b:
                    continue
                if block is not None and blocks[a] != block:
                    yield from flush(block, parts)
                    parts = []
                block = blocks[a]
                parts += [g for *_, g, _ in wanted(batch.column("text").slice(a, b - a), False)]
        if parts:
            yield from flush(block, parts)

    return find


def _last(size: int) -> Column:
    """The key of an n-gram's last words, from its own and that of its first words."""
    x, r = F.col("g").bitwiseXOR(F.col("a")), TURNS[size]
    return F.shiftrightunsigned(x, r).bitwiseOR(F.shiftleft(x, 64 - r))


def _automaton(words_: DataFrame, grams: dict[int, DataFrame], total: int, distinct: int, folders: dict[int, list[str]]) -> DataFrame:
    """Rows (g, weight, fail) of all words, pairs and triples.

    The weight of a word is its count, that of an arc its log10 probability by absolute
    discounting. ``fail`` weighs the step from a state to the next shorter one: it shares
    what the state's arcs leave (0 where there is no state). ``folders`` names those of the
    n-grams of each size: a size's folders go as soon as its arcs are written, the folders
    that the result reads are left in it.
    """
    level = words_.select("g", "c", ((F.col("c") + 1) / F.lit(total + distinct + 1.0)).alias("p"))
    weight, out, spark = F.col("c").cast("double"), [], words_.sparkSession
    rest = lambda c: F.greatest(1 - F.sum(c), F.lit(1e-12))
    for size in TURNS:
        # What is seen once can be no part of an arc, and so no state.
        rare, level = level.filter(F.col("c") < LEAST), level.filter(F.col("c") >= LEAST)
        if size == 2:
            out.append(rare.select("g", weight.alias("weight"), F.lit(0.0).alias("fail")))
        first = level.select(F.col("g").alias("a"), F.col("c").alias("of"))
        last = level.select(F.col("g").alias("b"), F.col("p").alias("lower"))
        arcs = grams[size].withColumn("b", _last(size)).join(first, "a").join(last, "b")
        arcs = arcs.select("g", "a", "c", ((F.col("c") - F.lit(DISCOUNT)) / F.col("of")).alias("p"), "lower")
        paths, passes = [], ARC_PASSES[size]
        for turn in range(passes):
            paths.append(scratch(spark, "arcs"))
            _staged(arcs.filter(F.pmod("a", F.lit(passes)) == turn), "arcs", paths[-1])
        arcs = spark.read.schema(arcs.schema).parquet(*paths)
        _delete(spark, folders[size])
        fails = arcs.groupBy(F.col("a").alias("g")).agg(F.log10(rest("p") / rest("lower")).alias("fail"))
        found = level.join(fails, "g", "left").select("g", weight.alias("weight"), F.coalesce("fail", F.lit(0.0)).alias("fail"))
        # Each level is written by itself: the disk holds the shuffle of one.
        kept = scratch(spark, "automaton")
        out.append(_staged(found, "automaton", kept))
        if size > 2:
            # The arcs of the size before are in the automaton now.
            _delete(spark, folders[size - 1])
        folders[size] = paths
        folders.setdefault(0, []).append(kept)
        level, weight = arcs.select("g", "c", "p"), F.log10("p")
    out.append(level.select("g", weight.alias("weight"), F.lit(0.0).alias("fail")))
    return reduce(DataFrame.unionByName, out)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    while paths:
        fs.delete_folder(spark, paths.pop())


def _scorer(total: int, distinct: int, ranges: int, sieve: Broadcast):
    """Cogrouped function: scores of a block's documents with the block's part of the automaton.

    The keys of the block are found once more; the values came in their order.
    """
    ranged, firsts, ready, (_, unpack) = _ranged(), _firsts(), _wanted(sieve), _values()
    made = []

    def score(docs: pa.Table, dictionary: pa.Table) -> pa.Table:
        import numpy as np

        if not made:
            made.append(ready())
        slices = list(made[0](docs.column("text"), True))
        known = np.sort(np.concatenate([g for *_, g, _ in slices]))
        known = known[firsts(known)]
        cut = ranged(known, ranges)
        order = np.argsort(dictionary.column("range").to_numpy())
        if dictionary.column("range").to_numpy()[order].tolist() != [r for r, _, _ in cut]:
            raise ValueError("the ranges looked up are not those of the block's keys")
        weights, fails = np.empty(len(known)), np.empty(len(known))
        for (_, b, e), i in zip(cut, order.tolist(), strict=True):
            weights[b:e], fails[b:e] = unpack(dictionary.column("values")[i].as_py(), e - b)

        n_tokens, n_known, base, full = [], [], [], []
        for sizes, at2, at3, g, place in slices:
            of_slice = np.searchsorted(known, g)
            weight, fail = weights[of_slice][place], fails[of_slice][place]
            has = ~np.isnan(weight)
            text = np.repeat(np.arange(len(sizes)), sizes)
            inside2 = text[1:] == text[:-1]
            one, two = len(text), len(text) + len(at2)

            def look(part, ends):
                """(found, weight, fail) for each token, of the n-gram that ends there."""
                found, weight_, fail_ = np.zeros(len(text), bool), np.zeros(len(text)), np.zeros(len(text))
                found[ends] = has[part]
                weight_[ends] = np.where(has[part], weight[part], 0.0)
                fail_[ends] = fail[part]
                return found, weight_, fail_

            has1, count, fail1 = look(slice(0, one), slice(None))
            has2, weight2, fail2 = look(slice(one, two), at2 + 1)
            has3, weight3, _ = look(slice(two, None), at3 + 2)
            single = np.log10((count + 1.0) / (total + distinct + 1.0))
            # Follow the arc of the longest state; where there is none, fail to the next.
            after1, after2 = np.zeros(len(text)), np.zeros(len(text))
            after1[1:] = np.where(inside2, fail1[:-1], 0.0)
            after2[1:] = np.where(inside2, fail2[:-1], 0.0)
            weight = np.where(has2, weight2, after1 + single)
            weight = np.where(has3, weight3, after2 + weight)
            n = len(sizes)
            n_tokens.append(sizes)
            n_known.append(np.bincount(text, has1, n).astype(np.int64))
            base.append(np.bincount(text, single, n))
            full.append(np.bincount(text, weight, n))
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": join(n_tokens, pa.int64()),
                "n_known": join(n_known, pa.int64()),
                "train_tokens": pa.array(np.full(docs.num_rows, total), pa.int64()),
                "base_score": join(base, pa.float64()),
                "score": join(full, pa.float64()),
            }
        )

    return score


def language_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = 0.0) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from documents with crc32(doc_id) mod 7 other than 2 (a null id is
    empty text). Tokens are words (A-Z lower-cased) and one end for each document.
    base_score sums log10((c + 1) / (N + V + 1)); score is the log10 probability under
    the automaton: arcs for all words and for the pairs and triples seen at least twice,
    weighed by absolute discounting, with failure arcs to shorter states
    and the base distribution at the root. The state after a token is the longest state
    that ends there, so a text is traversed once.

    A caller may leave out pairs and triples that make up less than ``share`` of all
    tokens; by default none is.

    Counts are exact, over all documents, and the automaton is a table. A pair can only be
    seen twice if both of its words are, and a triple if both of its pairs are: a bit table
    of the shorter ones keeps most of the others from being shuffled. Each block of documents
    gets the values of its own n-grams, without their keys, which it finds again in the same
    order, so no task holds the vocabulary; the driver holds totals and the bit table. Null and empty texts have one token, the end. Repeated rows are
    rows of their own; an empty table gives no rows. Further columns are not read. A block
    holds ``BLOCK_BYTES`` of text, or one longer text, which its task holds whole, with
    some hundred times its bytes.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    blocked = _staged(
        docs.select(
            _block_numbers(BLOCK_BYTES)(F.octet_length(whole)).alias("block"),
            F.col(doc_id).alias("doc_id"),
            held_out(F.col(doc_id)).alias("held_out"),
            whole.alias("text"),
        ),
        "blocks",
    )
    learned = blocked.filter(~F.col("held_out")).select("text")
    spark = docs.sparkSession
    size_ = blocked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(max(1, -(-size_ // RANGE_BYTES)), 1 << 31)
    levels, sieve, folders = {}, None, {}
    for size, passes in COUNT_PASSES.items():
        least, counts = 1 if size == 1 else LEAST, []
        for turn in range(passes):
            path = scratch(spark, f"grams{size}")
            folders.setdefault(size, []).append(path)
            cut = learned.mapInArrow(_count_grams(size, turn, passes, ranges, sieve), COUNTED)
            found = cut.groupBy("range").applyInArrow(_merge_grams(size, least), GRAMS)
            counts.append(_staged(found.select("g", "c") if size == 1 else found, "grams", path))
        levels[size] = reduce(DataFrame.unionByName, counts)
        if sieve:
            sieve.destroy()
        sieve = _sieve(levels[size].filter(F.col("c") >= LEAST)) if size < max(COUNT_PASSES) else None
    vocabulary = levels[1]
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    arcs = {n: levels[n].filter(F.col("c") >= math.ceil(share * total)) for n in TURNS}
    sieve = _sieve(reduce(DataFrame.unionByName, arcs.values()))
    automaton = _automaton(vocabulary, arcs, total, distinct, folders)
    by_range = automaton.groupBy(_range_of(ranges).alias("range"))
    automaton = _staged(by_range.applyInArrow(_packed(), RANGES), "ranges")
    # The automaton is written; what it was made from is not read again.
    for paths in folders.values():
        _delete(spark, paths)

    result = T.StructType(
        [
            T.StructField("doc_id", blocked.schema["doc_id"].dataType),
            T.StructField("held_out", T.BooleanType()),
            *[T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")],
            *[T.StructField(n, T.DoubleType()) for n in ("base_score", "score")],
        ]
    )
    done = []
    for turn in range(SCORE_PASSES):
        some = blocked.filter(_pass_of("block", SCORE_PASSES) == turn)
        wanted = some.select("block", "text").mapInArrow(_block_keys(ranges, sieve), KEYS)
        dictionary = wanted.groupBy("range").cogroup(automaton.groupBy("range")).applyInArrow(_look_up(), FOUND)
        scored = some.groupBy("block").cogroup(dictionary.groupBy("block")).applyInArrow(_scorer(total, distinct, ranges, sieve), result)
        done.append(_staged(scored, "scores"))
    sieve.destroy()
    return reduce(DataFrame.unionByName, done)
