"""Draw documents whose words are distributed like those of a target corpus.

Features are runs of words, hashed into buckets by CRC-32. A document is scanned once,
with single blanks between its words, and the running CRC is kept at every word's end.
The CRC of any run then comes from two of these prefixes: that before the run, shifted by
the run's length in GF(2), cancels out of that at its end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.llm.common import numbered, staged

# Fixed values of the registered query.
LOW, HIGH = 1, 1
BUCKETS = 10_000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10

# Words that a task holds at a time.
SLICE = 1 << 18

COUNTS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("count", T.LongType())])
WEIGHED = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())]
)


def kernel(low: int = LOW, high: int = HIGH, buckets: int = BUCKETS, slice_words: int = SLICE) -> SimpleNamespace:
    """The functions that run inside tasks on many texts at a time.

    Words are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased;
    null has none.
    """
    import numpy as np

    u = np.uint32
    byte = np.arange(256, dtype=u)
    step = byte.copy()
    for _ in range(8):
        step = np.where(step & u(1), (step >> u(1)) ^ u(0xEDB88320), step >> u(1))

    def apply(table, c):
        return table[0][c & u(255)] ^ table[1][(c >> u(8)) & u(255)] ^ table[2][(c >> u(16)) & u(255)] ^ table[3][c >> u(24)]

    # shifts[k] lets 2^k zero bytes follow, as four tables, one for each byte of the CRC.
    first = [byte << u(8 * j) for j in range(4)]
    shifts = [[step[c & u(255)] ^ (c >> u(8)) for c in first]]

    def shifted(c, lengths):
        """CRCs after as many zero bytes as ``lengths`` says."""
        k, left = 0, lengths
        while left.any():
            if k == len(shifts):
                shifts.append([apply(shifts[-1], c) for c in shifts[-1]])
            c = np.where(left & 1, apply(shifts[k], c), c)
            left, k = left >> 1, k + 1
        return c

    lowered = bytearray(b" " * 128 + bytes(range(128, 256)))
    lowered[48:58] = bytes(range(48, 58))
    lowered[97:123] = lowered[65:91] = bytes(range(97, 123))
    lowered = bytes(lowered)

    def parts(text):
        """Words of a text, a slice of it at a time."""
        data = text.encode().translate(lowered)
        at = 0
        while at < len(data):
            to = data.find(b" ", at + 8 * slice_words)
            to = len(data) if to < 0 else to
            yield data[at:to].split()
            at = to

    def scan(texts: list[str | None]):
        """(text, bucket) of all features and the text of each word, as arrays per slice.

        One running CRC goes through all texts, each word led by a blank; runs that would
        reach over two texts are left out.
        """
        from itertools import accumulate
        from zlib import crc32

        blank = u(crc32(b" "))
        keep = high - 1
        before = ends = np.zeros(0, u)
        lengths, home = np.zeros(0, np.int64), np.zeros(0, np.int64)
        last, held, of, count = 0, [], [], 0

        def settle():
            nonlocal before, ends, lengths, home, last
            running = np.fromiter(
                accumulate(held, lambda c, word: crc32(word, crc32(b" ", c)), initial=last), u, len(held) + 1
            )
            last = int(running[-1])
            # The prefix up to and with the blank before each word.
            led = step[running[:-1] & u(255)] ^ (running[:-1] >> u(8)) ^ blank
            old = len(before)
            before, ends = np.concatenate([before, led]), np.concatenate([ends, running[1:]])
            lengths = np.concatenate([lengths, np.fromiter(map(len, held), np.int64, len(held))])
            new = np.repeat(np.array([n for n, _ in of], np.int64), [m for _, m in of])
            home = np.concatenate([home, new])
            total = np.concatenate([[0], np.cumsum(lengths + 1)])
            texts_of, found = [], []
            for n in range(low, high + 1):
                # Runs whose last word is new, within one text.
                a = np.arange(max(0, old - n + 1), len(home) - n + 1)
                a = a[home[a] == home[a + n - 1]]
                size = total[a + n] - total[a] - 1
                found.append((ends[a + n - 1] ^ shifted(before[a], size)).astype(np.int64) % buckets)
                texts_of.append(home[a])
            if keep:
                before, ends, lengths, home = before[-keep:], ends[-keep:], lengths[-keep:], home[-keep:]
            else:
                before, ends, lengths, home = before[:0], ends[:0], lengths[:0], home[:0]
            return np.concatenate(texts_of), np.concatenate(found), new

        for n, text in enumerate(texts):
            for words in parts(text or ""):
                held += words
                of.append((n, len(words)))
                count += len(words)
                if count >= slice_words:
                    yield settle()
                    held, of, count = [], [], 0
        if held:
            yield settle()

    return SimpleNamespace(scan=scan, shifted=shifted)


def bucket_counts(texts: DataFrame, text: str = "text", low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, count): features of all texts in each bucket that has any.

    A task adds up its own texts, so at most ``buckets`` rows of each are shuffled.
    """
    k = kernel(low, high, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found, _ in k.scan(batch.column(0).to_pylist()):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "count"])

    counted = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, COUNTS)
    return counted.groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket: floor of 1000 times the log of its smoothed share in the target over that in the source.

    Both tables are ``bucket_counts``; the result has one number per bucket, so its size
    is set by the parameter and not by the data. Without any features all gains are 0.
    """
    held = {r["bucket"]: r["count"] for r in source.collect()}  # at most one row per bucket
    wanted = {r["bucket"]: r["count"] for r in target.collect()}
    S, T_ = sum(held.values()), sum(wanted.values())
    out = []
    for b in range(buckets):
        s, t = held.get(b, 0), wanted.get(b, 0)
        ratio = float(t + 1) * float(S + buckets) / (float(s + 1) * float(T_ + buckets))
        out.append(math.floor(1000.0 * math.log(ratio)))
    return out


def weighed(text: Column, gain: list[int], low: int = LOW, high: int = HIGH) -> Column:
    """Struct of n_words, n_features and weight: the sum of the gains of all features of a text.

    Null, empty and wordless texts give three zeros; a very long text is read a slice at a time.
    """
    k = kernel(low, high, len(gain))

    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        worth = np.array(gain, np.int64)
        for texts in batches:
            n = len(texts)
            sums = np.zeros((3, n), np.int64)
            for home, found, words in k.scan(texts.to_pylist()):
                sums[0] += np.bincount(words, minlength=n)
                sums[1] += np.bincount(home, minlength=n)
                np.add.at(sums[2], home, worth[found])
            yield pa.StructArray.from_arrays([pa.array(s) for s in sums], ["n_words", "n_features", "weight"])

    return F.arrow_udf(weigh, WEIGHED)(text)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of seed and id; a null id counts as ``null``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    low: int = LOW,
    high: int = HIGH,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    Features are all runs of ``low`` to ``high`` words. The score is the weight plus noise;
    of the N documents with at least ``least_words`` words the floor(percent N / 100) with
    the highest scores are drawn, ties to the smaller id, and ranked from 1. Others have no
    rank.

    Null and empty texts have no features, weight 0, and are never drawn. Rows without an
    id share one noise and come before others of their score. Repeated rows are scored
    alike and drawn one by one. A very long text is read in slices. An empty table gives
    no rows; an empty target makes all of its counts 0. Further columns are not read,
    whatever their names.
    """
    gain = gains(bucket_counts(docs, text, low, high, buckets), bucket_counts(target, target_text, low, high, buckets), buckets)
    both = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), weighed(F.col(f"`{text}`"), gain, low, high).alias("w"))
    scored = staged(both.select("doc_id", "w.*").withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weighed")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.filter(able).count() // 100
    placed = numbered(scored.filter(able).withColumn("less", -F.col("score")), ["less", "doc_id"], "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    out = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*out, rank.alias("rank")).unionByName(
        scored.filter(~able).select(*out, F.lit(None).cast("long").alias("rank"))
    )


def sample(docs: DataFrame, drawn: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that ``resampled`` drew, with all their columns.

    Rows that repeat an id are taken together; rows without an id are left out.
    """
    ids = drawn.filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(ids, F.col(f"`{doc_id}`") == F.col("__drawn"), "left_semi")
