"""Quality classifier: a linear model on n-gram indicators scaled by class ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.llm import words
from txlake.llm.common import fresh

# Labelled rows that the model is fitted on, for each class at most (by hash of the id).
TRAINING_ROWS = 3000

BUCKETS = 1 << 16
THRESHOLD = 0.3
HELD_OUT_OF = 5
SMOOTHING = 1.0
PENALTY = 1.0
EPOCHS = 12


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of each bucket, ratio and linear weight multiplied
    scale: np.ndarray  # squared ratio of each bucket, for the length of a document
    bias: float
    slope: float
    offset: float


def _grams():
    """Function: the buckets of each text of an Arrow array, sorted and distinct.

    N-grams of two kinds, each hashed into the buckets: runs of two to four bytes, and
    runs of three words by whether each repeats the word before it or the one before that.
    """
    k = words.kernel()

    def grams(texts: pa.Array):
        import numpy as np

        u = np.uint64
        last = u(64 - (BUCKETS.bit_length() - 1))
        odd = [u(0x9E3779B97F4A7C15), u(0xC2B2AE3D27D4EB4F), u(0x165667B19E3779F9), u(0xD6E8FEB86659FD93)]
        for offsets, raw in k.slices(texts):
            numbers, counts = k.words(offsets, raw)
            same = np.zeros(len(numbers), np.int64)
            if len(numbers) > 2:
                same[2:] = (numbers[2:] == numbers[1:-1]) + 2 * (numbers[2:] == numbers[:-2])
            ends = np.cumsum(counts)
            for i in range(len(counts)):
                flags = np.zeros(BUCKETS, bool)
                data = raw[offsets[i] : offsets[i + 1]].astype(u)
                h = data * odd[0]
                for n in range(1, min(4, len(data))):
                    h = (h[:-1] ^ (h[:-1] >> u(29))) * odd[n] + data[n:] * odd[0]
                    g = h * odd[3]
                    flags[(g ^ (g >> u(32))) * odd[1] >> last] = True
                if counts[i] > 4:
                    run = same[ends[i] - counts[i] + 2 : ends[i]]
                    codes = np.unique(run[:-2] * 16 + run[1:-1] * 4 + run[2:])
                    flags[codes[codes > 0] * 40503 % BUCKETS] = True
                yield np.flatnonzero(flags)

    return grams


def _indicators():
    grams = _grams()

    def indicators(texts: pa.Array) -> pa.Array:
        # Two bytes a bucket: what reaches the driver stays small.
        return pa.array([g.astype("<u2").tobytes() for g in grams(texts)], pa.binary())

    return F.arrow_udf(indicators, T.BinaryType())


def held_out(doc_id: Column, of: int = HELD_OUT_OF) -> Column:
    """Rows that no label is learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of == 0


def _solve(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear hinge loss (L2 penalty) by dual coordinate descent, one row at a time.

    Rows have length one; classes weigh alike. Returns weights of the scaled indicators
    and the bias.
    """
    rng = np.random.default_rng(7)
    weights, bias = np.zeros(BUCKETS), 0.0
    sides = np.where(labels == 1, 1.0, -1.0)
    share = np.where(labels == 1, max(1, (labels == 1).sum()), max(1, (labels == 0).sum()))
    upper = PENALTY * len(labels) / (2.0 * share)
    values = []
    for g in rows:
        x = ratio[g].astype(np.float32)
        norm = np.sqrt((x * x).sum())
        values.append(x / norm if norm > 0 else x)
    alpha = np.zeros(len(rows))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            g, x, y = rows[i], values[i], sides[i]
            slope = y * (weights[g] @ x + bias) - 1.0
            new = min(max(alpha[i] - slope / ((x @ x) + 1.0), 0.0), upper[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                weights[g] += step * x
                bias += step
                alpha[i] = new
    return weights, bias


def _calibrate(margins: np.ndarray, labels: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, rows weighed by their share."""
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = share * (p - labels)
        w = share * p * (1 - p) + 1e-9
        grad = np.array([(g * margins).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum()]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most: int = TRAINING_ROWS
) -> Model | None:
    """Fit on a sample of at most about ``most`` rows of each class that aren't held out.

    Indicators are scaled by the logarithm of the ratio of their smoothed shares in the
    two classes; dual coordinate descent finds the weights; a logistic curve, with rows
    weighed by how many labelled rows they stand for, makes margins probabilities. None
    if there is no row of one class. Null labels and ids are left out; of repeated
    labels of an id one is taken.
    """
    known = (
        labels.select(F.col(doc_id).alias("__id"), F.col(label).alias("__label"))
        .filter(F.col("__id").isNotNull() & F.col("__label").isin(0, 1) & ~held_out(F.col("__id")))
    )
    counts = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    if len(counts) < 2:
        return None
    million = 1_000_000
    part = {c: min(million, max(1, int(million * most / n))) for c, n in counts.items()}
    drawn = F.pmod(F.xxhash64("__id"), F.lit(million)) < F.when(F.col("__label") == 1, part[1]).otherwise(part[0])
    # At most about two times `most` rows.
    few = known.filter(drawn).dropDuplicates(["__id"])
    rows = (
        docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
        .join(F.broadcast(few), "__id")
        .select("__id", "__label", _indicators()("__text").alias("g"))
        .dropDuplicates(["__id"])
        .collect()
    )
    rows.sort(key=lambda r: r["__id"])
    grams = [np.frombuffer(r["g"], "<u2") for r in rows]
    y = np.array([r["__label"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    seen = [np.full(BUCKETS, SMOOTHING) for _ in range(2)]
    for g, c in zip(grams, y, strict=True):
        seen[c][g] += 1
    ratio = np.log(seen[1] / ((y == 1).sum() + 2 * SMOOTHING)) - np.log(seen[0] / ((y == 0).sum() + 2 * SMOOTHING))
    weights, bias = _solve(grams, y, ratio)
    scale = ratio * ratio
    margins = np.array([_margin(g, weights * ratio, scale, bias) for g in grams])
    share = np.array([counts[c] / (y == c).sum() for c in y], float)
    # Rows beyond the margin were pushed there by the fit; the curve takes them as on it.
    slope, offset = _calibrate(np.clip(margins, -1.0, 1.0), y, share / share.sum() * len(y))
    return Model(weights * ratio, scale, bias, slope, offset)


def _margin(g, weights, scale, bias) -> float:
    norm = float(np.sqrt(scale[g].sum()))
    return (float(weights[g].sum()) / norm if norm > 0 else 0.0) + bias


def score(text: Column, model: Model | None) -> Column:
    """Probability of label 1; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)
    grams = _grams()
    weights, scale, bias, slope, offset = model.weights, model.scale, model.bias, model.slope, model.offset

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        for texts in batches:
            out = []
            for g in grams(texts):
                norm = float(np.sqrt(scale[g].sum()))
                margin = (float(weights[g].sum()) / norm if norm > 0 else 0.0) + bias
                out.append(1.0 / (1.0 + np.exp(-(slope * margin + offset))))
            yield pa.array(out, pa.float64())

    return F.arrow_udf(scores, T.DoubleType())(text)


def accepted(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more; all columns and repeated rows stay."""
    (name,) = fresh(docs, "__score")
    return docs.withColumn(name, score(F.col(text), model)).filter(F.col(name) >= threshold).drop(name)
