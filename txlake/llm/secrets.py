"""Secrets in texts: fixed patterns, and character Markov models for the rest."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import staged

# The base patterns, in the order of their kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
# The same matches, found faster: shorter ones are dropped anyway.
LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"
LONG_HEX = r"[0-9a-f]{24,}"

# Runs of these characters are judged by the models.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
# Shorter than candidates, so that no unknown secret of that length counts as ordinary.
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{8,11}(?![A-Za-z0-9+/_=-])"
LEAST_CANDIDATE = 12

# Digests, which are random by construction, are drawn from about this many documents.
DIGESTS = 20_000
# Weight, in steps, of the plain frequency of characters beside the counted steps.
SMOOTHING = 20.0
# One sample in so many is held out to set the threshold on.
HELD_OUT_OF = 5
# An ordinary run taken for random counts as so many random ones missed.
FALSE_WEIGHT = 10.0
# Log-likelihood ratios of whole runs, in nats, among which the threshold is chosen, and
# the threshold without held-out samples of both sorts.
RATIOS = range(-20, 41)
THRESHOLD = 12.0
# A random run has so many different characters, or half as many as its length; rulers
# and fillers have fewer.
DIFFERENT = 8

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _spans(text: Column, pattern: str, kind: int, least: int, pattern_of_value: int | None = None) -> Column:
    """(start, kind, end) of the matches of a pattern whose value is long enough.

    Built-in functions give the matches and the pieces between them; their lengths in
    characters add up to the places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if pattern_of_value is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(pattern_of_value))
    gaps = F.split(text, pattern, -1)
    parts = F.zip_with(
        F.zip_with(gaps, whole, lambda g, m: F.struct(F.char_length(g).alias("gap"), F.char_length(m).alias("size"))),
        value,
        lambda p, v: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), F.char_length(v).alias("value")),
    )
    found = F.aggregate(
        F.filter(parts, lambda p: p["size"].isNotNull()),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("s")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["size"]).alias("at"),
            F.when(
                p["value"] >= least,
                F.concat(
                    acc["s"],
                    F.array(
                        F.struct(
                            (acc["at"] + p["gap"]).alias("start"),
                            F.lit(kind).alias("kind"),
                            (acc["at"] + p["gap"] + p["size"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["s"])
            .alias("s"),
        ),
        lambda acc: acc["s"],
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def _digest_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in ("assign", "access", "hex", "markov")])
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def _codes(word: Column) -> Column:
    """Places in the alphabet of a run's characters, from 1."""
    return F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _transitions(word: Column) -> Column:
    """Numbers of a run's steps from character to character; 0 stands for its beginning."""
    codes = _codes(word)
    width = len(ALPHABET) + 1
    before = F.concat(F.array(F.lit(0)), F.slice(codes, 1, F.size(codes) - 1))
    return F.zip_with(before, codes, lambda a, b: a * F.lit(width) + b)


def train(docs: DataFrame) -> tuple[list[float], float]:
    """Log-likelihood ratios of all steps between characters, random against ordinary, and
    the ratio of a whole run from which it counts as random.

    Samples of random strings are the secrets that the base patterns find, and digests
    written as hexadecimal and base64 text, in lower case too; both weigh the same. Samples of ordinary
    identifiers are the runs of 8 to 11 characters without what the base patterns find.
    All are taken over all documents, and each different secret once. One different
    sample in five is held out; the threshold is the one with the fewest errors on
    ordinary runs and on random ones cut to the length of the shortest candidate. Only counts reach the driver, three for each of some 4500
    steps and two for each threshold.
    """
    width = len(ALPHABET) + 1
    part = min(1.0, DIGESTS / max(1, docs.count()))
    few = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.lit(int(part * 1_000_000)))
    found = docs.filter(F.col("text").rlike(f"{ASSIGN}|{LONG_ACCESS}|{LONG_HEX}"))
    secret = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(LONG_ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(LONG_HEX), F.lit(0)),
    )
    digest = F.sha2("text", 256)
    drawn = F.array(digest, F.upper(digest), F.base64(F.unhex(digest)), F.lower(F.base64(F.unhex(digest))))
    plain = F.regexp_replace("text", f"{ASSIGN}|{LONG_ACCESS}|{LONG_HEX}", " ")
    samples = (
        found.select(F.lit("secret").alias("sort"), F.explode(secret).alias("run"))
        .filter(F.char_length("run") >= LEAST["assign"])
        .unionByName(few.select(F.lit("digest").alias("sort"), F.explode(drawn).alias("run")))
        .unionByName(docs.select(F.lit("plain").alias("sort"), F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("run")))
    )
    # Each different run is taken apart once.
    samples = samples.withColumn("run", F.regexp_replace("run", r"[^A-Za-z0-9+/_=-]", "_")).groupBy("sort", "run").agg(F.count("*").alias("n"))
    out = F.pmod(F.xxhash64("run"), F.lit(HELD_OUT_OF)) == 0
    samples = staged(samples.withColumn("n", F.when(F.col("sort") == "plain", F.col("n")).otherwise(1)).withColumn("out", out), "samples")
    steps = samples.filter("not out").select("sort", "n", F.explode(_transitions(F.col("run"))).alias("step"))
    rows = steps.groupBy("sort", "step").agg(F.sum("n").alias("n")).collect()
    whole = {sort: sum(r["n"] for r in rows if r["sort"] == sort) for sort in ("secret", "digest", "plain")}
    most = max(whole["secret"], whole["digest"])
    counts: dict = {}
    for r in rows:
        label, weight = (0, 1.0) if r["sort"] == "plain" else (1, most / whole[r["sort"]])
        counts[label, r["step"]] = counts.get((label, r["step"]), 0.0) + weight * r["n"]

    def chances(label: int) -> list[list[float]]:
        """Of each next character: counted steps, smoothed towards the character's own frequency."""
        step = [[counts.get((label, a * width + b), 0) for b in range(width)] for a in range(width)]
        plain = [sum(row[b] for row in step) + 0.5 for b in range(width)]
        whole = sum(plain[1:])
        return [
            [(row[b] + SMOOTHING * plain[b] / whole) / (sum(row) + SMOOTHING) for b in range(width)] for row in step
        ]

    random, ordinary = chances(1), chances(0)
    ratios = [math.log(random[a][b] / ordinary[a][b]) if b else 0.0 for a in range(width) for b in range(width)]
    return ratios, _threshold(samples.filter(F.col("out") & ((F.col("sort") == "plain") | (F.char_length("run") >= LEAST_CANDIDATE))), ratios)


def _ratio(run: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio of a whole run."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    return F.aggregate(
        _transitions(run), F.lit(0.0), lambda acc, step: acc + F.element_at(table, (step + F.lit(1)).cast("int"))
    )


def _threshold(held_out: DataFrame, ratios: list[float]) -> float:
    """The ratio that errs least on held-out samples; of equal ones the middle one."""
    run = F.when(F.col("sort") == "plain", F.col("run")).otherwise(F.substring("run", 1, LEAST_CANDIDATE))
    score = _ratio(run, ratios)
    place = F.greatest(F.least(F.floor(score), F.lit(RATIOS[-1])), F.lit(RATIOS[0] - 1))
    rows = held_out.groupBy((F.col("sort") == "plain").alias("plain"), place.alias("at")).agg(F.count("*").alias("n")).collect()
    whole = {kind: sum(r["n"] for r in rows if r["plain"] == kind) for kind in (True, False)}
    if not whole[True] or not whole[False]:
        return THRESHOLD

    def errors(t: int) -> float:
        false = sum(r["n"] for r in rows if r["plain"] and r["at"] >= t) / whole[True]
        missed = sum(r["n"] for r in rows if not r["plain"] and r["at"] < t) / whole[False]
        return FALSE_WEIGHT * false + missed

    least = min(map(errors, RATIOS))
    best = [t for t in RATIOS if errors(t) == least]
    return float(best[len(best) // 2])


def _random_runs(text: Column, ratios: list[float], threshold: float) -> Column:
    """Spans of the runs that the models hold for random."""
    runs = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    gaps = F.split(text, CANDIDATE, -1)
    parts = F.filter(
        F.zip_with(gaps, runs, lambda g, m: F.struct(F.char_length(g).alias("gap"), F.char_length(m).alias("size"), m.alias("run"))),
        lambda p: p["size"].isNotNull(),
    )
    found = F.aggregate(
        parts,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("s")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["size"]).alias("at"),
            F.when(
                (_ratio(p["run"], ratios) >= threshold)
                & (F.size(F.array_distinct(F.split(p["run"], ""))) >= F.least(F.lit(DIFFERENT), p["size"] / 2)),
                F.concat(
                    acc["s"],
                    F.array(
                        F.struct(
                            (acc["at"] + p["gap"]).alias("start"),
                            F.lit(3).alias("kind"),
                            (acc["at"] + p["gap"] + p["size"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["s"])
            .alias("s"),
        ),
        lambda acc: acc["s"],
    )
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast(SPAN))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float | None = None) -> DataFrame:
    """One row per document with its secrets: (doc_id, base, added), arrays of (start, kind, end).

    ``base`` has the matches of the fixed patterns: kind 0 assign, 1 access, 2 hex, each
    leftmost without overlap within its kind. ``added`` (kind 3) has runs of twelve
    characters and more that lie outside of these and are likelier under the model of
    random strings than under that of ordinary identifiers, by ``threshold`` nats or more
    (by default what errs least on held-out samples), and whose characters differ enough. Places are characters (code points) from 0, ends exclusive; both
    arrays go by start, then kind. Null texts are empty and have none; repeated rows
    give repeated rows; an empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ratios, least = train(docs)
    threshold = least if threshold is None else threshold
    words = F.col("text")
    base = F.sort_array(
        F.concat(
            _spans(words, ASSIGN, 0, LEAST["assign"], 2),
            _spans(words, LONG_ACCESS, 1, LEAST["access"]),
            _spans(words, LONG_HEX, 2, LEAST["hex"]),
        )
    )
    runs = docs.select("doc_id", base.alias("base"), _random_runs(words, ratios, threshold).alias("runs"))
    apart = F.filter(
        "runs",
        lambda c: ~F.exists(F.col("base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    return runs.select("doc_id", "base", apart.alias("added"))


def secret_digests(found: DataFrame) -> DataFrame:
    """The result of ``find_secrets`` as counts, a digest of the base spans and a list of all."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    every = F.sort_array(F.concat("base", "added"))
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_digest_text(F.col("base")), 256).alias("base_sha256"),
        _digest_text(every).alias("spans"),
    )
