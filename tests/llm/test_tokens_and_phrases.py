"""Byte-level BPE, phrase collocations and importance resampling."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import CLASHES, EDGES
from txlake.llm import bpe, load_queries, phrases, resample

RANKS = bpe.vocabulary()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
QUERIES = load_queries()


@pytest.fixture(scope="module")
def documents(ready):
    return ready.read.parquet(f"{brute.FOLDER}/documents.parquet")


# Byte-level BPE


def check_tokens(df, rows):
    coded = bpe.decode(bpe.encode(df.select("doc_id", "text"), RANKS), RANKS)
    got = collections.Counter((r["doc_id"], tuple(r["token_ids"]), bytes(r["decoded"])) for r in coded.collect())
    want = collections.Counter((i, tuple(LIBRARY.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert got == want


def test_tokens_on_edges(edges, nothing):
    check_tokens(edges, [(r[0], r[1]) for r in EDGES])
    assert bpe.encode(nothing, RANKS).count() == 0


def test_tokens_keep_other_columns(edges):
    coded = bpe.encode(edges.withColumn("token_ids", F.lit("old")), RANKS)
    assert set(coded.columns) == {*edges.columns, "token_ids"}
    assert all(r["size"] == "x" for r in coded.select("size").collect())


def test_tokens_of_documents_match_the_library(ready, documents):
    rows = documents.select("doc_id", "text").collect()
    check_tokens(documents, [(r[0], r[1]) for r in rows])
    digests = {r["doc_id"]: r for r in QUERIES["op11_byte_bpe"].run(ready, brute.FOLDER).collect()}
    assert len(digests) == len(rows)
    for i, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        assert digests[i]["n_tokens"] == len(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_tokens_of_random_texts_match_the_library():
    draw = random.Random(7)
    newer = "".join(chr(a) for a, _ in bpe.UNASSIGNED)
    alphabets = ["aab", "abehtion s", "abAB  \n\t's\x1c\x85\xa0  ", "reé日本語😀0١²՘" + newer + " 1a"]
    texts = ["".join(draw.choices(draw.choice(alphabets), k=draw.randint(0, 60))) for _ in range(20_000)]
    encode = bpe.kernel(RANKS).encoder()
    for text, ids in zip(texts, encode(texts)):
        want = LIBRARY.encode_ordinary(text)
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == want, repr(text)


def test_tokens_of_a_vocabulary_with_inverted_ranks():
    """A merge may make a pair of lower rank: then the word goes on with that one."""
    draw = random.Random(3)
    ranks = {bytes([b]): b for b in range(256)}
    tokens = set()
    while len(tokens) < 120:
        tokens.add(bytes(draw.choices(b"abc", k=draw.randint(2, 6))))
    order = sorted(tokens)
    draw.shuffle(order)
    ranks |= {t: 256 + n for n, t in enumerate(order)}
    library = tiktoken.Encoding("inverted", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    replay = bpe.kernel(ranks).replay
    words = ["".join(draw.choices("abc", k=draw.randint(1, 30))) for _ in range(5000)]
    for word, ids in zip(words, replay([w.encode() for w in words])):
        got = [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)]
        assert ranks.get(word.encode()) is not None or got == library.encode_ordinary(word), word


def test_tokens_of_one_match_without_a_break(ready):
    text = "a" * 50_000 + "日本" * 20_000
    df = ready.createDataFrame([(1, text)], "doc_id long, text string")
    check_tokens(df, [(1, text)])


# Collocations


def plain_collocations(rows, least, top, percent=80):
    """rows: (text, lang). Exact, with Python's whole numbers."""
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    counts[lang, tuple(w[i : i + n])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    inside = collections.Counter()
    for (lang, words), a in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                inside[lang, words[i : i + m]] = max(inside[lang, words[i : i + m]], a)
    found = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * inside[lang, words] >= percent * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), l, r))
    out = set()
    for lang, rows_ in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def check_phrases(df, rows, least, top):
    found = phrases.collocations(df, least=least, top=top).collect()
    assert [f for f in found[0].asDict()] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] if found else True
    assert sorted(map(tuple, found)) == sorted(plain_collocations(rows, least, top))


def test_phrase_jobs_are_small():
    """What travels to the tasks holds no tables of the numbering."""
    from pyspark import cloudpickle

    assert len(cloudpickle.dumps(phrases._identified(1))) < 1 << 20


def test_phrases_on_edges(edges, nothing):
    check_phrases(edges, [(r[1], r[2]) for r in EDGES], 2, 50)
    assert phrases.collocations(nothing).count() == 0


def test_phrases_of_documents(documents, monkeypatch):
    rows = [(r[0], r[1]) for r in documents.select("text", "lang").collect()]
    check_phrases(documents, rows, 3, 40)
    # Many blocks, small filters and several ranges give the same.
    monkeypatch.setattr(phrases, "SLICE_BYTES", 2_000)
    monkeypatch.setattr(phrases, "WORDS_HELD", 300)
    monkeypatch.setattr(phrases, "FILTER_ENTRIES", 500)
    monkeypatch.setattr(phrases, "MERGE_ENTRIES", 10_000)
    check_phrases(documents, rows, 3, 40)


def test_phrases_ties_and_overlaps(ready):
    rows = [("a a a a a, b c! B C\tb c\x0bé ü é ü", None)] * 3 + [("x y z. x y z; x y q", "en"), ("x y z\x1cw", "en")] * 2
    df = ready.createDataFrame([(n, *r) for n, r in enumerate(rows)], "rank long, text string, lang string")
    check_phrases(df, rows, 2, 5)


def test_permutation_is_invertible():
    import numpy as np

    turn = phrases.permutation()
    for n in range(1, 5):
        lanes = [np.arange(1000, dtype=np.uint64) ** np.uint64(i) for i in range(n)]
        there = turn.forward(lanes)
        assert all((a == b).all() for a, b in zip(turn.backward(there), lanes))
        assert len(set(zip(*(x.tolist() for x in there)))) == len(set(zip(*(x.tolist() for x in lanes))))


def test_words_that_share_an_id_get_another_seed(ready, monkeypatch):
    counted = ready.createDataFrame([("en", "one", 5), ("en", "two", 1)], "lang string, word string, f long")
    usual = phrases._identified

    def identified(seed):
        return usual(seed) if seed > 1 else lambda batches: (
            __import__("pyarrow").RecordBatch.from_arrays([*b.columns, __import__("pyarrow").array([7] * b.num_rows, "int64")], [*b.schema.names, "id"])
            for b in batches
        )

    monkeypatch.setattr(phrases, "_identified", identified)
    assert phrases._identify(counted, 2)[0] == 2
    assert phrases._identify(counted, 9)[0] == 1


# Resampling


def plain_resampling(rows, target, low=1, high=1, buckets=10_000, least=20, percent=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text))

    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    s = collections.Counter(b for _, t in rows for b in features(t))
    t = collections.Counter(b for x in target for b in features(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out, able = [], []
    for n, (i, text) in enumerate(rows):
        f = features(text)
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if len(words(text)) >= least:
            able.append(n)
    able.sort(key=lambda n: (-out[n][3], out[n][0] is not None, out[n][0] or 0))
    for rank, n in enumerate(able[: percent * len(able) // 100], 1):
        out[n][4] = rank
    return collections.Counter(map(tuple, out))


def test_resampling_on_edges(ready, edges, nothing):
    target = ready.createDataFrame([("fox fox dog w1x1 é",), (None,), ("",)], "text string")
    rows = [(r[0], r[1]) for r in EDGES]
    got = resample.resampled(edges, target, least_words=2, percent=50)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collections.Counter(map(tuple, got.collect())) == plain_resampling(rows, [r[0] for r in target.collect()], least=2, percent=50)
    assert resample.resampled(nothing, target).count() == 0
    empty = resample.resampled(edges, target.limit(0), least_words=2, percent=50)
    assert collections.Counter(map(tuple, empty.collect())) == plain_resampling(rows, [], least=2, percent=50)


@pytest.mark.parametrize("low, high", [(1, 1), (1, 3), (2, 2)])
def test_resampling_of_documents(ready, documents, low, high):
    rows = [(r[0], r[1]) for r in documents.select("doc_id", "text").collect()]
    benchmark = ready.read.parquet(f"{brute.FOLDER}/benchmark.parquet")
    got = resample.resampled(documents, benchmark, low=low, high=high)
    want = plain_resampling(rows, [r["text"] for r in benchmark.collect()], low, high)
    assert collections.Counter(map(tuple, got.collect())) == want


def test_prefixes_give_the_crc_of_any_run():
    texts = ["One two-three  FOUR", None, "", "é" * 300 + " b", "x " * 50, "w" * 70_000 + " tail"]
    for slice_words in (1, 3, 1 << 18):
        k = resample.kernel(1, 3, 1 << 32, slice_words)
        got = collections.Counter((int(n), int(b)) for home, found, _ in k.scan(texts) for n, b in zip(home, found))
        want = collections.Counter()
        for n, text in enumerate(texts):
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text))
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    want[n, zlib.crc32(" ".join(w[i : i + size]).encode())] += 1
        assert got == want


def test_drawn_documents_keep_their_columns(ready, edges):
    target = ready.createDataFrame([("fox",)], "text string")
    drawn = resample.resampled(edges, target, least_words=2, percent=50)
    kept = resample.sample(edges, drawn)
    assert kept.columns == edges.columns and set(CLASHES) <= set(kept.columns)
    ids = {r["doc_id"] for r in drawn.filter("rank is not null").collect()} - {None}
    assert {r["doc_id"] for r in kept.collect()} == ids
