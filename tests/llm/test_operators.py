"""Each operator on awkward rows, and against plain versions of it."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import oracle
from tests.llm import brute
from tests.llm.conftest import EDGES
from txlake.llm import chat, components, decontam, dedup, lm, load_queries, mixing, near, quality, secrets, sharding, urls
from txlake.sources import fs

ROWS = [(r[0], r[1]) for r in EDGES]
QUERIES = load_queries()


@pytest.fixture(scope="module")
def documents(ready):
    return ready.read.parquet(f"{brute.FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").orderBy("doc_id").collect()]


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_matches_sql(ready, name):
    q = QUERIES[name]
    names, got = oracle.spark_rows(q.run(ready, brute.FOLDER))
    assert (names, got) == oracle.sql_rows(oracle.connect(brute.FOLDER), q.sql)


# Secrets


def check_secrets(found, rows):
    want = collections.Counter((i, brute.digest_text(brute.base_spans(t))) for i, t in rows)
    got = collections.Counter()
    for r in found.collect():
        base = [(s["start"], s["kind"], s["end"]) for s in r["base"]]
        got[(r["doc_id"], brute.digest_text(base))] += 1
        for s in r["added"]:
            assert all(s["end"] <= a or b <= s["start"] for a, _, b in base)
    assert got == want


def test_secrets_on_edges(edges, nothing):
    check_secrets(secrets.find_secrets(edges), ROWS)
    assert secrets.find_secrets(nothing).count() == 0


def test_secrets_on_documents(documents, rows):
    found = secrets.find_secrets(documents)
    check_secrets(found, rows)
    digests = {r["doc_id"]: r for r in secrets.secret_digests(found).collect()}
    for i, text in rows:
        spans = brute.base_spans(text)
        r = digests[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert r["base_sha256"] == hashlib.sha256(brute.digest_text(spans).encode()).hexdigest()


def test_markov_models_add_random_runs_only(ready, documents):
    token = "Zk3vQ9xLr7TbN2mWc8Yp5HsJd4Gf6Ka1"
    planted = ready.createDataFrame(
        [(-1, f"é und {token} here"), (-2, "internationalization_of_the_configuration here"), (-3, "thereforeandthenotherwise"), (-4, "=" * 60)],
        "doc_id long, text string",
    )
    found = secrets.find_secrets(documents.select("doc_id", "text").unionByName(planted)).filter("doc_id < 0")
    added = {r["doc_id"]: [(s["start"], s["end"]) for s in r["added"]] for r in found.collect()}
    assert added == {-1: [(6, 6 + len(token))], -2: [], -3: [], -4: []}


def test_markov_models_find_short_and_lower_case_keys(ready, documents):
    import random

    rng = random.Random(3)
    key = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    low, some = "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789"
    keys = [key(14, some) for _ in range(40)] + [key(20, low) for _ in range(40)]
    words = ["internationally", "misunderstanding", "characteristics", "responsibilities"]
    planted = ready.createDataFrame([(-1 - i, f"see {w} here") for i, w in enumerate(keys + words)], "doc_id long, text string")
    found = secrets.find_secrets(documents.select("doc_id", "text").unionByName(planted)).filter("doc_id < 0")
    added = {-1 - r["doc_id"]: len(r["added"]) for r in found.collect()}
    assert sum(added[i] for i in range(40)) >= 36 and sum(added[i] for i in range(40, 80)) >= 36
    assert not any(added[80 + i] for i in range(len(words)))


# Exact duplicates


def check_dedup(found, rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[brute.lower(t)].append(i)
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r["text_sha256"]].append(r)
    assert len(got) == len(groups)
    for text, ids in groups.items():
        members = got[hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        assert sorted(str(r["doc_id"]) for r in members) == sorted(map(str, ids))
        assert all(r["group_size"] == len(ids) and r["keep_id"] == keep for r in members)
        assert [r["doc_id"] for r in members if r["kept"]] == [keep]


def test_dedup_on_edges(edges, nothing):
    check_dedup(dedup.exact_duplicates(edges), ROWS)
    check_dedup(dedup.exact_duplicates(edges, block=9000), ROWS)
    assert dedup.exact_duplicates(nothing).count() == 0


def test_dedup_names_pairs_of_blocks(ready):
    texts = ["abcdefgh", "abcdefgh", "abcdefgH", "abcdefg", "efghabcd", "abcd", "aaaa" * 9, "aaaa" * 9, "aaaa" * 8, "a\n\U0001f600é", "a\n\U0001f600É"]
    rows = list(enumerate(texts))
    check_dedup(dedup.exact_duplicates(ready.createDataFrame(rows, "doc_id long, text string"), block=2), rows)


# Shards


def check_shards(found, rows, count, slack):
    got = found.collect()
    want = collections.Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert set(slots) <= set(range(count))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / count
    largest = max((r["size"] for r in got), default=0)
    assert all(abs(sizes[k] - mean) <= slack * mean + largest for k in range(count))
    return got


def check_togetherness(got, count):
    """Groups of equal texts up to 1/8 of a shard lie in one shard."""
    weight, places = collections.Counter(), collections.defaultdict(set)
    for r in got:
        weight[r["mark"]] += r["size"]
        places[r["mark"]].add(r["shard"])
    bar = sum(weight.values()) / count / 8
    assert all(len(places[m]) == 1 for m in weight if weight[m] <= bar)


def test_shards_on_edges(edges, nothing):
    check_shards(sharding.shards(edges, 3), ROWS, 3, 1.0)
    assert sharding.shards(nothing).count() == 0


def test_shards_have_near_equal_bytes_and_keep_equal_texts_together(documents, rows):
    for count in (16, 5):
        got = check_shards(sharding.shards(documents, count), rows, count, 0.1)
        check_togetherness(got, count)


def test_shards_of_a_heavy_group_and_target_bytes(ready):
    rows = [(i, "copy " * 40 if i % 3 == 0 else f"text {i} " * (i % 50)) for i in range(3000)]
    docs = ready.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    got = check_shards(sharding.shards(docs, 4), rows, 4, 0.03)
    assert len({r["shard"] for r in got if r["doc_id"] % 3 == 0}) > 1
    total = sum(len(t.encode()) + 1 for _, t in rows)
    check_shards(sharding.shards(docs, None, target_bytes=total // 7 + 1), rows, 7, 0.05)


def test_groups_of_middling_weight_stay_whole(ready):
    # 40 groups of 1/40 to 1/9 of a shard each, among texts of their own.
    rows = [(i, f"group {i % 40} " * 20 if i % 4 == 0 else f"text {i} " * (i % 60 + 1)) for i in range(4000)]
    docs = ready.createDataFrame([(*r, f"l{r[0] % 3}", f"s{r[0] % 7}") for r in rows], "doc_id long, text string, lang string, source string")
    check_togetherness(check_shards(sharding.shards(docs, 8), rows, 8, 0.1), 8)


def test_many_leaves_are_rows_and_not_literals(ready):
    rows = [(i, f"text {i} " * 5) for i in range(6000)]
    docs = ready.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    total = sum(len(t) + 1 for _, t in rows)
    found = sharding.shards(docs, None, target_bytes=-(-total // 2000))
    plan = found._jdf.queryExecution().logical().toString()
    got = check_shards(found, rows, 2000, 1.0)
    assert len({r["shard"] for r in got}) >= 1990 and len(plan) < 20_000


def test_documents_keep_their_columns_beside_shards(edges):
    out = sharding.with_shards(edges, 2)
    assert out.columns == [*edges.columns, "_shard", "_slot"]
    assert out.drop("_shard", "_slot").exceptAll(edges).count() == 0 and out.count() == edges.count()


# Decontamination


def check_contamination(found, rows, items):
    want = collections.Counter()
    for i, t in rows:
        hit = brute.contained(t, items)
        want[(i, tuple(sorted(hit)), round(max(hit.values(), default=0.0), 9))] += 1
    column = [c for c in found.columns if c in ("items", "_items")][-1]
    best = "_similarity" if column == "_items" else "similarity"
    assert collections.Counter((r["doc_id"], tuple(r[column]), round(r[best], 9)) for r in found.collect()) == want


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, "quick brown fox jumps over the lazy dog AGAIN and again until the evening comes at last"),
    (3, "one two"),
    (4, ""),
    (5, None),
    (None, "brown fox jumps over the lazy"),
    (6, "la la la la la la la la la la la la"),
    (6, "la la la la la la la la la la la la"),
]


def test_contamination_on_edges(ready, edges, nothing):
    items = ready.createDataFrame(ITEMS, "item_id long, text string")
    check_contamination(decontam.contamination(edges, items), ROWS, ITEMS)
    check_contamination(decontam.contamination(edges, items, chunk_bytes=40), ROWS, ITEMS)
    assert decontam.contamination(nothing, items).count() == 0
    assert decontam.without_items(edges, items.limit(0)).count() == len(EDGES)
    left = decontam.without_items(edges, items)
    assert left.columns == edges.columns
    assert left.count() == sum(not brute.contained(t, ITEMS) for _, t in ROWS)


def test_contamination_finds_changed_passages(ready):
    import random

    rng = random.Random(5)
    make = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(k, " ".join(make(rng.randrange(6, 60)))) for k in range(60)]
    rows = []
    for k, t in items:
        for edits in range(4):
            w = t.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = "other"
            rows.append((len(rows), " ".join([*make(rng.randrange(40)), *w, *make(rng.randrange(40))])))
        w = t.split()
        rows.append((len(rows), " ".join(w[: len(w) * 9 // 10])))
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    check_contamination(decontam.contamination(docs, ready.createDataFrame(items, "item_id long, text string")), rows, items)


def test_contamination_keeps_text_ids(ready, edges):
    items = [(f"item-{i}" if i else None, t) for i, t in ITEMS]
    bench = ready.createDataFrame(items, "item_id string, text string")
    for most in (1 << 20, 60):
        found = decontam.contamination(edges, bench, chunk_bytes=most)
        assert dict(found.dtypes)["_items"] == "array<string>"
        check_contamination(found, ROWS, items)


def test_contamination_of_a_large_benchmark_in_bounded_tables(ready, monkeypatch):
    # Many items of one length that share a beginning, and one long text that holds some of them.
    monkeypatch.setattr(decontam, "TABLE", 4096)
    items = [(i, f"all items share these seven opening words {' '.join(f'w{i * 31 + j}' for j in range(12))}") for i in range(700)]
    texts = [(1, " filler ".join(t for i, t in items if i % 50 == 7)), (2, items[3][1]), (3, "all items share these seven opening words only")]
    bench = ready.createDataFrame(items, "item_id long, text string")
    docs = ready.createDataFrame([(*t, "x", "x") for t in texts], "doc_id long, text string, items string, similarity string")
    check_contamination(decontam.contamination(docs, bench), texts, items)


def test_contamination_of_documents(ready, documents, rows):
    benchmark = ready.read.parquet(f"{brute.FOLDER}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    known = {g for _, t in items for g in brute.shingles(t)}
    some = [(i, t) for i, t in rows if known & set(brute.shingles(t))]
    found = decontam.contamination(documents, benchmark)
    check_contamination(found.filter(F.col("doc_id").isin([i for i, _ in some])), some, items)
    assert found.filter(F.size("items") > 0).filter(~F.col("doc_id").isin([i for i, _ in some])).count() == 0


# Quality


def test_quality_on_held_out_rows(ready):
    folder = "/root/testdata/sf0.1"
    labels = ready.read.parquet(f"{folder}/labels.parquet")
    scored = QUERIES["op5_quality_classifier"].run(ready, folder)
    out = scored.join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert sum(r["predicted"] == r["quality"] for r in out) / len(out) > 0.95
    good = [r["score"] for r in out if r["quality"] == 1]
    bad = [r["score"] for r in out if r["quality"] == 0]
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.95
    assert sum(s >= 0.3 for s in good) / len(good) > 0.98


def test_quality_on_edges(ready, edges, nothing):
    labels = ready.createDataFrame([(i, i % 2) for i in range(1, 13)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(edges, labels)
    scored = edges.select("doc_id", quality.held_out(F.col("doc_id")).alias("h"), quality.score(F.col("text"), model).alias("s"))
    got = scored.collect()
    assert len(got) == len(EDGES)
    assert all(0 <= r["s"] <= 1 and r["h"] == (brute.crc(r["doc_id"]) % 5 == 0) for r in got)
    assert quality.accepted(edges, model, threshold=0.0).columns == edges.columns
    assert quality.accepted(nothing, model).count() == 0
    assert quality.fit(edges, labels.limit(0)) is None
    assert quality.accepted(edges, None).count() == len(EDGES)


# Language model


def test_counts_go_before_the_automaton_is_packed(ready, monkeypatch):
    """What the automaton was made from is off the disk once its arcs are written."""
    staged, counted, left = lm.staged, [], []

    def watched(df, name, path=None):
        if name == "grams":
            counted.append(path)
        if name == "ranges":
            left.extend(p for p in counted if fs.exists(ready, p))
        return staged(df, name, path)

    monkeypatch.setattr(lm, "staged", watched)
    docs = ready.createDataFrame([(i, "a b c d a b c") for i in range(8)], "doc_id long, text string")
    assert lm.language_scores(docs).count() == 8
    # Those of single words are read once more.
    assert len(counted) == 3 and len(left) == 1


@pytest.mark.parametrize("share", [1e-5, 0.003])
def test_scores_as_by_walking_the_automaton(documents, rows, share):
    rows = rows[:120]
    few = documents.filter(F.col("doc_id").isin([i for i, _ in rows]))
    got = {r["doc_id"]: r for r in lm.language_scores(few, share=share).collect()}
    base, full = brute.base_scores(rows), brute.backoff_scores(rows, share)
    for (i, _), want, score in zip(rows, base, full, strict=True):
        r = got[i]
        assert [r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]] == list(want[:4])
        assert math.isclose(r["base_score"], want[4], rel_tol=1e-9)
        assert math.isclose(r["score"], score, rel_tol=1e-9)


def test_scores_by_many_blocks_and_ranges(documents, rows, monkeypatch):
    """Blocks go through the disk a sixth at a time, and each gets what its own n-grams weigh."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm, "RANGE_BYTES", 3000)
    staged, passes = lm.staged, []

    def watched(df, name, path=None):
        out = staged(df, name, path)
        if name == "scores":
            passes.append(out.count())
        return out

    monkeypatch.setattr(lm, "staged", watched)
    rows = rows[:120]
    few = documents.filter(F.col("doc_id").isin([i for i, _ in rows])).coalesce(1)
    got = {r["doc_id"]: r for r in lm.language_scores(few).collect()}
    for (i, _), want, score in zip(rows, brute.base_scores(rows), brute.backoff_scores(rows, 0.0), strict=True):
        r = got[i]
        assert [r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]] == list(want[:4])
        assert math.isclose(r["base_score"], want[4], rel_tol=1e-9)
        assert math.isclose(r["score"], score, rel_tol=1e-9)
    assert sum(passes) == len(rows) and max(passes) < len(rows) / 4


def test_values_come_back_without_their_keys():
    n = 20_000
    known = np.sort(np.random.default_rng(1).choice(1 << 62, n, replace=False))
    weight, fail = np.log10(1 / (2.0 + np.arange(n) % 90)), np.where(np.arange(n) % 3, 0.0, -0.5)
    table = pa.table({"g": known, "weight": weight, "fail": fail})
    automaton = lm._packed()((pa.scalar(7),), table)
    wanted = np.sort(np.append(known[::2], known[::5] + 1))
    keys = pa.table({"range": [7], "block": [3], "g": [wanted.tobytes()]})
    out = lm._look_up()(keys, automaton)
    # A key and its two numbers are 24 bytes.
    assert sum(c.nbytes for c in out.columns) < 8 * len(wanted)
    got, fails = lm._values()[1](out.column("values")[0].as_py(), len(wanted))
    by = {int(g): (w, f) for g, w, f in zip(known, weight, fail, strict=True)}
    for g, w, f in zip(wanted, got, fails, strict=True):
        assert (w, f) == by[int(g)] if int(g) in by else math.isnan(w) and f == 0


def test_scores_on_edges(edges, nothing):
    got = lm.language_scores(edges).collect()
    want = brute.base_scores(ROWS)
    key = lambda i, r: (str(i), *r[:4], round(r[4], 6))
    have = collections.Counter(
        key(r["doc_id"], (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])) for r in got
    )
    assert have == collections.Counter(key(i, w) for (i, _), w in zip(ROWS, want, strict=True))
    assert lm.language_scores(nothing).count() == 0


def test_model_is_likelier_than_words_alone_on_held_out_texts(documents):
    out = lm.language_scores(documents).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def test_rare_arcs_stay_however_many_tokens_there_are(ready):
    # Below 1e-5 of the tokens, the bar that once left such pairs and triples out.
    rows = [(i, f"alpha{i // 3} beta{i // 3} gamma{i // 3} " + "filler words " * 600) for i in range(300)]
    got = {r["doc_id"]: r for r in lm.language_scores(ready.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 1e-5 * got[0]["train_tokens"] > 3
    for (i, _), want in zip(rows, brute.backoff_scores(rows, 0.0), strict=True):
        assert math.isclose(got[i]["score"], want, rel_tol=1e-9)


# Chat


def test_chat_perspectives(ready):
    turns = [
        (1, 0, "system", "Be kind."),
        (1, 1, "anna", "Hi <|im_end|> you"),
        (1, 2, "bob", "Ho"),
        (1, 3, "anna", None),
        (1, 3, "anna", None),
        (2, None, None, "lost"),
        (None, 5, "cleo & dan", "x"),
        (3, 0, "system", "alone"),
    ]
    df = ready.createDataFrame([(*t, "x", "y") for t in turns], "conv_id long, turn long, role string, text string, part string, rank string")
    got = {(r["conv_id"], r["participant"]): r for r in chat.perspectives(df).collect()}
    assert set(got) == {(1, "anna"), (1, "bob"), (2, "unknown"), (None, "cleo & dan")}
    r = got[(1, "bob")]
    assert r["rendered"] == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user name=anna\nHi < im_end > you<|im_end|>\n"
        "<|im_start|>assistant\nHo<|im_end|>\n<|im_start|>user name=anna\n<|im_end|>\n<|im_start|>user name=anna\n<|im_end|>\n"
    )
    assert [r["rendered"][a:b] for a, b in r["spans"]] == ["Ho<|im_end|>\n"]
    assert "".join(r["rendered"][a:b] for a, b in sorted([*r["spans"], *r["masked"]])) == r["rendered"]
    r = got[(1, "anna")]
    assert len(r["spans"]) == 3 and r["n_messages"] == 5
    whole = sorted(chat.perspectives(df, part=2).filter("conv_id = 1 and participant = 'anna'").collect(), key=lambda x: x["part"])
    assert "".join(x["rendered"] for x in whole) == r["rendered"]
    assert [x["offset"] for x in whole] == [sum(len(y["rendered"]) for y in whole[:i]) for i in range(3)]
    assert chat.perspectives(df.limit(0)).count() == 0


def test_chat_names_and_long_texts(ready):
    import urllib.parse

    names = ["a b", "a_b", "a+b", "a%20b", "A*b", "~a", "é", "\U0001f600", "", "a\nb"]
    long = "word " * 400_000
    turns = [(1, i, n, long if i == 1 else f"text {i}") for i, n in enumerate(names)]
    df = ready.createDataFrame([(*t, "x", "y", "z") for t in turns], "conv_id long, turn long, role string, text string, head string, participant string, m string")
    got = {r["participant"]: r for r in chat.perspectives(df).collect()}
    assert set(got) == set(names)
    for who, r in got.items():
        heads = ["assistant" if n == who else "user name=" + urllib.parse.quote(n, safe="") for n in names]
        assert len(set(heads)) == len(names)
        assert r["rendered"] == "".join(f"<|im_start|>{h}\n{t[3]}<|im_end|>\n" for h, t in zip(heads, turns, strict=True))
        assert [r["rendered"][a:b] for a, b in r["spans"]] == [turns[names.index(who)][3] + "<|im_end|>\n"]


# Urls


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return brute.lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in urls.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def plain_tree(rows):
    """Template and impurity by walking each host's tree branch by branch."""
    smoothed = lambda bad, n, prior: (bad + urls.PRIOR_WEIGHT * prior) / (n + urls.PRIOR_WEIGHT)
    pages, labels = collections.Counter(), collections.defaultdict(lambda: [0, 0])
    for _, u in rows:
        key = plain_url(u)
        verdict = plain_rule(*key)[1]
        pages[key] += 1
        labels[key][0] += verdict is not None
        labels[key][1] += verdict == "block"
    names = {
        key: [urls.WILD if re.search("[0-9]", x) else "=" + x if x[0] in "*={" else x for x in key[1].split("/") if x] for key in pages
    }
    elsewhere = collections.defaultdict(lambda: [0, 0])
    for key, path in names.items():
        for depth, name in enumerate(path):
            if labels[key][0] and name != urls.WILD:
                elsewhere[depth, name][0] += labels[key][0]
                elsewhere[depth, name][1] += labels[key][1]
    out, prior = {}, dict.fromkeys(pages, urls.PRIOR)
    nodes = collections.defaultdict(list)
    for key in pages:
        nodes[key[0], "", 0].append(key)
    while nodes:
        (host, template, depth), keys = nodes.popitem()
        branches = collections.defaultdict(list)
        for key in keys:
            branches[names[key][depth] if depth < len(names[key]) else urls.END].append(key)
        stats = {}
        for name, members in branches.items():
            n, labelled, blocked = sum(pages[k] for k in members), sum(labels[k][0] for k in members), sum(labels[k][1] for k in members)
            others, bad = elsewhere.get((depth, name), (labelled, blocked))
            others, bad = others - labelled, bad - blocked
            for k in members:
                prior[k] = smoothed(bad, others, prior[k])
            stats[name] = n, labelled + others, blocked + sum((pages[k] - labels[k][0]) * prior[k] for k in members)
        n_pages, n_bad = sum(x[0] for x in stats.values()), sum(x[2] for x in stats.values())

        def rate(bad, n):
            mean = (bad + 1) / (n + 2)
            return mean, mean * (1 - mean) / (n + 3)

        kept = []
        for name, (n, known, bad) in stats.items():
            (a, va), (b, vb) = rate(bad, n), rate(n_bad - bad, n_pages - n)
            common = name != urls.WILD and urls.BRANCH_SHARE * n_pages <= n < n_pages
            if common and known and abs(a - b) >= urls.BRANCH_SIGMAS * math.sqrt(va + vb):
                kept.append((a, name, va))
        child, groups = dict.fromkeys(stats, urls.WILD), []
        for a, name, va in sorted(kept):
            if not groups or a - groups[-1][-1][0] >= urls.BRANCH_SIGMAS * math.sqrt(va + groups[-1][-1][2]):
                groups.append([])
            groups[-1].append((a, name, va))
        for group in groups:
            members = sorted(g[1] for g in group)
            label = members[0] if len(members) == 1 else "{" + "|".join(m.replace("=", "==").replace("|", "=|") for m in members) + "}"
            child.update(dict.fromkeys(members, label))
        sums = collections.defaultdict(lambda: [0, 0])
        for name, members in branches.items():
            for k in members:
                sums[child[name]][0] += labels[k][0]
                sums[child[name]][1] += labels[k][1]
        for name, members in branches.items():
            for k in members:
                if name == urls.END:
                    out[k] = template, smoothed(sums[child[name]][1], sums[child[name]][0], prior[k])
                else:
                    nodes[host, f"{template}/{child[name]}", depth + 1].append(k)
    return out


def check_urls(found, rows):
    tree = plain_tree(rows)
    for r in found:
        template, impurity = tree[r["host"], r["path"]]
        assert r["template"] == template and math.isclose(r["impurity"], impurity, rel_tol=1e-9), (r, template, impurity)
    got = collections.Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in found)
    want = collections.Counter((i, *plain_url(u), plain_rule(*plain_url(u))[0]) for i, u in rows)
    assert got == want
    for r in found:
        assert r["verdict"] == (plain_rule(r["host"], r["path"])[1] or ("block" if r["impurity"] >= 0.5 else "allow"))


def test_urls_on_edges(ready):
    given = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM", "http://www.example.com/en/x?a=://b", "http://a.www.example.com/en/",
        "http://xexample.com/en/1", "http://example.com/en/1#f", "http://example.com/en", "http://net/es/", "https://É.net/fr/é", "http://a.net/*/1/**",
        "http://a.net/es", "http://com/", "http://com", "http://a.org/" + "d/" * 30, "http://a.org//x//y", "http://a:80@b.com/\n/x", "a://b://c/d", "http://a.net/es/1", "http://a.net/es/1",
    ]
    rows = list(enumerate(given)) + [(None, "http://q.org/1")]
    pages = ready.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, template string")
    check_urls(urls.judged(pages).collect(), rows)
    assert urls.judged(pages.limit(0)).count() == 0


def test_urls_of_pages(ready):
    pages = ready.read.parquet(f"{brute.FOLDER}/pages.parquet")
    check_urls(urls.judged(pages).collect(), [(r["page_id"], r["url"]) for r in pages.collect()])


def test_templates_tell_branches_by_their_labels(ready):
    rows = [(i, f"http://shop.net/{'es' if i % 2 else 'de'}/item{i}") for i in range(400)]
    rows += [(1000 + i, f"http://shop.net/{'xyz'[i % 3]}/a") for i in range(30)]
    rows += [(2000 + i, f"http://shop.com/buy/{i}") for i in range(200)]
    found = urls.judged(ready.createDataFrame(rows, "page_id long, url string")).collect()
    check_urls(found, rows)
    assert {r["template"] for r in found if r["host"] == "shop.com"} == {"/*/*"}
    assert {r["template"] for r in found if r["path"].startswith("/de/")} == {"/*/*"}


def test_unlabelled_branches_do_not_take_the_purity_of_blocked_ones(ready):
    rows = [(i, f"http://one.net/{('es', 'fr', 'en', 'de')[i % 4]}/item{i}") for i in range(200)]
    rows += [(1000 + i, f"http://two.org/{('es', 'en')[i % 2]}/item{i}") for i in range(60)]
    rows += [(2000 + i, f"http://three.com/{('en', 'de')[i % 2]}/item{i}") for i in range(80)]
    rows += [(3000 + i, f"http://deep.org/{'/'.join('abcdefghijk')}/{'xy'[i % 2]}") for i in range(2)]
    found = urls.judged(ready.createDataFrame(rows, "page_id long, url string")).collect()
    check_urls(found, rows)
    got = {(r["host"], r["path"].split("/")[1]): (r["verdict"], r["template"]) for r in found}
    assert got["one.net", "es"] == got["one.net", "fr"] == ("block", "/{es|fr}/*")
    assert got["one.net", "en"][0] == got["one.net", "de"][0] == "allow"
    assert got["two.org", "es"][0] == "block" and got["two.org", "en"][0] == "allow"
    assert got["deep.org", "a"][1] == "/*" * 12


def test_paths_are_read_to_their_end(ready):
    # What decides lies below the tenth segment; the beginning is shared, and long.
    start = "/".join("abcdefghij") + "/" + "/".join(["same"] * 300)
    rows = [(i, f"http://q.{('net', 'com')[i % 2]}/es/{'/'.join('bcdefghij')}/{('bad', 'good')[i % 2]}") for i in range(100)]
    rows += [(1000 + i, f"http://open.org/es/{'/'.join('bcdefghij')}/{('bad', 'good')[i % 2]}") for i in range(2)]
    rows += [(2000 + i, f"http://long.org/{start}/{'xyz'[i % 3]}/{i}") for i in range(9)]
    found = urls.judged(ready.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, names string, prior string")).collect()
    check_urls(found, rows)
    got = {r["page_id"]: r for r in found}
    assert got[1000]["verdict"] == "block" and got[1001]["verdict"] == "allow"
    assert got[2000]["template"].count("/") == 312


# Near duplicates


def check_near(found, rows):
    want = collections.Counter((i, *brute_row) for (i, _), brute_row in zip(rows, brute.near(rows).values(), strict=True))
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()) == want


def in_order(rows):
    found = brute.near(rows)
    return [(rows[i][0], *found[i]) for i in range(len(rows))]


def test_near_on_edges(edges, nothing):
    found = near.near_duplicates(edges)
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    # Rows without words are in no component: the id is their own.
    want = collections.Counter((i, n, i if n == 0 else c) for i, n, c in in_order(ROWS))
    assert got == want
    assert near.near_duplicates(nothing).count() == 0
    kept = near.one_of_each(edges)
    assert kept.columns == edges.columns
    groups = {c for _, n, c in in_order(ROWS) if n}
    assert kept.count() == len(groups) + sum(n == 0 for _, n, _ in in_order(ROWS))


def test_near_on_documents(documents, rows):
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near.near_duplicates(documents).collect())
    assert got == sorted((i, n, i if n == 0 else c) for i, n, c in in_order(rows))


def test_near_on_chains_around_the_threshold(ready):
    import random

    rng = random.Random(11)
    rows = []
    for g in range(12):
        w = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.randrange(8, 90))]
        shared = [f"common{j}" for j in range(30)] if g % 2 else []
        for _ in range(25):
            w = list(w)
            for _ in range(rng.randrange(1, 4)):
                at = rng.randrange(len(w))
                if rng.random() < 0.5:
                    w[at] = f"n{rng.randrange(10**6)}"
                else:
                    w.insert(at, f"n{rng.randrange(10**6)}")
            rows.append((rng.randrange(10**9), " ".join([*w, *shared])))
    found = near.near_duplicates(ready.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert got == sorted(in_order(rows))


@pytest.mark.parametrize(("block", "wide", "piece"), [(2048, 512, 4096), (16, 64, 8), (1, 1, 1000)])
def test_near_links_are_counted_across_tiles(ready, monkeypatch, block, wide, piece):
    import random

    for name, value in (("BLOCK", block), ("WIDE", wide), ("PIECE", piece)):
        monkeypatch.setattr(near, name, value)
    rng = random.Random(3)
    texts = []
    for g, words_of in enumerate((40, 40, 150, 700)):
        base = [f"b{g}x{j}" for j in range(words_of)]
        for _ in range(45):
            w = list(base)
            for _ in range(rng.randrange(0, max(3, words_of // 25))):
                w[rng.randrange(len(w))] = f"n{rng.randrange(60)}"
            texts.append(" ".join(w[: rng.randrange(words_of // 2, words_of + 1)] if rng.random() < 0.3 else w))
    rows = list(enumerate(texts))
    sets = {frozenset(brute.shingles(t)) for t in texts}
    links = {a: sum(a is not b and 100 * len(a & b) >= 75 * len(a | b) for b in sets) for a in sets}
    found = near.near_duplicates(ready.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_links"] for r in found} == {i: links[frozenset(brute.shingles(t))] for i, t in rows}
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(in_order(rows))


def test_components_of_chains_and_stars(ready):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 4000), (4000, 4500), (7, 7), (-9, -8), (-8, -9)]
    got = {r["node"]: r["root"] for r in components.components(ready.createDataFrame(edges, "x long, y long")).collect()}
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(200)} | {4000: 4000, 4500: 4000, 5000: 4000, -9: -9, -8: -9}
    assert got == want
    assert components.components(ready.createDataFrame([], "x long, y long")).count() == 0


# Mixing


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / open_ for s in order}
        more = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not more:
            return target
        full |= more


def test_mixing_on_edges(edges, nothing):
    sizes = collections.Counter()
    for _, t, _, s in EDGES:
        sizes[s] += len(brute.words(t))
    target = plain_targets(sizes)
    want = collections.Counter((r[0], len(brute.words(r[1])), sizes[r[3]], round(target[r[3]], 6)) for r in EDGES)
    got = mixing.mixture(edges).collect()
    assert collections.Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got) == want
    assert all(r["taken"] == r["size"] * r["copies"] and math.floor(r["rate"]) <= r["copies"] <= math.ceil(r["rate"]) <= 3 for r in got)
    out = mixing.repeat_documents(edges)
    assert out.columns == edges.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mixture(nothing).count() == 0 and mixing.repeat_documents(nothing).count() == 0


def test_mixing_comes_near_its_targets(ready):
    documents = ready.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mixture(documents).groupBy("source_size").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert abs(sum(r["taken"] for r in got) / sum(r["target"] for r in got) - 1) < 0.1
