"""The pipeline against its stages done plainly, one by one."""

import collections

import corpus_pipeline
from tests.llm import brute


def rows_of(df, columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_stages_keep_columns_and_take_effect(ready):
    documents = ready.read.parquet(f"{brute.FOLDER}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in ready.read.parquet(f"{brute.FOLDER}/benchmark.parquet").collect()]
    docs, columns = documents, documents.columns
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs, columns)
        out = stage(ready, docs, brute.FOLDER)
        after = rows_of(out, columns)
        assert out.columns[: len(columns)] == columns
        assert (len(out.columns) > len(columns)) == (name == "sharding")
        assert set(after) <= set(before)
        rows = sorted((r[columns.index("doc_id")], r[columns.index("text")]) for r in before.elements())
        if name == "quality_classifier":
            labels = {r["doc_id"]: r["quality"] for r in ready.read.parquet(f"{brute.FOLDER}/labels.parquet").collect()}
            good = {i for i, _ in rows if labels.get(i) == 1}
            assert len(good & {r[0] for r in after}) >= 0.97 * len(good)
            assert sum(before.values()) > sum(after.values())
        elif name == "ngram_jaccard":
            found = brute.near(rows)
            assert {r[0] for r in after} == {i if found[k][0] == 0 else found[k][1] for k, (i, _) in enumerate(rows)}
        elif name == "decontamination":
            known = {g for _, t in items for g in brute.shingles(t)}
            bad = {i for i, t in rows if known & set(brute.shingles(t)) and brute.contained(t, items)}
            assert {r[0] for r in after} == {i for i, _ in rows} - bad
        elif name == "source_mixing":
            assert all(n <= 3 for n in after.values())
        else:
            assert after == before
        docs = corpus_pipeline.staged(out, name)


def test_run_is_the_stages_in_turn(ready):
    out = corpus_pipeline.run(ready, brute.FOLDER)
    assert out.columns[-2:] == ["shard", "slot"]
    assert out.count() > 0
