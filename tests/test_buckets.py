"""Changes of a keyed table rewrite the buckets of their keys and nothing else."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txlake.sources import fs
from txlake.sources.buckets import ApplyToBuckets, BucketTable

T0 = dt.datetime(2024, 3, 5)


def listing(spark, table):
    found = {}
    for name in fs.folders(spark, table.path, 1):
        found[int(name.split("=")[1])] = fs.files(spark, f"{table.path}/{name}")
    return found


def rows(spark, *data):
    return spark.createDataFrame(list(data), "k long, v string")


@pytest.fixture()
def table(spark, root):
    out = BucketTable(spark, f"{root}/t", ["k"], 16)
    out.create(spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    return out


def changed(before, after):
    return {n for n in before.keys() | after.keys() if before.get(n) != after.get(n)}


def test_upsert_leaves_other_files_alone(spark, table):
    before = listing(spark, table)
    fresh = rows(spark, (3, "new"), (1000, "new"), (None, "none"))
    buckets = table.touched(fresh)
    assert table.upsert(fresh) == len(buckets)
    assert changed(before, listing(spark, table)) == set(buckets)
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 402 and got[3] == got[1000] == "new" and got[None] == "none" and got[4] == "old"
    # Once more: the same rows.
    table.upsert(fresh)
    assert table.read().count() == 402


def test_soft_delete_leaves_other_files_alone(spark, table):
    before = listing(spark, table)
    gone = rows(spark, (7, "x"), (5000, "x"))
    assert table.update_matching(gone, {"v": F.lit("gone")}) == 1
    assert changed(before, listing(spark, table)) == set(table.touched(rows(spark, (7, ""))))
    assert [r.k for r in table.read().filter("v = 'gone'").collect()] == [7]
    assert table.read().count() == 400


def test_nothing_to_do_touches_nothing(spark, table):
    before = listing(spark, table)
    assert table.upsert(rows(spark)) == 0 and table.update_matching(rows(spark), {"v": F.lit("")}) == 0
    assert changed(before, listing(spark, table)) == set()


def test_a_bucket_that_becomes_empty_goes(spark, root):
    table = BucketTable(spark, f"{root}/t", ["k"], 8)
    schema = "k long, v string, __deleted string, n long"
    handler = ApplyToBuckets(table, ["n"], F.lit(T0))
    table.apply(spark.createDataFrame([(1, "a", "false", 1)], schema), ["n"], F.lit(T0), hard_delete=True)
    handler(spark.createDataFrame([(2, "b", "false", 2)], schema), 0)
    assert table.read().count() == 2
    table.apply(spark.createDataFrame([(1, None, "true", 3)], schema), ["n"], F.lit(T0), hard_delete=True)
    assert [r.k for r in table.read().collect()] == [2]


def test_a_replayed_batch_of_changes_gives_the_same_rows(spark, root):
    table = BucketTable(spark, f"{root}/t", ["k"], 4)
    schema = "k long, v string, __deleted string, n long"
    handler = ApplyToBuckets(table, ["n"], F.lit(T0))
    batches = [[(1, "a", "false", 1), (2, "b", "false", 2)], [(1, None, "true", 3), (3, "c", "false", 4), (3, "d", "false", 5)]]
    for n in (0, 1, 1):
        handler(spark.createDataFrame(batches[n], schema), n)
    got = {(r.k, r.v, r["__deleted"]) for r in table.read().collect()}
    assert got == {(1, "a", "true"), (2, "b", "false"), (3, "d", "false")}


def test_rows_of_other_buckets_are_refused(spark, table):
    numbers = table.touched(rows(spark, (3, "")))
    with pytest.raises(ValueError, match="other buckets"):
        table.replace(numbers, table.read())
