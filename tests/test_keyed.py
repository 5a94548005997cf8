"""Change batches applied to key buckets: NULL keys, replay, late changes, what is written."""

import os

import pytest
from pyspark.sql import functions as F

from cartlake.session import workspace
from cartlake.streaming.changes import apply_changes
from cartlake.streaming.keyed import KeyedTable
from tests.conftest import rows

SCHEMA = "sku int, label string, shelf int"
FEED = SCHEMA + ", op string, seq long"


def table(spark, data, name, buckets=8, key="sku"):
    df = spark.createDataFrame(data, SCHEMA)
    made = KeyedTable(spark, workspace(spark, name) + "/t", df.schema, key, buckets)
    made.load(df)
    return made


def test_replayed_null_key_batch_gives_the_same_rows(spark):
    feed = spark.createDataFrame([(None, "loose", 1, "I", 1), (4, "oats", 2, "U", 1), (9, "rye", 3, "I", 1), (7, None, None, "D", 1)], FEED)
    start = [(4, "bran", 2), (7, "corn", 2)]
    t = table(spark, start, "t-null")
    want = sorted([(None, "loose", 1), (4, "oats", 2), (9, "rye", 3)], key=repr)
    for _ in range(3):
        t.apply(feed)
        assert rows(t.read()) == want
    once = apply_changes(spark.createDataFrame(start, SCHEMA), feed, "sku")
    assert rows(once) == want and rows(apply_changes(once, feed, "sku")) == want


def test_late_changes_lose_and_deleted_keys_stay_deleted(spark):
    t = table(spark, [(4, "bran", 2)], "t-late")
    t.apply(spark.createDataFrame([(4, "new", 5, "U", 5), (7, None, None, "D", 5)], FEED))
    t.apply(spark.createDataFrame([(4, "old", 1, "U", 3), (7, "back", 1, "I", 4), (8, "x", 1, "I", 1)], FEED))
    assert rows(t.read()) == [(4, "new", 5), (8, "x", 1)]
    t.apply(spark.createDataFrame([(7, "again", 1, "I", 6)], FEED))
    assert rows(t.read()) == [(4, "new", 5), (7, "again", 1), (8, "x", 1)]


def test_only_touched_buckets_are_written(spark):
    t = table(spark, [(i, f"item {i}", i) for i in range(400)], "t-buckets", buckets=16)

    def files():
        top = t.root.removeprefix("file:")
        return {(d, f) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}
    before = files()
    touched = t.apply(spark.createDataFrame([(5, "changed", 0, "U", 1)], FEED))
    after = files()
    assert len(touched) == 1
    assert {d for d, _ in before ^ after} == {f"{t.root.removeprefix('file:')}/bucket={touched[0]}"}
    assert t.read().count() == 400 and t.read().filter("sku = 5").first().label == "changed"
    assert t.apply(spark.createDataFrame([], FEED)) == [] and files() == after


def test_composite_key_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "c0 int, t0 int, c_deletes string")
    t = KeyedTable(spark, workspace(spark, "t-comp") + "/t", df.schema, ["c0", "t0"], 4)
    t.load(df)
    feed = spark.createDataFrame([(1, None, "z", "U", 1), (3, 3, "n", "I", 1)], "c0 int, t0 int, c_deletes string, op string, seq long")
    t.apply(feed)
    want = sorted([(1, None, "z"), (1, 2, "b"), (3, 3, "n")], key=repr)
    assert rows(t.read()) == want and rows(apply_changes(df, feed, ["c0", "t0"])) == want
    with pytest.raises(ValueError):
        KeyedTable(spark, "x", df.withColumn("bucket", F.lit(1)).schema, "c0")


def test_change_application_is_one_join(spark):
    t = spark.createDataFrame([(4, "bran", 2)], SCHEMA)
    feed = spark.createDataFrame([(4, "oats", 2, "U", 1)], FEED)
    plan = apply_changes(t, feed, "sku")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1 and plan.count("Join") == 1
