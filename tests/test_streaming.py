"""Change-feed application: batch semantics, idempotent replay, streaming with foreachBatch."""

from pyspark.sql import functions as F

from cartlake.session import workspace
from cartlake.sinks.versioned import VersionedTables
from cartlake.sources import fixtures as fz
from cartlake.streaming.changes import apply_changes, latest_changes, stream_changes
from tests.conftest import SF_SMALL, rows

SCHEMA = "product_id int, product_name string, aisle_id int, department_id int, updated_at double"
CH = SCHEMA + ", op string, seq long"


def test_latest_change_wins_and_delete(spark):
    t = spark.createDataFrame([(1, "a", 1, 1, 0.0), (2, "b", 1, 1, 0.0)], SCHEMA)
    c = spark.createDataFrame([
        (1, "a2", 1, 1, 1.0, "U", 1), (1, "a3", 1, 1, 2.0, "U", 2),   # two updates: seq 2 wins
        (2, "b2", 1, 1, 1.0, "U", 1), (2, None, None, None, 2.0, "D", 2),  # update then delete
        (3, "c", 1, 1, 1.0, "I", 1), (3, None, None, None, 2.0, "D", 3), (3, "c2", 1, 1, 3.0, "I", 4),
    ], CH)
    assert rows(latest_changes(c, "product_id", "seq").select("product_id", "seq")) == [(1, 2), (2, 2), (3, 4)]
    out = apply_changes(t, c, "product_id")
    assert rows(out) == [(1, "a3", 1, 1, 2.0), (3, "c2", 1, 1, 3.0)]
    again = apply_changes(out, c, "product_id")
    assert rows(again) == rows(out)


def test_stream_applies_each_batch_and_matches_batch(spark):
    root = workspace(spark, "t-cdc")
    changes = fz.product_changes(spark, SF_SMALL)
    for s in (1, 2, 3):
        changes.filter(F.col("seq") == s).coalesce(1).write.parquet(f"{root}/in/seq={s}")
    tables = VersionedTables(spark, f"{root}/t", "t_cdc")
    tables.publish("products", fz.product_target(spark, SF_SMALL))
    q = stream_changes(spark, f"{root}/in/seq=*", changes.schema, tables, "products", "product_id",
                       checkpoint=f"{root}/ck")
    q.awaitTermination()
    assert q.exception() is None
    want = apply_changes(fz.product_target(spark, SF_SMALL), changes, "product_id")
    got = tables.table("products")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert tables.history("products").count() == 4     # initial + one version per micro-batch
    # restarting on the same checkpoint finds nothing new
    q2 = stream_changes(spark, f"{root}/in/seq=*", changes.schema, tables, "products", "product_id",
                        checkpoint=f"{root}/ck")
    q2.awaitTermination()
    assert tables.history("products").count() == 4


def test_stream_ignores_late_older_changes(spark):
    root = workspace(spark, "t-cdc-late")
    changes = fz.product_changes(spark, SF_SMALL)
    # newest batch lands first, the older ones afterwards
    for i, s in enumerate((3, 2, 1)):
        changes.filter(F.col("seq") == s).coalesce(1).write.parquet(f"{root}/in/b={i}")
    tables = VersionedTables(spark, f"{root}/t", "t_cdc_late")
    tables.publish("products", fz.product_target(spark, SF_SMALL))
    q = stream_changes(spark, f"{root}/in/b=*", changes.schema, tables, "products", "product_id",
                       checkpoint=f"{root}/ck")
    q.awaitTermination()
    assert q.exception() is None
    want = apply_changes(fz.product_target(spark, SF_SMALL), changes, "product_id")
    got = tables.table("products")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_apply_changes_with_applied_sequences(spark):
    t = spark.createDataFrame([(1, "a", 1, 1, 0.0)], SCHEMA)
    c = spark.createDataFrame([(1, "old", 1, 1, 1.0, "U", 1), (2, "zombie", 1, 1, 1.0, "I", 1)], CH)
    applied = spark.createDataFrame([(1, 5), (2, 3)], "product_id int, seq long")   # 2 was deleted at 3
    assert rows(apply_changes(t, c, "product_id", applied=applied)) == [(1, "a", 1, 1, 0.0)]


def test_apply_changes_on_composite_key(spark):
    sch = "order_id int, product_id int, add_to_cart_order int"
    t = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], sch)
    c = spark.createDataFrame([(1, 10, 4, "U", 1), (1, 11, None, "D", 1), (2, 10, 1, "I", 1)],
                              sch + ", op string, seq long")
    assert rows(apply_changes(t, c, ["order_id", "product_id"])) == [(1, 10, 4), (2, 10, 1)]


def test_replay_after_crash_between_commits_is_harmless(spark):
    """Table published, sequence table not: the replayed batch sees the old sequence
    table and the new table, and must leave the table as it is."""
    from cartlake.streaming.changes import applied_sequences, fresh_changes
    target = fz.product_target(spark, SF_SMALL)
    changes = fz.product_changes(spark, SF_SMALL)
    old_applied = spark.createDataFrame([(5, 0), (10, 0)], "product_id int, seq long")
    after = apply_changes(target, changes, "product_id", applied=old_applied)
    replay = apply_changes(after, changes, "product_id", applied=old_applied)
    assert replay.exceptAll(after).isEmpty() and after.exceptAll(replay).isEmpty()
    latest = fresh_changes(latest_changes(changes, "product_id", "seq"), old_applied, "product_id", "seq")
    seqs = applied_sequences(old_applied, latest, "product_id", "seq")
    got = {r.product_id: r.seq for r in seqs.filter("product_id IN (10, 30)").collect()}
    assert got == {10: 2, 30: 3}   # 10: updated at 1 and 2; 30: updated at 1 and 2, deleted at 3


def test_stream_creates_the_table_from_nothing(spark):
    root = workspace(spark, "t-cdc-new")
    changes = fz.product_changes(spark, SF_SMALL)
    changes.coalesce(1).write.parquet(f"{root}/in/b=0")
    tables = VersionedTables(spark, f"{root}/t", "t_cdc_new")
    q = stream_changes(spark, f"{root}/in/b=*", changes.schema, tables, "products", "product_id",
                       checkpoint=f"{root}/ck")
    q.awaitTermination()
    assert q.exception() is None
    empty = spark.createDataFrame([], changes.drop("op", "seq").schema)
    want = apply_changes(empty, changes, "product_id")
    got = tables.table("products")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 0
