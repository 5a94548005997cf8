"""Publishing: unfinished commits, second readers and writers, failed siblings, changed roots."""

import os

import pytest
from pyspark.sql import functions as F

from cartlake.session import workspace
from cartlake.sinks.versioned import VersionedTables, publish_all
from cartlake.sources import catalog as cat
from tests.conftest import rows


def made(spark, name):
    root = workspace(spark, name)
    return root, VersionedTables(spark, root, name.replace("-", "_"))


def local(path):
    return path.removeprefix("file:")


def test_a_reader_sees_what_another_session_object_publishes(spark):
    root, writer = made(spark, "t-second-reader")
    writer.publish("t", spark.range(3).toDF("x"))
    reader = VersionedTables(spark, root, "t_second_reader")
    assert reader.table("t").count() == 3
    writer.publish("t", spark.range(5).toDF("x"))
    assert reader.table("t").count() == 5


def test_an_unfinished_commit_is_no_commit_and_does_not_block_the_next(spark):
    root, tables = made(spark, "t-torn")
    first = tables.publish("t", spark.range(3).toDF("x"))
    log = f"{local(root)}/t_torn/t/_log"
    for torn in ("", '{"snapshot_id": 5, "seq'):
        number = len([f for f in os.listdir(log) if f.endswith(".json")])
        with open(f"{log}/{number:012d}.json", "w") as f:
            f.write(torn)
        assert tables.current("t")["snapshot_id"] == first and tables.table("t").count() == 3
        first = tables.publish("t", spark.range(3).toDF("x"))
        assert tables.current("t")["snapshot_id"] == first
    assert tables.history("t").count() == 3
    assert [r.sequence_number for r in tables.log("t").orderBy("sequence_number").collect()] == [0, 1, 2]


def test_a_second_writer_of_the_same_commit_fails(spark, monkeypatch):
    root, one = made(spark, "t-second-writer")
    one.publish("t", spark.range(1).toDF("x"))
    two = VersionedTables(spark, root, "t_second_writer")
    old = two.current("t")
    one.publish("t", spark.range(2).toDF("x"))
    monkeypatch.setattr(two, "current", lambda name: old)       # it has not seen the commit
    with pytest.raises(FileExistsError):
        two.publish("t", spark.range(9).toDF("x"))
    assert one.table("t").count() == 2


def test_catalog_is_repaired_after_a_crash_behind_the_commit(spark, monkeypatch):
    _, tables = made(spark, "t-repair")
    tables.publish("t", spark.range(3).toDF("x"))
    with monkeypatch.context() as m:
        m.setattr(tables, "_point_catalog", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            tables.publish("t", spark.range(4).toDF("x"))
    assert spark.table("t_repair.t").count() == 3 and tables.table("t").count() == 4
    tables.repair("t")
    assert spark.table("t_repair.t").count() == 4


def test_failed_sibling_leaves_no_files_of_later_tables(spark):
    root, tables = made(spark, "t-sibling")
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception):
        publish_all(tables, [("a", spark.range(2).toDF("x")), ("b", bad), ("c", spark.range(4).toDF("x"))], parallelism=3)
    assert rows(tables.table("a")) == [(0,), (1,)] and tables.current("b") is None and tables.current("c") is None
    assert not [f for _, _, names in os.walk(f"{local(root)}/t_sibling/c") for f in names if f.endswith(".parquet")]


def test_a_table_at_another_location_is_refused(spark):
    root = workspace(spark, "t-moved")
    for place in ("a", "b"):
        spark.range(2).toDF("x").write.parquet(f"{root}/{place}")
    cat.create_database(spark, "t_moved", location=f"{root}/db")
    for _ in range(2):
        assert cat.external_parquet_table(spark, "t", "t_moved", f"{root}/a", [("x", "bigint")]).count() == 2
    with pytest.raises(ValueError, match="registered at"):
        cat.external_parquet_table(spark, "t", "t_moved", f"{root}/b", [("x", "bigint")])
