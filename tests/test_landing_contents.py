"""File caps from measured bytes, content digests, the CSV dialect's empty strings."""

import os

import pytest
from pyspark.sql import functions as F

from cartlake.operators.quality import content_digest
from cartlake.session import workspace
from cartlake.sinks import landing
from cartlake.sources import files
from tests.conftest import SF_MID, rows


def sizes(path):
    top = path.removeprefix("file:")
    return [os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")]


@pytest.mark.parametrize("kb", [60, 100, 400])
def test_every_landed_file_is_below_the_cap(spark, kb):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    for compression in ("gzip", "snappy"):
        path = landing.parquet_landing_write(docs, workspace(spark, "t-cap"), "documents", max_file_kb=kb, compression=compression)
        assert len(sizes(path)) > 1 and max(sizes(path)) <= kb * 1024
        assert spark.read.parquet(path).count() == docs.count()


def test_row_caps_follow_measured_widths(spark):
    narrow = spark.range(1000).select(F.lit("x").alias("t"))
    wide = spark.range(1000).select(F.repeat(F.lit("x"), 10_000).alias("t"), F.array(F.lit(1), F.lit(2)).alias("a"))
    cap = 10_000_000
    assert landing.records_per_file(narrow, cap) > 1_000_000 and 900 < landing.records_per_file(wide, cap) < 1000
    assert landing.records_per_file(narrow.limit(0), cap) > 0 and landing.records_per_file(wide, 1) == 1
    uneven = spark.range(1000).select(F.repeat(F.lit("x"), F.when(F.col("id") % 100 == 0, F.lit(100_000)).otherwise(F.lit(10)).cast("int")).alias("t"))
    even = spark.range(1000).select(F.repeat(F.lit("x"), 1010).alias("t"))
    assert landing.records_per_file(uneven, cap) < landing.records_per_file(even, cap)


def test_digest_is_of_the_contents_only(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (2, None, None), (3, "∅|", 1e9)], "k int, s string, v double")
    one = rows(content_digest(df))
    assert one == rows(content_digest(df.orderBy(F.desc("k")).repartition(3).select("v", "s", "k")))
    for other in (df.withColumn("s", F.when(F.col("k") == 1, "b").otherwise(F.col("s"))), df.distinct(),
                  df.withColumn("v", F.col("v") + 1e-5), df.fillna({"s": ""})):
        assert rows(content_digest(other))[0][1] != one[0][1]
    assert rows(content_digest(df.limit(0))) == [(0, "0")]


def test_copy_csv_tells_empty_strings_from_nulls(spark):
    path = workspace(spark, "t-csv-empty")
    schema = "k int, s string, t string, f float, b boolean"
    spark.createDataFrame([('1,"",,2.5,t',), ('2,,"",,',), ('3,"a ""b"", c",x\\y,1,0',), (',,,,',)], "value string").coalesce(1).write.text(f"{path}/in")
    got = files.csv_typed_load(spark, f"{path}/in", schema, header=False)
    want = [(1, "", None, 2.5, True), (2, None, "", None, None), (3, 'a "b", c', "x\\y", 1.0, False), (None, None, None, None, None)]
    assert rows(got) == sorted(want, key=repr)
    # and the writer's files read back the same
    assert rows(files.csv_typed_load(spark, files.write_csv(got, f"{path}/out"), schema)) == rows(got)


def test_bounds_reach_the_scan_of_a_sorted_landing(spark):
    from cartlake.plans import registry as R
    for query, bounds in ((R.q_filter_range, ("GreaterThan(product_id,120)", "LessThan(product_id,170)")),
                          (R.q_filter_or, ("Or(", "EqualTo(product_id,140)"))):
        df = query(spark, SF_MID)
        pushed = next(x for x in df._jdf.queryExecution().toString().splitlines() if "PushedFilters" in x)
        assert all(b in pushed for b in bounds), pushed
        assert df.count() > 4


def test_reload_keeps_the_partitions_it_does_not_bring(spark):
    root = workspace(spark, "t-reload")
    df = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(30)], "k int, p string")
    landing.partitioned_landing(df, root, "t", ["p"])
    path = landing.partitioned_landing(spark.createDataFrame([(100, "b")], "k int, p string"), root, "t", ["p"], reload=True)
    assert rows(spark.read.parquet(path).select("k", "p")) == sorted([*((i, "abc"[i % 3]) for i in range(30) if i % 3 != 1), (100, "b")], key=repr)
    with pytest.raises(ValueError):
        landing.parquet_landing_write(df, root, "t", reload=True)


def test_declared_lengths_and_not_null_are_enforced_on_load(spark):
    from cartlake.sources import catalog as cat
    name = "t_declared_lengths"
    cat.drop_create_table(spark, name, [("k", "int"), ("s", "varchar(20)")], location=workspace(spark, "t-varchar"))
    fits = spark.createDataFrame([("y" * 20, 1), (None, 2)], "s string, k int")
    assert cat.load_table(fits, name, not_null=("k",)).count() == 2
    for bad, need in ((spark.createDataFrame([("y" * 21, 3)], "s string, k int"), ()), (fits, ("s",))):
        with pytest.raises(Exception):
            cat.load_table(bad, name, not_null=need)
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")
