"""Scalar expressions (F1-F13) on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from cartlake import functions as cf


def test_map_value_absent_key_is_null(spark):
    df = spark.createDataFrame([({"spark.app.id": "app-1"},), ({},), (None,)], "summary map<string,string>")
    assert [r[0] for r in df.select(cf.map_value("summary", "spark.app.id")).collect()] == ["app-1", None, None]


def test_date_path_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 7, 23, 59),)], "ts timestamp_ntz")
    assert df.select(cf.date_path("ts")).first()[0] == "2024/03/07"


def test_guarded_ratio_and_flags(spark):
    df = spark.createDataFrame([(3, 0), (3, 2), (None, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(cf.guarded_ratio(F.col("a"), F.col("b"))).collect()] == [None, 1.5, None]
    flags = spark.createDataFrame([(1,), (0,), (None,)], "x int").select(
        cf.flag_else_zero(F.col("x") == 1), cf.flag_or_null(F.col("x") == 1)).collect()
    assert [tuple(r) for r in flags] == [(1, 1), (0, None), (0, None)]


def test_pg_boolean_and_rounding(spark):
    df = spark.createDataFrame([("on",), ("OFF",), (" t ",), ("0",)], "v string")
    assert [r[0] for r in df.select(cf.parse_pg_boolean("v")).collect()] == [True, False, True, False]
    r = spark.createDataFrame([(0.5,), (1.5,), (-0.5,)], "d double").select(
        cf.round_half_even("d"), cf.float_to_int("d")).collect()
    assert [tuple(x) for x in r] == [(0.0, 0), (2.0, 2), (-0.0, 0)]
