"""Constraint counts taken by the landing write itself."""

import pytest

from cartlake.operators import quality as qc
from cartlake.sinks import checked

SCHEMA = "product_id int, product_name string, aisle_id int, department_id int"
ROWS = [(1, "tea", 1, 1), (2, None, 1, None), (3, "x" * 256, None, 2), (4, "é" * 255, 2, 2), (4, "", 2, 2)]


def test_counts_equal_the_checks(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    load = checked.checked_landing_write(df, str(tmp_path), "products", max_records=2)
    back = spark.read.parquet(load.path)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    got = {(r[1], r[2]): r[3:] for r in load.rows}
    for r in qc.check_not_null({"products": (back, ["product_name", "aisle_id", "department_id"])}).collect():
        assert got["not_null", r.column_name] == (r.n_rows, None, None, r.n_nulls)
    r = qc.check_max_length({"products": (back, {"product_name": 255})}).first()
    assert got["max_length", "product_name"] == (5, r.max_length, r.longest, r.n_too_long) == (5, 255, 256, 1)
    with pytest.raises(checked.ConstraintViolation, match="product_name: 1 rows break max_length"):
        checked.require_clean([load])
    checked.require_clean([checked.CheckedLoad("p", [("t", "not_null", "c", 3, None, None, 0)])])


def test_empty_table_partitions_and_odd_names(spark, tmp_path):
    load = checked.checked_landing_write(spark.createDataFrame([], SCHEMA), str(tmp_path), "products", max_records=9)
    assert [r[3:] for r in load.rows] == [(0, None, None, 0)] * 3 + [(0, 255, None, 0)] and not load.violations()
    odd = spark.createDataFrame([("a", None), ("b", "long"), (None, "x")], "`n_rows` string, `a.b` string")
    load = checked.checked_landing_write(odd, str(tmp_path), "odd", not_null=["n_rows", "a.b"], limits={"a.b": 3},
                                         partition_by=["n_rows"], sort_by=None)
    assert [(r[2], *r[3:]) for r in load.rows] == [("n_rows", 3, None, None, 1), ("a.b", 3, None, None, 1), ("a.b", 3, 3, 4, 1)]
    assert checked.load_report(spark, [load]).count() == 3


def test_counts_over_many_files(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "IF(id % 10 = 0, NULL, CAST(id AS string)) AS s")
    load = checked.checked_landing_write(df, str(tmp_path), "t", not_null=["s"], limits={"s": 2}, max_records=100)
    assert [r[3:] for r in load.rows] == [(1000, None, None, 100), (1000, 2, 3, 810)]
