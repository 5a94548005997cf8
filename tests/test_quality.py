"""Constraint checks on literal frames with NULLs, duplicates and over-long text."""

from cartlake.operators import quality as qc
from tests.conftest import rows


def test_key_violations_and_summary(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,), (3,)], "k int")
    assert rows(qc.key_violations(df, "k")) == sorted([(2, 2), (None, 2)], key=repr)
    s = qc.check_primary_key({"t": (df, "k")}).first()
    assert (s.n_rows, s.n_null_keys, s.n_duplicate_keys) == (6, 2, 1)


def test_composite_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 2)], "a int, b int")
    s = qc.check_composite_key({"t": (df, ["a", "b"])}).first()
    assert (s.key_columns, s.n_rows, s.n_null_keys, s.n_duplicate_keys) == ("a,b", 4, 1, 1)
    assert qc.key_violations(df, ["a", "b"]).count() == 2


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    out = {r.column_name: (r.n_rows, r.n_nulls) for r in qc.check_not_null({"t": (df, ["a", "b"])}).collect()}
    assert out == {"a": (3, 1), "b": (3, 2)}
    assert qc.null_violations(df, ["a", "b"]).count() == 2


def test_max_length_counts_characters(spark):
    df = spark.createDataFrame([("prior",), ("x" * 21,), ("é" * 20,), (None,)], "eval_set string")
    r = qc.check_max_length({"orders": (df, {"eval_set": 20})}).first()
    assert (r.max_length, r.longest, r.n_too_long) == (20, 21, 1)
    assert qc.length_violations(df, {"eval_set": 20}).count() == 1


def test_orphans_pre_aggregated(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (5,), (5,), (5,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "pk int")
    assert rows(qc.orphan_violations(child, "fk", parent, "pk")) == [(5, 3)]
    s = qc.check_orphans([("c", child, "fk", "p", parent, "pk")]).first()
    assert (s.n_orphan_keys, s.n_orphan_rows) == (1, 3)


def test_raw_layer_report_on_landed_fixture_is_clean(spark):
    from cartlake.sources import fixtures as fz
    sf = "/root/testdata/sf0.001"
    report = qc.check_raw_layer(fz.raw_tables(spark, sf), include_disabled=True)
    assert set(report) == {"primary_key", "not_null", "max_length", "composite_key", "orphans"}
    assert qc.violations_found(report).count() == 0
    assert report["orphans"].count() == 6 and report["primary_key"].count() == 4


def test_raw_layer_report_finds_dirty_rows(spark):
    orders = spark.createDataFrame(
        [(1, 1, "prior", 1, 0, 0, None), (1, 2, "x" * 30, 1, 0, 0, None), (2, None, "prior", 1, 0, 0, 3)],
        "order_id int, user_id int, eval_set string, order_number int, order_dow int, "
        "order_hour_of_day int, days_since_prior int")
    found = {(r.check, r.table_name) for r in qc.violations_found(qc.check_raw_layer({"orders": orders})).collect()}
    assert found == {("primary_key", "orders"), ("not_null", "orders"), ("max_length", "orders")}


def test_raw_layer_report_skips_absent_tables(spark):
    import pytest
    aisles = spark.createDataFrame([(1, "a")], "aisle_id int, aisle string")
    report = qc.check_raw_layer({"aisles": aisles}, include_disabled=True)
    assert set(report) == {"primary_key", "not_null", "max_length"}
    assert qc.violations_found(report).count() == 0
    with pytest.raises(ValueError):
        qc.violations_found(qc.check_raw_layer({}))
