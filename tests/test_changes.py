"""Row-level changes: MERGE semantics (T8, T9), DELETE with NULLs, rounding (T5)."""

import pytest
from pyspark.sql import functions as F

from cartlake.operators import changes as ch
from cartlake.sources import fixtures as fz
from tests.conftest import SF_MID, rows

T_SCHEMA = "sku int, label string, shelf int, price double"


def target(spark):
    return spark.createDataFrame([(4, "oats", 10, 2.5), (7, "rye", 11, 3.5), (None, "loose", 12, 0.5), (None, "loose", 12, 0.5)], T_SCHEMA)


def test_merge_upsert_semantics(spark):
    u = spark.createDataFrame([(4, "oat flakes", 20, 2.75), (9, "millet", 21, 4.0), (None, "unsorted", 22, 1.0), (7, None, 23, 3.0)], T_SCHEMA)
    assert rows(ch.merge_upsert(target(spark), u, "sku")) == sorted([
        (4, "oat flakes", 20, 2.75),      # matched: updated
        (9, "millet", 21, 4.0),           # not matched: inserted
        (7, None, 23, 3.0),               # NULL source value overwrites
        (None, "loose", 12, 0.5),         # NULL target keys: untouched, each row kept
        (None, "loose", 12, 0.5),
        (None, "unsorted", 22, 1.0),      # NULL source key never matches: inserted
    ], key=repr)


def test_merge_keeps_unlisted_columns(spark):
    u = spark.createDataFrame([(4, "oat flakes", 20, 2.75), (9, "millet", 21, 4.0)], T_SCHEMA)
    got = {r.sku: r for r in ch.merge_upsert(target(spark), u, "sku", ["label"]).collect() if r.sku}
    assert (got[4].label, got[4].shelf, got[4].price) == ("oat flakes", 10, 2.5)
    assert (got[9].label, got[9].shelf) == ("millet", 21)  # insert takes every column
    with pytest.raises(ValueError):
        ch.merge_upsert(target(spark), u, "sku", ["sku"])


def test_merge_duplicate_source_keys(spark):
    dup_hit = spark.createDataFrame([(4, "a", 1, 1.0), (4, "b", 1, 1.0)], T_SCHEMA)
    merged = ch.merge_upsert(target(spark), dup_hit, "sku")
    for use in (merged.collect, merged.count, merged.select("shelf").collect):   # however little is asked for
        with pytest.raises(Exception, match="several source rows"):
            use()
    with pytest.raises(ch.MergeCardinalityError):
        ch.check_merge_cardinality(target(spark), dup_hit, "sku")
    # repeated keys that match nothing are just inserted, as often as they come
    dup_miss = spark.createDataFrame([(50, "a", 1, 1.0), (50, "b", 2, 2.0), (50, "b", 2, 2.0), (None, "c", 1, 1.0), (None, "c", 1, 1.0)], T_SCHEMA)
    ch.check_merge_cardinality(target(spark), dup_miss, "sku")
    got = rows(ch.merge_upsert(target(spark), dup_miss, "sku"))
    assert got == sorted([*rows(target(spark)), *rows(dup_miss)], key=repr)


def test_merge_casts_source_to_target_types_with_overflow_check(spark):
    from cartlake.sources.catalog import rows_to_df
    u = rows_to_df(spark, [{"sku": 4, "label": "oats", "shelf": 1, "price": 1.5}])
    assert dict(u.dtypes)["sku"] == "bigint"
    assert ch.merge_upsert(target(spark), u, "sku").dtypes == target(spark).dtypes
    big = rows_to_df(spark, [{"sku": 2**40, "label": "x", "shelf": 1, "price": 1.0}])
    with pytest.raises(Exception):
        ch.merge_upsert(target(spark), big, "sku").collect()
    with pytest.raises(ValueError):
        ch.merge_upsert(target(spark), u.drop("price"), "sku")


def test_merge_into_and_from_nothing(spark):
    none = spark.createDataFrame([], T_SCHEMA)
    assert rows(ch.merge_upsert(none, target(spark), "sku")) == rows(target(spark))
    assert rows(ch.merge_upsert(target(spark), none, "sku")) == rows(target(spark))
    keys_only = spark.createDataFrame([(1,), (2,)], "sku int")
    assert rows(ch.merge_upsert(keys_only, keys_only.limit(1), "sku")) == [(1,), (2,)]


def test_merge_with_clashing_column_names(spark):
    """Columns named like those the join makes keep their values."""
    sch = "t0 int, s0 string, n long, t_spread int, s_spread int"
    t = spark.createDataFrame([(1, "x", 5, 6, 7), (None, "y", 8, 9, 10)], sch)
    u = spark.createDataFrame([(1, "z", 15, 16, 17), (2, "w", 25, 26, 27)], sch)
    assert rows(ch.merge_upsert(t, u, "t0", ["s0", "n"])) == sorted([(1, "z", 15, 6, 7), (None, "y", 8, 9, 10), (2, "w", 25, 26, 27)], key=repr)


def test_merge_idempotent_on_fixture(spark):
    t, u = fz.product_target(spark, SF_MID), fz.product_updates(spark, SF_MID)
    once = ch.merge_upsert(t, u, "product_id")
    twice = ch.merge_upsert(once, u, "product_id")
    assert once.count() == 2100
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_merge_plan_reads_the_target_once_and_needs_no_single_task(spark):
    from cartlake.session import workspace
    path = workspace(spark, "t-merge-plan")
    fz.product_target(spark, SF_MID).write.parquet(path)
    t, u = spark.read.parquet(path), fz.product_updates(spark, SF_MID)
    merged = ch.merge_upsert(t, u, "product_id")
    merged.write.format("noop").mode("overwrite").save()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count(path.rsplit("/", 1)[-1]) == 1                       # one scan of the target
    assert initial.count("FullOuter") == 1 and "SinglePartition" not in plan
    assert len([x for x in initial.splitlines() if "HashAggregate" in x and "partial_count" in x]) <= 2   # the combination, and its reuse


def test_null_target_keys_are_spread_over_tasks(spark):
    wide = spark.range(4000).select(F.when(F.col("id") < 0, F.col("id")).cast("int").alias("sku"), F.col("id").cast("string").alias("label"),
                                    F.lit(1).alias("shelf"), F.lit(1.0).alias("price"))
    u = spark.createDataFrame([(4, "a", 1, 1.0)], T_SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ch.merge_upsert(wide, u, "sku").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in parts) == 4001 and max(r["count"] for r in parts) < 1000


def test_delete_keeps_rows_where_predicate_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, 25), (3, None)], "id int, d int")
    assert sorted(r.id for r in ch.delete_where(df, F.col("d") > 20).collect()) == [1, 3]
    assert sorted(r.id for r in ch.delete_where(df, "id == 1").collect()) == [2, 3]


def test_update_round_half_even_and_type_change(spark):
    df = spark.createDataFrame([(1, 2.5), (2, 3.5), (3, -2.5), (4, 7.0), (5, None), (6, 0.49)],
                               "id int, d float")
    r = ch.update_round(df, "d")
    assert dict(r.dtypes)["d"] == "float"
    assert dict((x.id, x.d) for x in r.collect()) == {1: 2.0, 2: 4.0, 3: -2.0, 4: 7.0, 5: None, 6: 0.0}
    a = ch.alter_column_type(df, "d", "int")
    assert dict(a.dtypes)["d"] == "int"
    assert dict((x.id, x.d) for x in a.collect()) == {1: 2, 2: 4, 3: -2, 4: 7, 5: None, 6: 0}
    s = ch.alter_column_type(spark.createDataFrame([("7",)], "v string"), "v", "int")
    assert s.first().v == 7


def test_alter_type_overflow_raises(spark):
    df = spark.createDataFrame([(1e12,)], "d double")
    with pytest.raises(Exception):
        ch.alter_column_type(df, "d", "int").collect()


def test_stamp_column_is_one_constant(spark):
    out = ch.stamp_column(spark.range(100), "updated_at")
    assert out.select("updated_at").distinct().count() == 1


def test_merge_sql_form_reaches_the_catalog(spark):
    """The mergeInto form is well-formed; the built-in parquet catalog then refuses
    row-level operations, which is why merge_upsert exists."""
    import uuid
    from cartlake.session import workspace
    name = f"t_merge_{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE TABLE {name} ({T_SCHEMA}) USING PARQUET LOCATION '{workspace(spark, 't-msql')}'")
    spark.createDataFrame([(4, "oats", 1, 1.0)], T_SCHEMA).createOrReplaceTempView("restock")
    with pytest.raises(Exception) as err:
        ch.merge_upsert_sql(spark, name, "restock", "sku", ["label", "shelf", "price"])
    assert "MERGE" in str(err.value).upper()


def test_delete_then_merge_restores(spark):
    t = fz.product_target(spark, SF_MID)
    removed = t.filter("product_id % 7 = 3")
    shrunk = ch.delete_where(t, "product_id % 7 = 3")
    assert shrunk.count() + removed.count() == t.count()
    restored = ch.merge_upsert(shrunk, removed, "product_id")
    assert restored.exceptAll(t).isEmpty() and t.exceptAll(restored).isEmpty()


def test_merge_on_composite_key(spark):
    sch = "order_id int, product_id int, add_to_cart_order int, reordered int"
    t = spark.createDataFrame([(1, 10, 1, 0), (1, 11, 2, 0), (2, 10, 1, 1), (None, 10, 9, 9)], sch)
    u = spark.createDataFrame([(1, 11, 5, 1), (3, 10, 1, 0), (None, 10, 7, 7)], sch)
    got = rows(ch.merge_upsert(t, u, ["order_id", "product_id"], ["add_to_cart_order"]))
    assert got == sorted([(1, 10, 1, 0), (1, 11, 5, 0), (2, 10, 1, 1), (None, 10, 9, 9),
                          (3, 10, 1, 0), (None, 10, 7, 7)], key=repr)
    with pytest.raises(Exception, match="several source rows"):
        ch.merge_upsert(t, u.unionByName(u.filter("order_id = 1")), ["order_id", "product_id"]).collect()
