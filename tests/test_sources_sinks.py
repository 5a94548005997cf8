"""Sources and sinks: CSV typing (T4), catalog tables, landing layouts, versioned publishing (T10)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cartlake.operators import changes as ch
from cartlake.session import workspace
from cartlake.sinks import landing
from cartlake.sinks.versioned import VersionedTables, audit_log
from cartlake.sources import catalog as cat
from cartlake.sources import files
from cartlake.sources import fixtures as fz
from tests.conftest import SF_SMALL


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_boolean_spellings_like_copy(spark, tmp_path):
    p = tmp_path / "b.csv"
    p.write_text("order_id,reordered\n1,1\n2,0\n3,t\n4,FALSE\n5,yes\n6,off\n")
    df = files.csv_typed_load(spark, str(p), "order_id INT, reordered BOOLEAN")
    assert dict(df.collect()) == {1: True, 2: False, 3: True, 4: False, 5: True, 6: False}
    assert dict(df.dtypes) == {"order_id": "int", "reordered": "boolean"}


def test_csv_bad_boolean_or_number_fails_the_load(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("order_id,reordered\n1,maybe\n")
    with pytest.raises(Exception):
        files.csv_typed_load(spark, str(p), "order_id INT, reordered BOOLEAN").collect()
    q = tmp_path / "bad2.csv"
    q.write_text("order_id,reordered\nx,1\n")
    with pytest.raises(Exception):
        files.csv_typed_load(spark, str(q), "order_id INT, reordered BOOLEAN").collect()


def test_csv_gzip_round_trip(spark):
    path = workspace(spark, "t-gz") + "/o"
    src = fz.orders(spark, SF_SMALL)
    files.write_csv(src.withColumn("days_since_prior", F.col("days_since_prior").cast("float")), path, "gzip")
    assert any(f.endswith(".csv.gz") for f in os.listdir(_local(path)))
    back = files.csv_gzip_load(spark, path, "order_id INT, user_id INT, eval_set STRING, order_number INT, "
                                            "order_dow INT, order_hour_of_day INT, days_since_prior FLOAT")
    back = ch.alter_column_type(ch.update_round(back, "days_since_prior"), "days_since_prior", "int")
    assert back.exceptAll(src).isEmpty() and src.exceptAll(back).isEmpty()


def test_database_external_table_and_drop_keeps_files(spark):
    root = workspace(spark, "t-ext")
    db = "t_raw_ext"
    cat.create_database(spark, db, location=f"{root}/db")
    path = landing.parquet_landing_write(fz.products(spark, SF_SMALL), f"{root}/raw", "products")
    cols = [("product_id", "int"), ("product_name", "string"), ("aisle_id", "int"), ("department_id", "int")]
    t = cat.external_parquet_table(spark, "products", db, path, cols, compression="gzip")
    assert t.count() == 200
    assert cat.list_tables_like(spark, db, "prod%") == ["products"]
    assert cat.list_tables_like(spark, db, "order_%") == []
    spark.sql(f"DROP TABLE {db}.products")
    assert spark.read.parquet(path).count() == 200
    with pytest.raises(ValueError):
        cat.external_parquet_table(spark, "x", db, path, cols, compression="lz4")


def test_drop_create_table_and_views(spark):
    root = workspace(spark, "t-ddl")
    cat.drop_create_table(spark, "t_ddl_orders", [("order_id", "int"), ("eval_set", "string")],
                          location=f"{root}/t")
    spark.createDataFrame([(1, "prior")], "order_id int, eval_set string").write.insertInto("t_ddl_orders")
    cat.drop_create_table(spark, "t_ddl_orders", [("order_id", "int"), ("eval_set", "string")],
                          location=f"{root}/t2")
    assert spark.table("t_ddl_orders").count() == 0
    cat.temp_view(fz.products(spark, SF_SMALL), "shelf_list")
    assert spark.sql("SELECT count(*) AS n FROM (SELECT product_id FROM shelf_list) AS listed").first().n == 200


def test_landing_gzip_file_cap_and_overwrite(spark):
    root = workspace(spark, "t-land")
    src = fz.orders(spark, SF_SMALL)
    path = landing.parquet_landing_write(src, root, "orders", max_records=400)
    parts = [f for f in os.listdir(_local(path)) if f.endswith(".parquet")]
    assert all(".gz." in f for f in parts) and len(parts) >= 1500 // 400
    assert path.endswith("/public/orders")
    landing.drop_and_create_target(src.limit(10), root, "orders")
    assert spark.read.parquet(path).count() == 10
    assert landing.records_per_file(src, 128000 * 1024) > 100_000


def test_partitioned_landing_prunes(spark):
    root = workspace(spark, "t-part")
    path = landing.partitioned_landing(fz.orders(spark, SF_SMALL), root, "orders", ["eval_set"])
    assert sorted(d for d in os.listdir(_local(path)) if d.startswith("eval_set=")) == [
        "eval_set=prior", "eval_set=test", "eval_set=train"]
    q = spark.read.parquet(path).filter("eval_set = 'train'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eval_set" in plan
    assert q.count() == 75


def test_dated_export(spark):
    root = workspace(spark, "t-exp")
    path = landing.dated_batch_export(fz.orders(spark, SF_SMALL), root, "orders",
                                      run_date=dt.date(2025, 3, 7), max_records=600)
    assert path.endswith("/orders/2025/03/07")
    assert len([f for f in os.listdir(_local(path)) if f.endswith(".parquet")]) >= 3
    assert landing.dated_batch_export(fz.orders(spark, SF_SMALL).limit(0), root, "empty") is None
    assert not os.path.exists(_local(root) + "/empty")


def test_versioned_publish_history_and_time_travel(spark):
    tables = VersionedTables(spark, workspace(spark, "t-ver"), "t_silver_ver")
    s1 = tables.publish("products", fz.product_target(spark, SF_SMALL))
    # rebuild from the current version: never overwrites the files being read
    merged = ch.merge_upsert(tables.table("products"), fz.product_updates(spark, SF_SMALL), "product_id")
    s2 = tables.publish("products", merged)
    s3 = tables.publish("products", ch.delete_where(tables.table("products"), "product_id == 20"),
                        operation="delete")
    assert tables.table("products", s1).count() == 200
    assert tables.table("products", s2).count() == 210
    assert tables.table("products").count() == 209
    assert spark.table("t_silver_ver.products").count() == 209
    h = {r.snapshot_id: r for r in tables.history("products").collect()}
    assert h[s1].parent_id is None and h[s2].parent_id == s1 and h[s3].parent_id == s2
    snaps = {r.snapshot_id: r for r in tables.snapshots("products").collect()}
    assert snaps[s3].operation == "delete"
    assert snaps[s2].summary["added-records"] == "210"
    assert snaps[s1].summary["spark.app.id"] == spark.sparkContext.applicationId
    audit = audit_log(tables.history("products"), tables.snapshots("products")).collect()
    assert [r.snapshot_id for r in audit] == [s1, s2, s3]
    assert audit[0].spark_app_id == spark.sparkContext.applicationId


def test_failed_publish_keeps_previous_version(spark):
    tables = VersionedTables(spark, workspace(spark, "t-fail"), "t_silver_fail")
    tables.publish("t", spark.range(5))
    bad = spark.range(5).select((F.lit(1) / (F.col("id") - F.col("id"))).alias("id"))  # divide by zero
    with pytest.raises(Exception):
        tables.publish("t", bad)
    assert tables.table("t").count() == 5
    assert tables.history("t").count() == 1
    # a fresh reader (no cached state) sees the same current version
    assert VersionedTables(spark, tables.root, "t_silver_fail").table("t").count() == 5


def test_publish_all_parallel_stops_at_first_failure(spark):
    from cartlake.sinks.versioned import publish_all
    tables = VersionedTables(spark, workspace(spark, "t-pall"), "t_pall")
    bad = spark.range(5).select((F.lit(1) / (F.col("id") - F.col("id"))).alias("id"))
    with pytest.raises(Exception):
        publish_all(tables, [("a", spark.range(3)), ("b", bad), ("c", spark.range(4))], parallelism=3)
    assert tables.table("a").count() == 3
    assert tables.current("b") is None and tables.current("c") is None
    done = publish_all(tables, [("c", spark.range(4)), ("d", spark.range(2))], parallelism=2)
    assert list(done) == ["c", "d"] and tables.table("d").count() == 2


def test_catalog_pointer_follows_versions_and_schema_changes(spark):
    tables = VersionedTables(spark, workspace(spark, "t-ptr"), "t_ptr")
    tables.publish("t", spark.range(3))
    tables.publish("t", spark.range(5))                       # same schema: location swap
    assert spark.table("t_ptr.t").count() == 5
    tables.publish("t", spark.range(2).withColumn("x", F.lit("a")))   # new column: re-created entry
    assert spark.table("t_ptr.t").columns == ["id", "x"] and spark.table("t_ptr.t").count() == 2
    assert tables.table("t", tables.history("t").orderBy("made_current_at").first().snapshot_id).count() == 3


def test_full_load_and_export_column_case(spark):
    from cartlake.plans import registry as R
    root = workspace(spark, "t-full")
    db = R._land_raw(spark, SF_SMALL, root)
    paths = landing.full_load(spark, db, f"{root}/copy", "%", parallelism=3)
    assert sorted(paths) == ["aisles", "departments", "order_products__prior", "order_products__train",
                             "orders", "products"]
    assert spark.read.parquet(paths["orders"]).count() == 1500
    out = landing.dated_batch_export(spark.read.parquet(paths["aisles"]), root, "aisles",
                                     run_date=dt.date(2025, 1, 2), column_case="upper")
    assert spark.read.parquet(out).columns == ["AISLE_ID", "AISLE"]


def test_expire_versions_keeps_history(spark):
    tables = VersionedTables(spark, workspace(spark, "t-exp-v"), "t_expire")
    ids = [tables.publish("t", spark.range(n)) for n in (1, 2, 3, 4)]
    assert tables.expire_versions("t", keep_last=2) == ids[:2][::-1]
    assert tables.table("t").count() == 4 and tables.table("t", ids[2]).count() == 3
    with pytest.raises(KeyError, match="expired"):
        tables.table("t", ids[0])
    assert tables.history("t").count() == 4
    assert tables.expire_versions("t", keep_last=2) == []


def test_commit_time_is_an_absolute_instant(spark):
    import datetime as _d
    tables = VersionedTables(spark, workspace(spark, "t-tz"), "t_tz", register=False)
    before = _d.datetime.now(_d.timezone.utc).timestamp()
    tables.publish("t", spark.range(1))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        micros = tables.history("t").selectExpr("unix_micros(made_current_at) AS u").first().u
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert abs(micros / 1e6 - before) < 120


def test_register_raw_layer_refuses_missing_folders(spark):
    root = workspace(spark, "t-missing")
    landing.parquet_landing_write(fz.orders(spark, SF_SMALL), f"{root}/raw", "orders")
    with pytest.raises(FileNotFoundError, match="products"):
        cat.register_raw_layer(spark, "t_missing_raw", f"{root}/raw", db_location=f"{root}/db")


def test_landing_export_and_databases_are_parameters(spark):
    """T13 / T15: landing and export locations are independent, and the published
    database is a parameter (two databases under one root stay apart)."""
    root = workspace(spark, "t-params")
    src = fz.aisles(spark, SF_SMALL)
    landed = landing.parquet_landing_write(src, f"{root}/landing", "aisles")
    exported = landing.dated_batch_export(src, f"{root}/export", "aisles", run_date=dt.date(2025, 1, 1))
    assert landed.startswith(f"{root}/landing/") and exported.startswith(f"{root}/export/")
    a = VersionedTables(spark, f"{root}/silver", "t_params_a")
    b = VersionedTables(spark, f"{root}/silver", "t_params_b")
    a.publish("aisles", src)
    b.publish("aisles", src.limit(3))
    assert spark.table("t_params_a.aisles").count() == 50 and spark.table("t_params_b.aisles").count() == 3
