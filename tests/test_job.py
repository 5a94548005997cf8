"""The feature job end to end: land, register, publish twelve tables; compare with the oracle."""

import pytest

from cartlake.plans import registry as R
from cartlake.plans.feature_job import SILVER_TABLES, FeatureJob
from cartlake.plans.oracle import with_fixtures, ORACLE_BODIES
from cartlake.session import workspace
from cartlake.sinks.versioned import VersionedTables
from check_oracle import digest, spark_rows
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def silver(spark):
    root = workspace(spark, "t-job")
    raw_db = R._land_raw(spark, SF_SMALL, root)
    tables = VersionedTables(spark, f"{root}/silver", "t_silver_job")
    published = FeatureJob(spark, raw_db, tables).run()
    assert list(published) == list(SILVER_TABLES)
    return tables


@pytest.mark.parametrize("table,key", [
    ("order_products_prior", "order_products_prior"), ("order_products", "order_products_union"),
    ("user_features_1", "user_features_1"), ("user_features_2", "user_features_2"),
    ("up_features", "up_features"), ("prd_features", "prd_features")])
def test_published_table_matches_oracle(spark, duck, silver, table, key):
    cols, got = spark_rows(silver.table(table))
    res = duck.execute(with_fixtures(ORACLE_BODIES[key]))
    ocols = [d[0] for d in res.description]
    assert cols == [c for c in ocols] or sorted(cols) == sorted(ocols)
    assert digest(cols, got) == digest(ocols, [tuple(r) for r in res.fetchall()])


def test_published_schemas(silver):
    assert dict(silver.table("prd_features").dtypes) == {
        "product_id": "int", "total_purchases": "bigint", "total_reorders": "bigint",
        "first_time_purchases": "bigint", "second_time_purchases": "bigint"}
    assert dict(silver.table("user_features_2").dtypes) == {
        "user_id": "int", "total_number_products": "bigint", "total_number_distinct_products": "bigint",
        "user_reorder_ratio": "double"}
    assert dict(silver.table("order_products__prior").dtypes)["reordered"] == "int"
    assert silver.table("order_products__prior").columns[-1] == "reordered"


def test_catalog_points_at_current_versions(spark, silver):
    for t in SILVER_TABLES:
        assert spark.table(f"{silver.database}.{t}").count() == silver.table(t).count()


def test_job_requires_raw_database(spark):
    with pytest.raises(ValueError):
        FeatureJob(spark, "  ", None)


def test_cli_requires_locations():
    from cartlake.plans.feature_job import main
    with pytest.raises(SystemExit):
        main(["--raw-database", "raw"])


def test_scale_conf_sizes_partitions():
    from cartlake.session import scale_conf
    assert scale_conf(100 * 1024 ** 4)["spark.sql.shuffle.partitions"] == "204800"   # 100 TiB
    assert scale_conf(10 * 1024 ** 4)["spark.sql.shuffle.partitions"] == "20480"     # 10 TiB
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "200"


def test_quality_gate_blocks_dirty_raw_layer(spark):
    root = workspace(spark, "t-gate")
    raw_db = R._land_raw(spark, SF_SMALL, root)
    tables = VersionedTables(spark, f"{root}/silver", "t_silver_gate")
    job = FeatureJob(spark, raw_db, tables)
    raw = job.read_raw()
    job.quality_gate(raw)                                  # the landed fixture is clean
    dirty = dict(raw, orders=raw["orders"].unionByName(raw["orders"].limit(1)))   # duplicate key
    with pytest.raises(ValueError, match="primary_key"):
        job.quality_gate(dirty)


def test_pair_stats_scan_of_published_table_is_pruned(silver):
    import re
    from cartlake.operators import features as fx
    from cartlake.plans.feature_job import PAIR_COLUMNS
    df = fx.pair_stats(silver.table("order_products_prior").select(*PAIR_COLUMNS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schemas) == 1
    assert sorted(c.split(":")[0] for c in schemas[0].split(",")) == sorted(PAIR_COLUMNS)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_spark_submit_end_to_end(spark, tmp_path):
    """The job as a cluster would run it: zipped package, spark-submit, raw tables
    registered from the landing folder, quality gate on."""
    import os
    import shutil
    import subprocess

    import pyspark
    root = workspace(spark, "t-submit")
    R._land_raw(spark, SF_SMALL, root)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    pkg = shutil.make_archive(str(tmp_path / "cartlake"), "zip", repo, "cartlake")
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    cmd = [submit, "--master", "local[2]", "--conf", "spark.ui.enabled=false", "--py-files", pkg,
           os.path.join(repo, "cartlake", "plans", "feature_job.py"),
           "--raw-database", "raw_submit", "--raw-root", f"{root}/raw",
           "--silver-root", f"{root}/silver", "--silver-database", "silver_submit", "--check-quality"]
    done = subprocess.run(cmd, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    tables = VersionedTables(spark, f"{root}/silver", "silver_submit", register=False)
    assert tables.table("prd_features").count() == 200
    assert tables.table("order_products_prior").count() == 5345
    assert [r.operation for r in tables.snapshots("user_features_2").collect()] == ["overwrite"]
    # a second run replaces every table and, with --keep-versions 1, drops the old data
    again = subprocess.run(cmd + ["--keep-versions", "1", "--input-gb", "1"], cwd=tmp_path,
                           capture_output=True, text=True, timeout=600)
    assert again.returncode == 0, again.stderr[-3000:]
    tables = VersionedTables(spark, f"{root}/silver", "silver_submit", register=False)
    assert tables.history("prd_features").count() == 2 and tables.table("prd_features").count() == 200
    old_id = tables.history("prd_features").orderBy("made_current_at").first().snapshot_id
    with pytest.raises(KeyError, match="expired"):
        tables.table("prd_features", old_id)


def test_job_leaves_no_scratch_behind(spark):
    import glob
    import os
    base = workspace(spark, "probe").rsplit("/", 1)[0]
    local = base[len("file:"):] if base.startswith("file:") else base
    before = set(glob.glob(os.path.join(local, "pair-stats-*")))
    root = workspace(spark, "t-scratch")
    raw_db = R._land_raw(spark, SF_SMALL, root)
    FeatureJob(spark, raw_db, VersionedTables(spark, f"{root}/silver", "t_silver_scratch")).run()
    assert set(glob.glob(os.path.join(local, "pair-stats-*"))) == before


RETRY_SCRIPT = r'''
import sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession
from cartlake.sinks.versioned import VersionedTables

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())

def fail_first_attempt(batches):
    ctx = TaskContext.get()
    for b in batches:
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            raise RuntimeError("simulated lost task")
        yield b

df = spark.range(0, 100000, numPartitions=4).mapInPandas(fail_first_attempt, "id long")
tables = VersionedTables(spark, sys.argv[2], "retry_db")
tables.publish("t", df)
out = tables.table("t")
print("RESULT", out.count(), out.distinct().count())
'''


def test_publish_survives_a_failed_task(spark, tmp_path):
    """A task that dies once is retried; the commit protocol keeps exactly one copy."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "retry.py"
    script.write_text(RETRY_SCRIPT)
    done = subprocess.run([sys.executable, str(script), repo, workspace(spark, "t-retry")],
                          cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "simulated lost task" in done.stderr          # the first attempt really failed
    assert "RESULT 100000 100000" in done.stdout


def test_raw_tables_through_a_named_catalog(spark):
    root = workspace(spark, "t-cat")
    raw_db = R._land_raw(spark, SF_SMALL, root)
    job = FeatureJob(spark, raw_db, VersionedTables(spark, f"{root}/silver", "t_silver_cat"),
                     raw_catalog="spark_catalog")
    raw = job.read_raw()
    assert raw["orders"].count() == 1500 and raw["order_products__prior"].count() == 5345
