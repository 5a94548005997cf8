"""Runnable queries, one per operator: ``(spark, sf_dir) -> DataFrame``.

Each query derives its inputs from the generated tables under ``sf_dir``
(``cartlake.sources.fixtures``) and applies one operator to the whole input.
Queries that exercise sinks write under the shared checkpoint folder
(``cartlake.session.workspace``) and return a DataFrame read back from what was
written.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.functions import flag_else_zero, flag_or_null, guarded_ratio
from cartlake.operators import changes as ch
from cartlake.operators import features as fx
from cartlake.operators import quality as qc
from cartlake.plans.feature_job import SILVER_TABLES, FeatureJob
from cartlake.plans.oracle import TEST_EPOCH
from cartlake.session import workspace
from cartlake.sinks import landing
from cartlake.sinks.checked import checked_landing_write, load_report
from cartlake.sinks.versioned import VersionedTables, audit_log, create_or_replace_table
from cartlake.sources import catalog as cat
from cartlake.sources import files
from cartlake.sources import fixtures as fz
from cartlake.sources.schema import MAX_LENGTH, NOT_NULL, PRIMARY_KEYS, RAW_COLUMNS
from cartlake.streaming.changes import apply_changes, stream_changes
from cartlake.streaming.keyed import KeyedTable

Query = Callable[[SparkSession, str], DataFrame]


def _raw_baskets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """orders, order_products__prior, order_products__train (raw, text flags).

    Both basket tables are filters of one derived DataFrame, so their shared
    shuffles are planned once and reused."""
    o = fz.orders(spark, sf)
    everything = fz.order_products_all(spark, sf, o)
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    return (o, everything.filter(F.col("eval_set") == "prior").select(*cols),
            everything.filter(F.col("eval_set") == "train").select(*cols))


BASKET_COLUMNS = ["order_id", "product_id", "add_to_cart_order", "reordered"]


def _written_baskets(spark: SparkSession, sf: str, root: str, orders: DataFrame | None = None) -> Callable[[str], DataFrame]:
    """Both basket tables, derived once into a scratch table under ``root``: eval_set -> raw order_products."""
    scratch = f"{root}/_baskets"
    (fz.order_products_all(spark, sf, orders)
       .filter(F.col("eval_set").isin("prior", "train")).write.parquet(scratch))
    baskets = spark.read.parquet(scratch)
    return lambda eval_set: baskets.filter(F.col("eval_set") == eval_set).select(*BASKET_COLUMNS)


def _order_products(spark: SparkSession, sf: str) -> DataFrame:
    _, prior, train = _raw_baskets(spark, sf)
    return fx.order_products_union(fx.normalize_bool_flag(prior), fx.normalize_bool_flag(train))


def _opp(spark: SparkSession, sf: str) -> DataFrame:
    """order_products_prior built from the raw fixtures with the job's operators."""
    o, prior, train = _raw_baskets(spark, sf)
    op = fx.order_products_union(fx.normalize_bool_flag(prior), fx.normalize_bool_flag(train))
    return fx.order_products_prior(o, op)


def _uid() -> str:
    return uuid.uuid4().hex[:10]


# ------------------------------------------------------------------ projections / filters

def q_normalize_bool_flag(spark, sf):
    return fx.normalize_bool_flag(fz.flag_variants(spark, sf), "reordered")


def q_filter_eq(spark, sf):
    return fz.orders(spark, sf).filter(F.col("eval_set") == "prior")


def q_filter_not_null(spark, sf):
    return fz.orders(spark, sf).filter("days_since_prior IS NOT NULL")


def _landed_products(spark, sf):
    """products landed in the order of their id: bounds on it reach the scan and skip row groups."""
    path = landing.parquet_landing_write(fz.products(spark, sf), workspace(spark, "sorted"), "products", sort_by=["product_id"])
    return spark.read.parquet(path)


def q_filter_or(spark, sf):
    return _landed_products(spark, sf).filter("product_id < 25 OR product_id = 140 OR product_id > 1900")


def q_filter_range(spark, sf):
    return _landed_products(spark, sf).filter((F.col("product_id") > 120) & (F.col("product_id") < 170))


def q_delete_point(spark, sf):
    return ch.delete_where(_landed_products(spark, sf), "product_id = 140")


def q_case_flag_else(spark, sf):
    return _opp(spark, sf).select("order_id", "product_id",
                                  flag_else_zero(F.col("reordered") == 1).alias("reordered_flag"))


def q_case_flag_null(spark, sf):
    return _opp(spark, sf).select("order_id", "product_id",
                                  flag_or_null(F.col("order_number") > 1).alias("repeat_order_flag"))


def q_literal_column(spark, sf):
    return ch.stamp_column(fz.products(spark, sf), "updated_at", TEST_EPOCH)


# ------------------------------------------------------------------ union / join / features

def q_order_products_union(spark, sf):
    return _order_products(spark, sf)


def q_order_products_prior(spark, sf):
    return _opp(spark, sf)


def q_user_features_1(spark, sf):
    return fx.user_features_1(fz.orders(spark, sf))


def q_user_features_2(spark, sf):
    return fx.user_features_2(_opp(spark, sf))


def q_up_features(spark, sf):
    return fx.up_features(_opp(spark, sf))


def q_prd_features(spark, sf):
    return fx.prd_features(_opp(spark, sf))


def q_product_seq_time(spark, sf):
    # one row per (order, product) here, so a pair's group is at most its user's order count
    _, most_orders = fz.group_stats(spark, sf, "orders", "o_custkey")
    return fx.product_seq_time(_opp(spark, sf), max_group_rows=most_orders)


def q_product_seq_time_hot(spark, sf):
    """A third of all rows moved into one (user, product) pair, tied in order_number."""
    moved, path = F.col("order_id") % 3 == 0, workspace(spark, "hot-pair")
    opp = _opp(spark, sf)
    for c, v in (("user_id", 0), ("product_id", 0), ("order_number", 1)):
        opp = opp.withColumn(c, F.when(moved, F.lit(v)).otherwise(F.col(c)))
    opp.write.parquet(path)
    return fx.product_seq_time(spark.read.parquet(path), min_hot_rows=1)


def q_count_non_null(spark, sf):
    return fz.orders(spark, sf).groupBy("user_id").agg(F.count("days_since_prior").alias("n_known_gaps"))


def q_count_star(spark, sf):
    return _order_products(spark, sf).groupBy("order_id").agg(F.count("*").alias("basket_size"))


def q_conditional_sum(spark, sf):
    return _order_products(spark, sf).groupBy("order_id").agg(
        F.sum(flag_else_zero(F.col("reordered") == 1)).alias("reordered_items"))


def q_guarded_ratio(spark, sf):
    return _opp(spark, sf).groupBy("order_id").agg(
        guarded_ratio(F.sum(flag_else_zero(F.col("reordered") == 1)),
                      F.count(flag_or_null(F.col("order_number") > 1))).alias("reorder_ratio"))


def q_count_distinct(spark, sf):
    return _opp(spark, sf).groupBy("product_id").agg(F.countDistinct("user_id").alias("distinct_buyers"))


# ------------------------------------------------------------------ metadata join / ordering

def q_snapshot_audit_join(spark, sf):
    return audit_log(fz.history(spark, sf), fz.snapshots(spark, sf))


def q_order_by(spark, sf):
    return fz.history(spark, sf).orderBy("made_current_at")


def q_limit_show(spark, sf):
    return fz.products(spark, sf).orderBy("product_id").limit(5)


# ------------------------------------------------------------------ row-level changes

def q_merge_upsert(spark, sf):
    return ch.merge_upsert(fz.product_target(spark, sf), fz.product_updates(spark, sf), "product_id",
                           ["product_name", "aisle_id", "department_id", "updated_at"])


def q_merge_upsert_messy(spark, sf):
    """NULL keys on both sides, and new keys that come twice: all inserted, none matched."""
    return ch.merge_upsert(fz.messy_target(spark, sf), fz.messy_updates(spark, sf), "product_id")


#: a hand-written batch: one product that is there, one that is not
PRICE_LIST = ({"product_id": 88, "product_name": "pearl barley", "aisle_id": 4, "department_id": 7, "updated_at": 2.0},
              {"product_id": 5_000_001, "product_name": "buckwheat", "aisle_id": 5, "department_id": 7, "updated_at": 2.0})


def q_upsert_flow(spark, sf):
    """Literal rows and an update batch behind one view, a derived table of it as MERGE source."""
    target, batch = fz.product_target(spark, sf), fz.product_updates(spark, sf)
    view = f"restock_{_uid()}"
    cat.temp_view(batch.unionByName(cat.rows_to_df(spark, list(PRICE_LIST), target.schema)), view)
    return ch.merge_upsert(target, spark.sql(f"SELECT * FROM (SELECT * FROM {view}) AS listed"), "product_id")


def q_delete_where(spark, sf):
    return ch.delete_where(fz.orders(spark, sf), F.col("days_since_prior") > 20)


def _event_values(spark, sf):
    return fz.read(spark, sf, "events").select("event_id", F.col("value").cast("float").alias("value"))


def q_update_round(spark, sf):
    return ch.update_round(_event_values(spark, sf), "value")


def q_alter_column_type(spark, sf):
    return ch.alter_column_type(_event_values(spark, sf), "value", "int")


def q_alter_column_type_bigint(spark, sf):
    return ch.alter_column_type(_event_values(spark, sf), "value", "bigint")


# ------------------------------------------------------------------ quality checks

def q_check_primary_key(spark, sf):
    return qc.check_primary_key({
        "orders": (fz.orders(spark, sf), PRIMARY_KEYS["orders"]),
        "products": (fz.products(spark, sf), PRIMARY_KEYS["products"]),
        "aisles": (fz.aisles(spark, sf), PRIMARY_KEYS["aisles"]),
        "departments": (fz.departments(spark, sf), PRIMARY_KEYS["departments"]),
        "product_updates": (fz.product_updates(spark, sf), PRIMARY_KEYS["products"]),
    })


def q_check_composite_key(spark, sf):
    return qc.check_composite_key({
        "order_products": (_order_products(spark, sf), ["order_id", "product_id"]),
        "lineitem": (fz.flag_variants(spark, sf), ["order_id", "product_id"]),
    })


def q_check_not_null(spark, sf):
    return qc.check_not_null({
        "orders": (fz.orders(spark, sf), NOT_NULL["orders"]),
        "product_updates": (fz.product_updates(spark, sf), NOT_NULL["products"]),
        "order_products_raw": (fz.flag_variants(spark, sf), NOT_NULL["order_products__prior"]),
    })


def q_checked_full_load(spark, sf):
    """Raw tables landed with their constraints counted by the write itself."""
    root = workspace(spark, "checked")
    loads = [checked_landing_write(df, root, name, not_null=NOT_NULL[declared], limits=MAX_LENGTH.get(declared, {}), max_records=1_000_000)
             for name, declared, df in (("orders", "orders", fz.orders(spark, sf)),
                                        ("product_updates", "products", fz.product_updates(spark, sf)),
                                        ("order_products_raw", "order_products__prior", fz.flag_variants(spark, sf)))]
    loads.append(checked_landing_write(fz.read(spark, sf, "documents"), root, "documents", max_records=1_000_000,
                                       not_null=["text", "lang"], limits={"text": 2000, "source": 8}))
    return load_report(spark, loads)


def q_check_max_length(spark, sf):
    return qc.check_max_length({
        "orders": (fz.orders(spark, sf), MAX_LENGTH["orders"]),
        "products": (fz.products(spark, sf), MAX_LENGTH["products"]),
        "aisles": (fz.aisles(spark, sf), MAX_LENGTH["aisles"]),
        "departments": (fz.departments(spark, sf), MAX_LENGTH["departments"]),
        "product_updates": (fz.product_updates(spark, sf), MAX_LENGTH["products"]),
    })


def q_check_orphans(spark, sf):
    products, aisles, departments = fz.products(spark, sf), fz.aisles(spark, sf), fz.departments(spark, sf)
    op, orders, updates = _order_products(spark, sf), fz.orders(spark, sf), fz.product_updates(spark, sf)
    return qc.check_orphans([
        ("products", products, "aisle_id", "aisles", aisles, "aisle_id"),
        ("products", products, "department_id", "departments", departments, "department_id"),
        ("order_products", op, "order_id", "orders", orders, "order_id"),
        ("order_products", op, "product_id", "products", products, "product_id"),
        ("product_updates", updates, "aisle_id", "aisles", aisles, "aisle_id"),
        ("product_updates", updates, "department_id", "departments", departments, "department_id"),
    ])


# ------------------------------------------------------------------ sources / sinks (round trips)

ORDERS_CSV_SCHEMA = ("order_id INT, user_id INT, eval_set STRING, order_number INT, order_dow INT, "
                     "order_hour_of_day INT, days_since_prior FLOAT")
BASKET_CSV_SCHEMA = "order_id INT, product_id INT, add_to_cart_order INT, reordered BOOLEAN"


def q_csv_typed_load(spark, sf):
    """Orders as CSV text (days as REAL, e.g. '8.0') -> typed load."""
    path = workspace(spark, "csv") + "/orders"
    src = fz.orders(spark, sf).withColumn("days_since_prior", F.col("days_since_prior").cast("float"))
    files.write_csv(src, path)
    return files.csv_typed_load(spark, path, ORDERS_CSV_SCHEMA)


def q_csv_quoted_load(spark, sf):
    """Whole document texts in COPY's CSV form, made by SQL text functions and not by the CSV
    writer: quotes doubled, line breaks inside fields, "" for an empty string, a gap for NULL.
    (Carriage returns become spaces first: the reader takes them for line breaks.)"""
    path = workspace(spark, "csvq") + "/documents"
    d = fz.read(spark, sf, "documents")
    text = F.when(F.col("doc_id") % 5 == 1, F.lit("")).when(F.col("doc_id") % 5 != 2, F.regexp_replace("text", "\r", " "))
    field = F.coalesce(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
    line = F.concat(F.col("doc_id").cast("string"), F.lit(","), field, F.lit(","), F.coalesce(F.col("lang"), F.lit("")))
    # a file per shuffle partition, each with a header line
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = d.select(F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part"), "doc_id", line.alias("line"))
    head = rows.select("part").distinct().select("part", F.lit(None).cast("long").alias("doc_id"), F.lit("doc_id,text,lang").alias("line"))
    both = rows.unionByName(head).repartition("part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first())
    both.select("part", F.col("line").alias("value")).write.partitionBy("part").text(path)
    return files.csv_typed_load(spark, f"{path}/part=*", "doc_id LONG, text STRING, lang STRING", multiline=True)


def q_csv_gzip_load(spark, sf):
    """Prior baskets as gzip CSV with the flag spelled 1/0 -> typed load with BOOLEAN."""
    path = workspace(spark, "csvgz") + "/order_products__prior"
    src = fz.order_products(spark, sf, "prior").withColumn(
        "reordered", F.when(F.col("reordered") == "true", F.lit("1")).otherwise(F.lit("0")))
    files.write_csv(src, path, compression="gzip")
    return files.csv_gzip_load(spark, path, BASKET_CSV_SCHEMA)


def _land_raw(spark, sf, root: str) -> str:
    """Land the six raw tables as gzip Parquet under ``root/raw/public/<table>`` and
    register them as external tables; returns the raw database name.

    The four small tables are written concurrently.  orders is landed first and
    the baskets are derived once from the landed copy into a scratch table,
    from which both basket tables are landed.
    """
    raw = f"{root}/raw"
    small = (("orders", fz.orders(spark, sf)), ("products", fz.products(spark, sf)),
             ("aisles", fz.aisles(spark, sf)), ("departments", fz.departments(spark, sf)))
    with ThreadPoolExecutor(max_workers=len(small)) as pool:     # independent writes run together
        futures = {name: pool.submit(landing.parquet_landing_write, df, raw, name) for name, df in small}
        paths = {name: f.result() for name, f in futures.items()}
    baskets = _written_baskets(spark, sf, root, spark.read.parquet(paths["orders"]))
    with ThreadPoolExecutor(max_workers=2) as pool:
        for f in [pool.submit(landing.parquet_landing_write,
                              baskets(e), raw, f"order_products__{e}")
                  for e in ("prior", "train")]:
            f.result()
    db = f"raw_{_uid()}"
    cat.register_raw_layer(spark, db, raw, db_location=f"{root}/_db/{db}")
    return db


def q_external_parquet_table(spark, sf):
    root = workspace(spark, "ext")
    path = landing.parquet_landing_write(_written_baskets(spark, sf, root)("prior"), f"{root}/raw",
                                         "order_products__prior")
    db = f"raw_{_uid()}"
    cat.create_database(spark, db, location=f"{root}/_db/{db}")
    return cat.external_parquet_table(spark, "order_products__prior", db, path,
                                      RAW_COLUMNS["order_products__prior"], compression="gzip")


def q_parquet_landing_write(spark, sf):
    root = workspace(spark, "landing")
    path = landing.parquet_landing_write(fz.orders(spark, sf), root, "orders", max_records=5000)
    return spark.read.parquet(path)


def q_landing_byte_cap(spark, sf):
    """Whole documents landed under a cap of 100 KB a file; the rows read back."""
    path = landing.parquet_landing_write(fz.read(spark, sf, "documents"), workspace(spark, "landing-cap"), "documents", max_file_kb=100)
    return spark.read.parquet(path)


def q_drop_and_create_target(spark, sf):
    root = workspace(spark, "reload")
    baskets = _written_baskets(spark, sf, root)
    landing.drop_and_create_target(baskets("train"), root, "order_products")
    path = landing.drop_and_create_target(baskets("prior"), root, "order_products")
    return spark.read.parquet(path)


def q_partitioned_landing(spark, sf):
    root = workspace(spark, "parts")
    src = fz.orders(spark, sf)
    path = landing.partitioned_landing(src, root, "orders", ["eval_set"])
    return spark.read.parquet(path).select(*src.columns)


def q_partition_reload(spark, sf):
    """All orders landed by eval_set, then one eval_set loaded again with later hours: the others stay."""
    root, src = workspace(spark, "reload-parts"), fz.orders(spark, sf)
    landing.partitioned_landing(src, root, "orders", ["eval_set"])
    again = src.filter("eval_set = 'train'").withColumn("order_hour_of_day", F.col("order_hour_of_day") + 100)
    path = landing.partitioned_landing(again, root, "orders", ["eval_set"], reload=True)
    return spark.read.parquet(path).select(*src.columns)


def q_drop_create_table(spark, sf):
    """Create with the declared columns, load, drop and create again, load all orders, read."""
    root, name = workspace(spark, "ddl"), f"orders_{_uid()}"
    src = fz.orders(spark, sf)
    for i in (1, 2):
        cat.drop_create_table(spark, name, [("order_id", "int"), ("user_id", "int"), ("eval_set", "varchar(20)"), ("order_number", "int"),
                                            ("order_dow", "int"), ("order_hour_of_day", "int"), ("days_since_prior", "int")], f"{root}/{i}")
        loaded = cat.load_table(src, name, not_null=tuple(NOT_NULL["orders"]))
    return loaded


def q_dated_batch_export(spark, sf):
    root = workspace(spark, "export")
    path = landing.dated_batch_export(_written_baskets(spark, sf, root)("prior"), root, "order_products__prior",
                                      run_date=_dt.date(2024, 1, 2))
    return spark.read.parquet(path)


def q_select_tables_like(spark, sf):
    """Full load of every raw table whose name matches 'order_products%' (copied
    concurrently), with the digest of each copy's contents."""
    root = workspace(spark, "like")
    db = _land_raw(spark, sf, root)
    paths = landing.full_load(spark, db, f"{root}/copy", "order_products%")
    return _digests({name: spark.read.parquet(path) for name, path in sorted(paths.items())})


def _digests(tables: dict[str, DataFrame]) -> DataFrame:
    return qc._union_all([qc.content_digest(df).select(F.lit(name).alias("table_name"), "n_rows", "digest")
                          for name, df in tables.items()])


def q_create_or_replace_table(spark, sf):
    root = workspace(spark, "replace")
    tables = VersionedTables(spark, root, f"silver_{_uid()}")
    create_or_replace_table(tables, "products", fz.products(spark, sf))
    current = tables.table("products")
    # Rebuild the table from its own current version (no in-place overwrite).
    create_or_replace_table(tables, "products", ch.stamp_column(current, "updated_at", TEST_EPOCH))
    return tables.table("products")


def q_publish_all(spark, sf):
    """End to end: land raw tables, register them, run the feature job; the digest of each
    published table's contents."""
    root = workspace(spark, "job")
    raw_db = _land_raw(spark, sf, root)
    silver = VersionedTables(spark, f"{root}/silver", f"silver_{_uid()}")
    FeatureJob(spark, raw_db, silver).run()
    return _digests({t: silver.table(t) for t in SILVER_TABLES})


def q_apply_changes(spark, sf):
    return apply_changes(fz.product_target(spark, sf), fz.product_changes(spark, sf), "product_id")


def _landed_feed(changes: DataFrame, root: str) -> str:
    """The change feed as files under one folder per batch (sequences above 3 arrive with the last)."""
    changes.withColumn("batch", F.least("seq", F.lit(4))).write.partitionBy("batch").parquet(f"{root}/incoming")
    return f"{root}/incoming/batch=*"


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def q_apply_changes_stream(spark, sf):
    """The change feed applied by a stream, a published version per micro-batch."""
    root = workspace(spark, "cdc")
    changes = fz.product_changes(spark, sf)
    feed = _landed_feed(changes, root)
    tables = VersionedTables(spark, f"{root}/tables", f"cdc_{_uid()}")
    tables.publish("products", fz.product_target(spark, sf))
    _finish(stream_changes(spark, feed, changes.schema, tables, "products", "product_id", checkpoint=f"{root}/_checkpoint",
                           files_per_batch=4))
    return tables.table("products")


def q_apply_changes_keyed(spark, sf):
    """A feed with NULL keys streamed into a table in key buckets, then replayed whole in one batch."""
    root = workspace(spark, "keyed")
    target, changes = fz.product_target(spark, sf), fz.messy_changes(spark, sf)
    feed = _landed_feed(changes, root)
    table = KeyedTable(spark, f"{root}/products", target.schema, "product_id", buckets=16)
    table.load(target)
    _finish(table.stream(feed, changes.schema, f"{root}/_checkpoint", files_per_batch=8))
    table.apply(changes)
    return table.read()


# key -> query; the comment names the SURVEY §2 inventory id(s) it exercises.
QUERIES: dict[str, Query] = {
    "normalize_bool_flag": q_normalize_bool_flag,         # P1, P3
    "filter_eq": q_filter_eq,                             # P6
    "filter_not_null": q_filter_not_null,                 # P7
    "filter_or": q_filter_or,                             # P8
    "filter_range": q_filter_range,                       # P9
    "case_flag_else": q_case_flag_else,                   # P12
    "case_flag_null": q_case_flag_null,                   # P13
    "literal_column": q_literal_column,                   # P14
    "order_products_union": q_order_products_union,       # U1
    "order_products_prior": q_order_products_prior,       # J1, P4
    "user_features_1": q_user_features_1,                 # A1
    "user_features_2": q_user_features_2,                 # A2, A8, A9
    "up_features": q_up_features,                         # A3
    "prd_features": q_prd_features,                       # A4
    "product_seq_time": q_product_seq_time,               # W1
    "product_seq_time_hot": q_product_seq_time_hot,       # W1: a hot, tied pair
    "count_non_null": q_count_non_null,                   # A5
    "count_star": q_count_star,                           # A6
    "conditional_sum": q_conditional_sum,                 # A7
    "guarded_ratio": q_guarded_ratio,                     # A8
    "count_distinct": q_count_distinct,                   # A9
    "snapshot_audit_join": q_snapshot_audit_join,         # J2
    "order_by": q_order_by,                               # O1
    "limit_show": q_limit_show,                           # O2
    "merge_upsert": q_merge_upsert,                       # D1
    "merge_upsert_messy": q_merge_upsert_messy,           # D1, J3: NULL and repeated keys
    "upsert_flow": q_upsert_flow,                         # K15, K16, P15, D1
    "delete_where": q_delete_where,                       # D2
    "delete_point": q_delete_point,                       # P10, D2
    "update_round": q_update_round,                       # D3
    "alter_column_type": q_alter_column_type,             # D4
    "alter_column_type_bigint": q_alter_column_type_bigint,  # D4
    "check_primary_key": q_check_primary_key,             # Q1
    "check_composite_key": q_check_composite_key,         # Q5
    "check_not_null": q_check_not_null,                   # Q2
    "check_max_length": q_check_max_length,               # Q3
    "checked_full_load": q_checked_full_load,             # K8 with Q2, Q3
    "check_orphans": q_check_orphans,                     # Q4
    "apply_changes": q_apply_changes,                     # §2.11
    "apply_changes_stream": q_apply_changes_stream,       # §2.11
    "apply_changes_keyed": q_apply_changes_keyed,         # §2.11: key buckets, NULL keys, replay
    # sources / sinks
    "csv_typed_load": q_csv_typed_load,                   # K4
    "csv_quoted_load": q_csv_quoted_load,                 # K4: quotes, line breaks, "" and NULL
    "csv_gzip_load": q_csv_gzip_load,                     # K5
    "external_parquet_table": q_external_parquet_table,   # K1, K2, K3
    "parquet_landing_write": q_parquet_landing_write,     # K8
    "landing_byte_cap": q_landing_byte_cap,               # K8: bytes measured
    "drop_and_create_target": q_drop_and_create_target,   # K9
    "partitioned_landing": q_partitioned_landing,         # K14
    "partition_reload": q_partition_reload,               # K9, K14
    "drop_create_table": q_drop_create_table,             # K18
    "dated_batch_export": q_dated_batch_export,           # K13
    "select_tables_like": q_select_tables_like,           # K7
    "create_or_replace_table": q_create_or_replace_table, # K10
    "publish_all": q_publish_all,                         # K11
}
