"""The bronze -> silver feature job: six raw tables in, twelve published tables out.

Plan shape (what runs where):

* copies of products / aisles / departments / orders: scan -> write;
* order_products__prior / __train: scan -> flag normalisation -> write;
* order_products: by-name union of the two *published* normalised tables -> write;
* order_products_prior: published orders(prior) JOIN published order_products
  -> write; AQE picks broadcast or sort-merge from the measured sizes and
  splits skewed keys;
* user_features_1: partial + final aggregate of orders;
* the three basket features are read from the *published* order_products_prior
  (lineage cut; the scan reads only the six columns they need), aggregated once
  per (user, product) with a single shuffle, written as a Parquet scratch
  table under the shared checkpoint folder, and re-aggregated per user and
  per product from there (each reading only the columns it needs).

Tables are committed one at a time in a fixed order; the first failure stops
the job and leaves the tables committed so far in place.  Writes without a
dependency on an earlier output run as concurrent Spark jobs, so the small
tables do not leave a large cluster idle one after another.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from cartlake.operators import features as fx
from cartlake.operators.quality import check_raw_layer, violations_found
from cartlake.session import remove_path, workspace
from cartlake.sinks.versioned import VersionedTables
from cartlake.sources.catalog import read_table
from cartlake.sources.schema import RAW_COLUMNS  # noqa: F401  (re-exported)

log = logging.getLogger(__name__)

RAW_TABLES = ("order_products__train", "order_products__prior", "orders", "products",
              "departments", "aisles")

# Published tables, in publishing order.
SILVER_TABLES = ("products", "aisles", "departments", "orders", "order_products__prior",
                 "order_products__train", "order_products", "order_products_prior",
                 "user_features_1", "user_features_2", "up_features", "prd_features")

PAIR_COLUMNS = ("user_id", "product_id", "order_id", "order_number", "add_to_cart_order", "reordered")


class FeatureJob:
    def __init__(self, spark: SparkSession, raw_database: str, silver: VersionedTables,
                 raw_catalog: str | None = None):
        if not raw_database or not raw_database.strip():
            raise ValueError("raw_database is required")
        self.spark = spark
        self.raw_database = raw_database.strip()
        self.raw_catalog = raw_catalog
        self.silver = silver

    def read_raw(self) -> dict[str, DataFrame]:
        return {t: read_table(self.spark, self.raw_database, t, self.raw_catalog) for t in RAW_TABLES}

    def plans(self, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The first nine outputs as lazy plans (no job runs here)."""
        prior = fx.normalize_bool_flag(raw["order_products__prior"])
        train = fx.normalize_bool_flag(raw["order_products__train"])
        op = fx.order_products_union(prior, train)
        return {
            "products": raw["products"],
            "aisles": raw["aisles"],
            "departments": raw["departments"],
            "orders": raw["orders"],
            "order_products__prior": prior,
            "order_products__train": train,
            "order_products": op,
            "order_products_prior": fx.order_products_prior(raw["orders"], op),
            "user_features_1": fx.user_features_1(raw["orders"]),
        }

    def quality_gate(self, raw: dict[str, DataFrame]) -> None:
        """Raise if the raw tables break a declared constraint (keys, NOT NULL, lengths)."""
        bad = violations_found(check_raw_layer(raw)).collect()
        if bad:
            raise ValueError("raw layer violates declared constraints: "
                             + "; ".join(f"{r.check} {r.table_name} {r.detail}" for r in bad))

    def run(self, parallelism: int = 4, check_quality: bool = False,
            keep_versions: int | None = None) -> dict[str, int]:
        """Publish the twelve tables; commits happen in SILVER_TABLES order.

        Writes that do not depend on an earlier output are staged as
        concurrent Spark jobs (``parallelism`` at a time); each table is
        committed only after every table before it, so the first failure
        leaves exactly the earlier tables published.
        """
        raw = self.read_raw()
        if check_quality:
            self.quality_gate(raw)
        plans = self.plans(raw)
        published: dict[str, int] = {}
        scratch = None
        pool = ThreadPoolExecutor(max_workers=max(1, parallelism))
        staged = {}

        def stage(name: str, df: DataFrame) -> None:
            log.info("staging %s", name)
            staged[name] = pool.submit(self.silver.stage, name, df)

        def commit(name: str) -> None:
            published[name] = self.silver.commit(staged.pop(name).result())
            log.info("published %s", name)

        try:
            for name in ("products", "aisles", "departments", "orders", "order_products__prior",
                         "order_products__train", "user_features_1"):
                stage(name, plans[name])
            for name in SILVER_TABLES[:6]:
                commit(name)
            # Later stages read what earlier stages published: snappy, columnar,
            # already normalised, and no recomputation if an executor is lost.
            stage("order_products", fx.order_products_union(self.silver.table("order_products__prior"),
                                                            self.silver.table("order_products__train")))
            commit("order_products")
            stage("order_products_prior",
                  fx.order_products_prior(self.silver.table("orders"), self.silver.table("order_products")))
            commit("order_products_prior")
            commit("user_features_1")
            opp = self.silver.table("order_products_prior").select(*PAIR_COLUMNS)
            scratch = workspace(self.spark, "pair-stats")
            self.spark.sparkContext.setJobDescription("feature job: per (user, product) statistics")
            try:
                fx.pair_stats(opp).write.parquet(scratch)
            finally:
                self.spark.sparkContext.setJobDescription(None)
            stats = self.spark.read.parquet(scratch)
            stage("user_features_2", fx.user_features_2(stats))
            stage("up_features", fx.up_features(stats))
            stage("prd_features", fx.prd_features(stats))
            for name in SILVER_TABLES[9:]:
                commit(name)
        except Exception:
            log.exception("feature job failed after publishing %s", list(published))
            raise
        finally:
            pool.shutdown(wait=True, cancel_futures=True)
            if scratch is not None:
                remove_path(self.spark, scratch)
        if keep_versions:
            for name in published:
                self.silver.expire_versions(name, keep_versions)
        return published


def main(argv: list[str] | None = None) -> int:
    """spark-submit entry point; every location is a required argument (no defaults)."""
    import argparse

    from cartlake.session import ensure_checkpoint_dir, scale_conf
    from cartlake.sources.catalog import register_raw_layer

    ap = argparse.ArgumentParser(description="Publish the silver feature tables from the raw tables.")
    ap.add_argument("--raw-database", required=True, help="database holding the six raw tables")
    ap.add_argument("--raw-catalog", default=None, help="catalog of the raw database (default: session)")
    ap.add_argument("--raw-root", default=None,
                    help="landing folder; registers <raw-root>/public/<table> as the raw tables first")
    ap.add_argument("--silver-root", required=True, help="folder that receives the published tables")
    ap.add_argument("--silver-database", required=True, help="catalog database for the published tables")
    ap.add_argument("--parallelism", type=int, default=4, help="table writes staged at the same time")
    ap.add_argument("--check-quality", action="store_true",
                    help="refuse to publish when the raw tables break a declared constraint")
    ap.add_argument("--keep-versions", type=int, default=None,
                    help="after a successful run keep only this many versions of each table")
    ap.add_argument("--input-gb", type=float, default=None,
                    help="raw input size; sizes shuffle partitions and scan splits (session.scale_conf)")
    args = ap.parse_args(argv)
    if not args.silver_root.strip("/ "):
        raise SystemExit("--silver-root must not be empty")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("cartlake-feature-job").getOrCreate()
    try:
        ensure_checkpoint_dir(spark)
        if args.input_gb:
            for k, v in scale_conf(int(args.input_gb * 1024 ** 3)).items():
                spark.conf.set(k, v)   # runtime SQL settings only
        if args.raw_root:
            register_raw_layer(spark, args.raw_database, args.raw_root)
        silver = VersionedTables(spark, args.silver_root.rstrip("/"), args.silver_database)
        FeatureJob(spark, args.raw_database, silver, args.raw_catalog).run(
            parallelism=args.parallelism, check_quality=args.check_quality, keep_versions=args.keep_versions)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
