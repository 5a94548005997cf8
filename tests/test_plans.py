"""Physical-plan properties: pushdown, pruning, shuffle counts, no window where none is needed."""

import re

import pytest

from cartlake.operators import features as fx
from cartlake.plans import registry as R
from cartlake.session import workspace
from cartlake.sources.catalog import read_table
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(p: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", p)


@pytest.fixture(scope="module")
def raw(spark):
    db = R._land_raw(spark, SF_SMALL, workspace(spark, "t-plans"))
    return {t: read_table(spark, db, t) for t in ("orders", "order_products__prior", "order_products__train")}


def test_eval_set_filter_reaches_orders_scan(raw):
    p = plan(fx.order_products_prior(raw["orders"], fx.order_products_union(
        fx.normalize_bool_flag(raw["order_products__prior"]),
        fx.normalize_bool_flag(raw["order_products__train"]))))
    assert "EqualTo(eval_set,prior)" in p


def test_user_features_1_reads_three_columns(raw):
    schemas = read_schemas(plan(fx.user_features_1(raw["orders"])))
    assert schemas == ["struct<user_id:int,order_number:int,days_since_prior:int>"]


def test_pair_stats_one_exchange_and_partial_aggregate(raw):
    opp = fx.order_products_prior(raw["orders"], fx.normalize_bool_flag(raw["order_products__prior"]))
    p = plan(fx.pair_stats(opp))
    agg_exchanges = re.findall(r"Exchange hashpartitioning\(user_id#\d+, product_id#\d+", p)
    assert len(agg_exchanges) == 1
    assert "partial_count" in p or "partial_sum" in p


def test_prd_features_has_no_window(raw):
    opp = fx.order_products_prior(raw["orders"], fx.normalize_bool_flag(raw["order_products__prior"]))
    assert "Window" not in plan(fx.prd_features(opp))


def test_features_scan_prunes_columns(raw):
    opp = fx.order_products_prior(raw["orders"], fx.normalize_bool_flag(raw["order_products__prior"]))
    for s in read_schemas(plan(fx.user_features_2(opp))):
        assert "order_dow" not in s and "order_hour_of_day" not in s and "days_since_prior" not in s


def test_partial_aggregation_before_shuffle_for_quality_checks(spark):
    from cartlake.operators import quality as qc
    from cartlake.sources import fixtures as fz
    p = plan(qc.check_orphans([("p", fz.products(spark, SF_SMALL), "aisle_id", "a",
                                fz.aisles(spark, SF_SMALL), "aisle_id")]))
    assert "partial_count" in p
