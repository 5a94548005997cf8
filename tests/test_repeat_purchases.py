"""``reordered`` from the pairs bought again: the join goes away where nobody asks for it, rows stay the same."""

from conftest import SF_SMALL

from pyspark.sql import functions as F

from cartlake.plans import registry
from cartlake.sources import fixtures as fz


def test_reordered_equals_the_first_purchase_by_hand(spark):
    lines = fz.basket_lines(spark, SF_SMALL).collect()
    first = {}
    for r in lines:
        key = r.user_id, r.product_id
        first[key] = min(first.get(key, r.order_number), r.order_number)
    want = sorted((r.order_id, r.product_id, str(r.order_number > first[r.user_id, r.product_id]).lower()) for r in lines)
    got = fz.order_products_all(spark, SF_SMALL).select("order_id", "product_id", "reordered").collect()
    assert sorted(map(tuple, got)) == want and {w[2] for w in want} == {"true", "false"}


def test_lines_without_a_user_or_product_are_left_out(spark, monkeypatch):
    rows = [(1, 7, 1, "prior", 1, 1), (2, 7, 1, "prior", 2, 1), (3, None, 1, "prior", 1, 1), (4, 7, None, "prior", 1, 1)]
    rows = [(o, p, u, e, n, c) for o, u, p, e, n, c in rows]
    lines = spark.createDataFrame(rows, "order_id int, product_id int, user_id int, eval_set string, order_number int, "
                                        "add_to_cart_order int")
    monkeypatch.setattr(fz, "basket_lines", lambda *a: lines)
    got = fz.order_products_all(spark, SF_SMALL).orderBy("order_id").collect()
    assert [(r.order_id, r.reordered) for r in got] == [(1, "false"), (2, "true")]


def test_orphan_check_does_not_compute_reordered(spark):
    plan = registry.q_check_orphans(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "order_number" not in plan and "min(" not in plan.replace("min(l_", "")
    everything = fz.order_products_all(spark, SF_SMALL).groupBy("order_id").agg(F.count("*").alias("n"))
    assert "order_number" not in everything._jdf.queryExecution().optimizedPlan().toString()
