"""Basket tables are derived once by the queries that land or check them, with the rows of the plain derivation."""

from conftest import SF_SMALL, rows

from cartlake.plans import registry
from cartlake.sources import fixtures as fz


def test_landing_derives_the_baskets_once(spark, monkeypatch):
    want = rows(fz.order_products(spark, SF_SMALL, "prior"))
    calls, derive = [], fz.order_products_all
    monkeypatch.setattr(fz, "order_products_all", lambda *a, **k: calls.append(a) or derive(*a, **k))
    for query in (registry.q_drop_and_create_target, registry.q_external_parquet_table, registry.q_dated_batch_export):
        calls.clear()
        got = query(spark, SF_SMALL)
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == want and len(calls) == 1


def test_measuring_a_landing_reads_written_rows(spark, monkeypatch):
    from cartlake.sinks import landing
    measured, plain = [], landing.records_per_file

    def seen(df, max_bytes):
        measured.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, max_bytes)
    monkeypatch.setattr(landing, "records_per_file", seen)
    registry.q_drop_and_create_target(spark, SF_SMALL)
    assert len(measured) == 2 and not any("Exchange" in p or "Join" in p for p in measured)
