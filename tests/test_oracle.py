"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from cartlake.plans.oracle import oracle_sql
from cartlake.plans.registry import QUERIES
from check_oracle import digest, spark_rows
from tests.conftest import SF_SMALL

ORACLES = oracle_sql()
KEYS = sorted(QUERIES)


def test_every_query_has_an_oracle_or_a_reason():
    assert set(ORACLES) <= set(KEYS)
    assert set(KEYS) - set(ORACLES) == set()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    cols, got = spark_rows(QUERIES[key](spark, SF_SMALL))
    res = duck.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    want = [tuple(r) for r in res.fetchall()]
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(cols, got) == digest(ocols, want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_id", "total_purchases", "total_reorders", "first_time_purchases",
                          "second_time_purchases"]
    assert df.count() == 200


def test_schemas_stable_across_scales(spark):
    from tests.conftest import SF_MID
    qs = entry.queries()
    unstable = {k: (a, b) for k in KEYS
                for a, b in [(qs[k](spark, SF_SMALL).dtypes, qs[k](spark, SF_MID).dtypes)] if a != b}
    assert unstable == {}
