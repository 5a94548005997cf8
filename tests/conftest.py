import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cartlake.session import build_session
    s = build_session(master="local[*]", app_name="cartlake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def products_by_hand(opp):
    """Expected product features of a small table, counted row by row."""
    seen, out = {}, {}
    for r in sorted(opp.collect(), key=lambda r: r.order_number):
        n = seen[r.user_id, r.product_id] = seen.get((r.user_id, r.product_id), 0) + 1
        t = out.setdefault(r.product_id, [0, 0, 0, 0])
        for i, hit in enumerate((True, r.reordered == 1, n == 1, n == 2)):
            t[i] += hit
    return sorted(((k, *v) for k, v in out.items()), key=repr)


def rows(df):
    """Collected rows as sorted tuples (order-insensitive comparison)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
