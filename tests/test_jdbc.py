"""JDBC sources without a database: the reads they issue, recorded by a stand-in reader."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartlake.sources import jdbc


class Row(dict):
    def __getattr__(self, k):
        return self[k]


class FakeFrame:
    def __init__(self, rows):
        self.rows = rows

    def first(self):
        return self.rows[0] if self.rows else None

    def collect(self):
        return self.rows


class FakeReader:
    def __init__(self, bounds=(1, 1000), tables=("orders", "order_products__prior")):
        self.calls, self.bounds, self.tables = [], bounds, tables

    def jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None,
             properties=None, predicates=None):
        self.calls.append(dict(url=url, table=table, column=column, lower=lowerBound, upper=upperBound,
                               parts=numPartitions, props=dict(properties or {}),
                               predicates=predicates))
        if "MIN(" in table:
            return FakeFrame([Row(lo=self.bounds[0], hi=self.bounds[1])])
        if "information_schema" in table:
            return FakeFrame([Row(table_name=t) for t in self.tables])
        return FakeFrame([])


class FakeSpark:
    def __init__(self, reader):
        self.read = reader


def test_partitioned_full_load_reads_bounds_then_ranges():
    r = FakeReader(bounds=(5, 1004))
    jdbc.jdbc_full_load(FakeSpark(r), "jdbc:postgresql://h/db", "orders", partition_column="order_id",
                        num_partitions=16, properties={"user": "u"})
    bounds, load = r.calls
    assert "MIN(order_id)" in bounds["table"] and "FROM orders" in bounds["table"]
    assert (load["table"], load["column"], load["lower"], load["upper"], load["parts"]) == (
        "orders", "order_id", 5, 1005, 16)
    assert load["props"] == {"user": "u", "fetchsize": "10000"}


def test_unpartitioned_and_empty_tables_read_whole():
    r = FakeReader(bounds=(None, None))
    jdbc.jdbc_full_load(FakeSpark(r), "jdbc:x", "aisles", partition_column="aisle_id")
    assert r.calls[-1]["column"] is None and r.calls[-1]["table"] == "aisles"
    r2 = FakeReader()
    jdbc.jdbc_full_load(FakeSpark(r2), "jdbc:x", "aisles")
    assert len(r2.calls) == 1 and r2.calls[0]["column"] is None


def test_table_listing_and_warehouse_scan():
    r = FakeReader(tables=("orders", "order_products__prior"))
    names = jdbc.list_source_tables(FakeSpark(r), "jdbc:x", schema="public", like="order%")
    assert names == ["order_products__prior", "orders"]
    assert "table_schema = 'public'" in r.calls[0]["table"] and "LIKE 'order%'" in r.calls[0]["table"]
    frames = jdbc.warehouse_full_scan(FakeSpark(FakeReader()), "jdbc:x", ["products", "aisles"])
    assert sorted(frames) == ["aisles", "products"]


def test_predicates_cover_every_row_once(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 29)]
    rows = [(t, d, dt.datetime(2024, 1, 1, 12) + dt.timedelta(hours=5 * i))
            for i, (t, d) in enumerate(zip(["", "a", "it's", "m", "o'clock", "z", None] * 4, days))] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "t string, d date, ts timestamp")
    cases = {"t": ["a", "it's", "it's", "o'clock"], "d": [days[3], days[20]], "ts": [dt.datetime(2024, 1, 2, 3, 0, 1)]}
    for column, bounds in cases.items():
        fits = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in jdbc.range_predicates(column, bounds)]
        assert len(fits) == len(set(bounds)) + 1
        hits = df.select(sum(fits[1:], fits[0]).alias("n"), *(f.alias(f"p{i}") for i, f in enumerate(fits)))
        assert [r.n for r in hits.collect()] == [1] * len(rows)
        assert all(hits.agg(F.sum(f"p{i}")).first()[0] > 0 for i in range(len(fits)))
    assert jdbc.range_predicates("t", []) == ["1 = 1"]
    with pytest.raises(TypeError):
        jdbc.range_predicates("t", [1.5])


def test_predicates_reach_the_reader():
    r = FakeReader()
    parts = jdbc.range_predicates("name", ["h", "p"])
    jdbc.jdbc_full_load(FakeSpark(r), "jdbc:x", "products", predicates=parts)
    assert len(r.calls) == 1 and r.calls[0]["predicates"] == parts and r.calls[0]["column"] is None
    with pytest.raises(ValueError):
        jdbc.jdbc_full_load(FakeSpark(r), "jdbc:x", "products", predicates=parts, partition_column="product_id")
