"""Relational-database sources read over JDBC.

Full loads of source tables (and the warehouse export's ``SELECT * FROM t``)
become partitioned JDBC reads: the table is split into ``num_partitions``
ranges of a numeric column, one task per range, so no single connection or
driver process moves the whole table.  ``fetchsize`` replaces cursor paging.

Tables without a numeric key are split by predicates over any ordered column
(``range_predicates``): texts, dates, timestamps.

The tests check the reads these functions issue, with a stand-in reader, and that the
predicates cover every row once; a running database is not used (see README).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def sql_literal(value) -> str:
    """A text, date, timestamp or number as an SQL literal."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no literal for {type(value).__name__}")


def range_predicates(column: str, bounds: list) -> list[str]:
    """Predicates that split a table at ``bounds`` of ``column``: every row fits exactly one, the NULLs the first.

    ``bounds`` must ascend in the database's own order of the column (for texts its collation), so take
    them from an ORDER BY there; repeated bounds count once.
    """
    cuts = [sql_literal(b) for b in dict.fromkeys(bounds)]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({column} IS NULL OR {column} < {cuts[0]})", *inner, f"{column} >= {cuts[-1]}"]


def jdbc_full_load(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
                   partition_column: str | None = None, lower_bound: int | None = None,
                   upper_bound: int | None = None, num_partitions: int = 8,
                   fetchsize: int = 10_000, predicates: list[str] | None = None) -> DataFrame:
    """All rows of ``table``; range-partitioned on ``partition_column``, or one partition for each of
    ``predicates`` (``range_predicates``), when given; not both.

    Bounds only shape the ranges (rows outside them still land in the edge
    partitions); when they are omitted they are read with one MIN/MAX query.
    """
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetchsize))
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give partition_column or predicates, not both")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower_bound is None or upper_bound is None:
        bounds = spark.read.jdbc(
            url, f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) b",
            properties=props).first()
        lower_bound, upper_bound = bounds["lo"], bounds["hi"]
        if lower_bound is None:  # empty table
            return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=int(lower_bound),
                           upperBound=int(upper_bound) + 1, numPartitions=num_partitions,
                           properties=props)


def list_source_tables(spark: SparkSession, url: str, schema: str = "public", like: str = "%",
                       properties: dict | None = None) -> list[str]:
    """Names of base tables in ``schema`` matching a LIKE pattern (information_schema)."""
    q = ("(SELECT table_name FROM information_schema.tables "
         f"WHERE table_schema = '{schema}' AND table_type = 'BASE TABLE' "
         f"AND table_name LIKE '{like}') t")
    return sorted(r["table_name"] for r in spark.read.jdbc(url, q, properties=dict(properties or {})).collect())


def warehouse_full_scan(spark: SparkSession, url: str, tables: list[str], **kw) -> dict[str, DataFrame]:
    """``SELECT * FROM t`` for each listed table, as partitioned JDBC reads."""
    return {t: jdbc_full_load(spark, url, t, **kw) for t in tables}
