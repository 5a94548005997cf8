"""Landing writes that check NOT NULL and VARCHAR(n) while they write.

The counts are observed metrics of the write itself (``DataFrame.observe``), so a full load is
checked without a second scan.  The observation stands right before the files are written, in
the job's last stage: Spark counts a partition's metrics once, from the attempt that succeeded,
so retried or speculative tasks do not count twice.

Key checks need a shuffle and stay jobs of their own (``operators.quality``); they read only
the key columns of the landed files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartlake.sinks.landing import parquet_landing_write
from cartlake.sources import schema

REPORT = ("table_name string, check string, column_name string, n_rows bigint, max_length int, "
          "longest int, n_violations bigint")


@dataclass(frozen=True)
class CheckedLoad:
    """A landed table: its path and one row per declared constraint, in the order of REPORT."""
    path: str
    rows: list[tuple]

    def violations(self) -> list[tuple]:
        return [r for r in self.rows if r[-1] > 0]


class ConstraintViolation(ValueError):
    """A load brought rows that break a declared constraint."""


def constraint_metrics(not_null: list[str], limits: dict[str, int]) -> list[Column]:
    """The aggregates a write observes; named by position, so any column name will do."""
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    metrics += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(not_null)]
    for i, (c, n) in enumerate(limits.items()):
        length = F.length(F.col(f"`{c}`"))
        metrics += [F.max(length).alias(f"longest_{i}"), F.count_if(length > n).alias(f"over_{i}")]
    return metrics


def checked_landing_write(df: DataFrame, root: str, table: str, *, not_null: list[str] | None = None,
                          limits: dict[str, int] | None = None, **kw) -> CheckedLoad:
    """``parquet_landing_write`` that also counts the rows breaking a constraint.

    Without ``not_null`` / ``limits`` the raw layer's declarations for ``table`` hold.  A NULL has no
    length and breaks no VARCHAR(n); an empty table has zero counts and no longest value.  Give
    ``max_records`` to save the aggregate that measures row widths: the table is then read once.
    """
    not_null = schema.NOT_NULL.get(table, []) if not_null is None else not_null
    limits = schema.MAX_LENGTH.get(table, {}) if limits is None else limits
    seen = Observation()
    path = parquet_landing_write(df, root, table, observe=(seen, constraint_metrics(not_null, limits)), **kw)
    got = seen.get
    n = got.get("n_rows", 0)
    rows = [(table, "not_null", c, n, None, None, got.get(f"nulls_{i}", 0)) for i, c in enumerate(not_null)]
    rows += [(table, "max_length", c, n, m, got.get(f"longest_{i}"), got.get(f"over_{i}", 0))
             for i, (c, m) in enumerate(limits.items())]
    return CheckedLoad(path, rows)


def load_report(spark: SparkSession, loads: list[CheckedLoad]) -> DataFrame:
    """One row per (table, constraint) of the loads."""
    return spark.createDataFrame([r for load in loads for r in load.rows], REPORT)


def require_clean(loads: list[CheckedLoad]) -> None:
    """Raise ``ConstraintViolation`` naming every broken constraint of the loads."""
    bad = [f"{t}.{c}: {n} rows break {check}" for load in loads for t, check, c, *_, n in load.violations()]
    if bad:
        raise ConstraintViolation("; ".join(bad))
