"""Landing-zone writers: Parquet folders per schema/table, dated exports, partitioned layouts.

All writes are ordinary Spark file writes (one file set per task, committed by
the output committer), so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import datetime as _dt
import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Fixed values of the source settings.
LANDING_COMPRESSION = "gzip"          # replication target writes gzip Parquet
LANDING_MAX_FILE_KB = 128000          # replication target file cap, in KB
EXPORT_MAX_RECORDS = 300000           # warehouse export rows per part file
FULL_LOAD_PARALLEL_TABLES = 8         # tables loaded at the same time in a full load


# Bytes of values of a fixed width.
_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4, "long": 8,
          "double": 8, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16}
# Bytes of a file that are not rows: footer, page headers.
_FILE_BYTES = 8 * 1024
# Standard deviations by which a file's rows may be wider than the mean.
_SPREAD = 4


def row_width(df: DataFrame) -> Column:
    """Uncompressed bytes of a row: texts and binaries as long as they are, nested values as JSON."""
    def width(field) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in _WIDTH:
            return F.lit(_WIDTH[kind])
        return F.coalesce(F.octet_length(c if kind in ("string", "binary") else F.to_json(F.struct(c))), F.lit(0)) + 4
    return reduce(lambda a, b: a + b, [width(f) for f in df.schema.fields], F.lit(0)).cast("double")


def records_per_file(df: DataFrame, max_bytes: int) -> int:
    """Rows per file so that a file stays under ``max_bytes``.

    Spark caps files by record count, not bytes.  One aggregate measures the mean and the
    deviation of the rows' widths; n rows then take about mean * n bytes, and hardly ever
    more than _SPREAD deviations * sqrt(n) beyond.  Widths are uncompressed, so files come out smaller.
    """
    w = row_width(df)
    m, s = df.agg(F.avg(w), F.coalesce(F.stddev_pop(w), F.lit(0.0))).first()
    room = max(max_bytes - _FILE_BYTES, 1)
    if not m:
        return max(1, room)
    s *= _SPREAD
    return max(1, int(((math.sqrt(s * s + 4 * m * room) - s) / (2 * m)) ** 2))


def landing_path(root: str, schema: str, table: str) -> str:
    return f"{root.rstrip('/')}/{schema}/{table}"


def parquet_landing_write(df: DataFrame, root: str, table: str, schema: str = "public",
                          compression: str = LANDING_COMPRESSION, max_file_kb: int = LANDING_MAX_FILE_KB,
                          max_records: int | None = None, mode: str = "overwrite",
                          partition_by: list[str] | None = None, sort_by: list[str] | None = None,
                          reload: bool = False, observe: tuple[Observation, list[Column]] | None = None) -> str:
    """Write ``df`` as Parquet under ``root/schema/table``.

    mode 'overwrite' replaces the target's contents on every full load (drop
    and create); ``partition_by`` gives a Hive-style folder per value.  Column
    statistics stay on (Spark's default), unlike a statistics-free landing:
    they let later scans skip row groups for pushed-down filters; ``sort_by`` orders the rows
    of each file (no shuffle), so that row groups hold narrow ranges of these columns.
    ``reload`` (with ``partition_by``) replaces only the partitions that ``df`` brings and
    keeps the others.  Without
    ``max_records`` the rows per file follow from measured widths (one aggregate
    over ``df``: pass a written table if it is expensive).  ``observe`` is an observation and
    the aggregates it takes of the rows as they are written.
    """
    path = landing_path(root, schema, table)
    n = max_records or records_per_file(df, max_file_kb * 1024)
    if reload and not partition_by:
        raise ValueError("a reload of partitions needs partition_by")
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    if observe:
        df = df.observe(observe[0], *observe[1])
    w = df.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", n)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if reload:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return path


def drop_and_create_target(df: DataFrame, root: str, table: str, schema: str = "public", **kw) -> str:
    """A full load that replaces whatever the target folder held."""
    return parquet_landing_write(df, root, table, schema=schema, mode="overwrite", **kw)


def partitioned_landing(df: DataFrame, root: str, table: str, partition_by: list[str],
                        schema: str = "public", **kw) -> str:
    """Landing write with one folder per partition value (readers prune by folder).

    Rows are not reshuffled by the partition column first: each task writes at
    most one file per value it holds, so a value holding most rows is written
    by all tasks in parallel rather than by one.  Meant for low-cardinality
    columns (dates, eval sets).
    """
    return parquet_landing_write(df, root, table, schema=schema, partition_by=partition_by, **kw)


def dated_export_path(root: str, table: str, run_date: _dt.date | _dt.datetime | None = None) -> str:
    d = run_date or _dt.datetime.now(_dt.timezone.utc)
    return f"{root.rstrip('/')}/{table}/{d.year:04d}/{d.month:02d}/{d.day:02d}"


def dated_batch_export(df: DataFrame, root: str, table: str,
                       run_date: _dt.date | _dt.datetime | None = None,
                       max_records: int = EXPORT_MAX_RECORDS,
                       column_case: str | None = None) -> str | None:
    """Export a table under ``root/table/YYYY/MM/DD`` (UTC run date) in parts of at
    most ``max_records`` rows, all with the table's one schema.  An empty table
    writes nothing and returns None.  ``column_case`` 'upper' / 'lower' renames
    the columns (warehouses often report upper-case names)."""
    if df.isEmpty():
        return None
    if column_case in ("upper", "lower"):
        df = df.toDF(*[c.upper() if column_case == "upper" else c.lower() for c in df.columns])
    path = dated_export_path(root, table, run_date)
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records).parquet(path)
    return path


def full_load(spark, database: str, root: str, pattern: str = "%", schema: str = "public",
              parallelism: int = FULL_LOAD_PARALLEL_TABLES, **kw) -> dict[str, str]:
    """Copy every table of ``database`` whose name matches the LIKE ``pattern`` to
    ``root/schema/<table>``, replacing earlier contents; up to ``parallelism``
    tables are copied as concurrent Spark jobs.  Returns table -> landing path."""
    from cartlake.sources.catalog import list_tables_like
    names = list_tables_like(spark, database, pattern)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = {n: pool.submit(drop_and_create_target, spark.read.table(f"{database}.{n}"), root, n,
                                  schema, **kw) for n in names}
        return {n: f.result() for n, f in futures.items()}
