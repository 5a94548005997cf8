"""Data-quality checks for the constraints the source database enforced.

Spark tables do not enforce PRIMARY KEY / NOT NULL / VARCHAR(n) / FOREIGN KEY,
so each constraint becomes a job.  Two forms per check:

* ``*_violations``: the offending rows or keys (for inspection / quarantine);
* ``check_*``: one summary row per (table, constraint) with the counts, so a
  whole-catalog check is a single small DataFrame.

Every check is a single pass with partial aggregation before the shuffle
(hot keys collapse map-side); no check collects data to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---------------------------------------------------------------- keys

def key_violations(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """Keys that are NULL (any part) or occur more than once, with their row count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(any_null | (F.col("n_rows") > 1)))


def _key_summary(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).cast("bigint").alias("n_null_keys"),
        F.count_if(~any_null & (F.col("n") > 1)).cast("bigint").alias("n_duplicate_keys"),
    ).select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
             "n_rows", "n_null_keys", "n_duplicate_keys")


def check_primary_key(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Single-column primary keys: rows, NULL keys, keys occurring more than once."""
    return _union_all([_key_summary(n, df, [k]) for n, (df, k) in tables.items()])


def check_composite_key(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Multi-column keys, same summary as ``check_primary_key``."""
    return _union_all([_key_summary(n, df, list(k)) for n, (df, k) in tables.items()])


# ---------------------------------------------------------------- NOT NULL

def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in any of the NOT NULL columns."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def check_not_null(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row per (table, column): rows scanned and NULLs found; one pass per table."""
    frames = []
    for name, (df, cols) in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("__n"),
                        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        frames.append(counts.selectExpr(
            f"'{name}' AS table_name", "__n AS n_rows",
            f"stack({len(cols)}, {stack}) AS (column_name, n_nulls)")
            .select("table_name", "column_name", F.col("n_rows").cast("bigint"),
                    F.col("n_nulls").cast("bigint")))
    return _union_all(frames)


# ---------------------------------------------------------------- VARCHAR(n)

def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows whose text is longer (in characters) than the declared VARCHAR length."""
    return df.filter(reduce(lambda a, b: a | b, [F.length(c) > n for c, n in limits.items()]))


def check_max_length(tables: dict[str, tuple[DataFrame, dict[str, int]]]) -> DataFrame:
    """One row per (table, column): declared limit, longest value, rows over the limit."""
    frames = []
    for name, (df, limits) in tables.items():
        aggs = []
        for c, n in limits.items():
            aggs += [F.max(F.length(c)).alias(f"{c}__max"), F.count_if(F.length(c) > n).alias(f"{c}__over")]
        row = df.agg(*aggs)
        for c, n in limits.items():
            frames.append(row.select(
                F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                F.lit(n).cast("int").alias("max_length"),
                F.col(f"{c}__max").cast("int").alias("longest"),
                F.col(f"{c}__over").cast("bigint").alias("n_too_long")))
    return _union_all(frames)


# ---------------------------------------------------------------- FOREIGN KEY

def orphan_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Non-NULL foreign-key values with no parent row, with how many child rows carry them.

    The child is pre-aggregated per key value first, so a hot value is one row
    before the anti-join; the anti-join then works on distinct keys only.
    """
    per_key = (child.filter(F.col(fk).isNotNull()).groupBy(fk)
               .agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(pk).alias(fk))
    return per_key.join(parents, fk, "left_anti")


def check_orphans(relations: list[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """relations: (child_name, child_df, fk, parent_name, parent_df, pk) -> one summary row each."""
    frames = []
    for child_name, child, fk, parent_name, parent, pk in relations:
        o = orphan_violations(child, fk, parent, pk)
        frames.append(o.agg(
            F.count(F.lit(1)).cast("bigint").alias("n_orphan_keys"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_orphan_rows"))
            .select(F.lit(child_name).alias("table_name"), F.lit(fk).alias("column_name"),
                    F.lit(parent_name).alias("parent_table"), F.lit(pk).alias("parent_column"),
                    "n_orphan_keys", "n_orphan_rows"))
    return _union_all(frames)


# ---------------------------------------------------------------- whole raw layer

def check_raw_layer(tables: dict[str, DataFrame], include_disabled: bool = False) -> dict[str, DataFrame]:
    """Every constraint declared on the source tables, as summary frames.

    ``tables`` maps raw table names to DataFrames (missing tables are skipped).
    Composite keys and foreign keys were declared but disabled at the source;
    ``include_disabled`` checks them too.
    """
    from cartlake.sources import schema

    def have(names):
        return all(n in tables for n in names)

    specs = {
        "primary_key": (check_primary_key, {t: (tables[t], k) for t, k in schema.PRIMARY_KEYS.items()
                                            if t in tables}),
        "not_null": (check_not_null, {t: (tables[t], c) for t, c in schema.NOT_NULL.items() if t in tables}),
        "max_length": (check_max_length, {t: (tables[t], m) for t, m in schema.MAX_LENGTH.items()
                                          if t in tables}),
    }
    if include_disabled:
        specs["composite_key"] = (check_composite_key, {t: (tables[t], k) for t, k in schema.COMPOSITE_KEYS.items()
                                                        if t in tables})
        specs["orphans"] = (check_orphans, [(c, tables[c], fk, p, tables[p], pk)
                                            for c, fk, p, pk in schema.FOREIGN_KEYS if have([c, p])])
    # a check with none of its tables present is skipped, not run on nothing
    return {name: check(args) for name, (check, args) in specs.items() if args}


def violations_found(report: dict[str, DataFrame]) -> DataFrame:
    """One row per failed check of a ``check_raw_layer`` report (empty when clean)."""
    counts = {"primary_key": ["n_null_keys", "n_duplicate_keys"], "not_null": ["n_nulls"],
              "max_length": ["n_too_long"], "composite_key": ["n_null_keys", "n_duplicate_keys"],
              "orphans": ["n_orphan_rows"]}
    if not report:
        raise ValueError("empty report: none of the declared tables was given")
    frames = []
    for check, df in report.items():
        bad = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in counts[check]])
        frames.append(df.filter(bad).select(F.lit(check).alias("check"), "table_name",
                                            F.to_json(F.struct(*df.columns)).alias("detail")))
    return _union_all(frames)


def content_digest(df: DataFrame) -> DataFrame:
    """One row (n_rows, digest): equal for equal bags of rows, whatever their order, files or columns' order.

    A row's text is its values in the order of the column names, NULL as a mark no value has;
    floating-point values count in millionths.  Digests of rows (60 bits of MD5) are added up,
    so tasks sum on their own and any SQL engine can repeat it; copies of a row count each.
    """
    def text(field) -> Column:
        c = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("float", "double"):
            c = F.floor(c.cast("double") * 1_000_000 + 0.5)
        return F.coalesce(c.cast("string"), F.lit("\u2205"))

    fields = sorted(df.schema.fields, key=lambda f: f.name)
    row = F.md5(F.concat_ws("|", *map(text, fields)))
    value = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(value).cast("string"), F.lit("0")).alias("digest"))
