"""Row-level changes on immutable DataFrames: keyed upsert, predicate delete,
rounding update and column type change.

Parquet tables in the session catalog refuse MERGE / DELETE / UPDATE, so each
change returns the new table contents as a DataFrame; ``cartlake.sinks.versioned``
publishes it as a new version (never overwriting the files being read).  When
a catalog with row-level operations is configured, ``merge_upsert_sql`` runs the
same change as ``DataFrame.mergeInto``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions import float_to_int, round_half_even

class MergeCardinalityError(ValueError):
    """A target row is matched by more than one source row."""


def conform(df: DataFrame, target: DataFrame) -> DataFrame:
    """Select the target's columns from ``df`` cast to the target's types.

    Missing columns are an error; with ANSI mode an out-of-range value raises
    instead of wrapping (Python ints arrive as bigint, targets are often int).
    """
    missing = [f.name for f in target.schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _all_not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def check_merge_cardinality(target: DataFrame, updates: DataFrame, key: str | list[str]) -> None:
    """Raise if a source key appears more than once AND matches a target row.

    For callers that want the error before they start; ``merge_upsert`` finds it on its
    own.  Pre-aggregates the source keys; the target contributes only its key columns.
    """
    keys = _keys(key)
    dup = (updates.filter(_all_not_null(keys)).groupBy(*keys).count()
           .filter(F.col("count") > 1).select(*keys))
    hit = dup.join(target.select(*keys), keys, "left_semi")
    if not hit.isEmpty():
        raise MergeCardinalityError(
            f"MERGE matched a target row with several source rows on key {key!r}")


def merge_upsert(target: DataFrame, updates: DataFrame, key: str | list[str],
                 set_cols: list[str] | None = None, *, check_cardinality: bool = True) -> DataFrame:
    """MERGE target USING updates ON target.key = updates.key
         WHEN MATCHED THEN UPDATE SET <set_cols> = updates.<set_cols>
         WHEN NOT MATCHED THEN INSERT *

    ``key`` is one column or a list (composite key).  A NULL in any key part
    never matches (such an update row is inserted); NULL source values
    overwrite.  Target columns outside ``set_cols`` keep their value on a match.
    A target row that several update rows match raises when the result is computed.

    One pass over the target, whatever the sizes:

    * the updates are combined per key (map-side first) to one row and its count;
    * one full outer join on the key; AQE sizes and coalesces its partitions.
      A match with a count above 1 raises there, so the count needs no job of its own;
    * update rows whose key repeats, or has a NULL, cannot be updates any more
      (the former would have raised), so they are appended as inserts without
      looking at the target again.

    Target rows with a NULL in the key cannot match; they are spread over all
    tasks by a hash of the row instead of meeting in one.  Rows of the target
    that share a key meet in one task.  ``check_cardinality=False`` says that
    update keys are unique and skips the combination.
    """
    keys = _keys(key)
    u = conform(updates, target)
    columns = target.columns
    non_key = [c for c in columns if c not in keys]
    set_cols = list(non_key if set_cols is None else set_cols)
    unknown = [c for c in set_cols if c not in non_key]
    if unknown:
        raise ValueError(f"set columns {unknown} are not non-key target columns")

    # t0, t1, ... and s0, s1, ...: no name of the inputs can clash with those made here
    place = {c: i for i, c in enumerate(columns)}
    keyed, blank = u.filter(_all_not_null(keys)), u.filter(~_all_not_null(keys))
    source = keyed.select(*[F.col(c).alias(f"s{i}") for c, i in place.items()])
    source_keys = [f"s{place[k]}" for k in keys]
    if check_cardinality:
        rest = [f"s{i}" for c, i in place.items() if c not in keys]
        combined = source.groupBy(*source_keys).agg(F.count(F.lit(1)).alias("n"), *[F.any_value(c).alias(c) for c in rest])
    else:
        combined = source.withColumn("n", F.lit(1).cast("long"))
    combined = combined.withColumn("s_spread", F.when(F.col(source_keys[0]).isNotNull(), F.lit(0)))
    hashed = [F.col(f.name) for f in target.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.when(_all_not_null(keys), F.lit(0)).otherwise(F.pmod(F.xxhash64(*hashed), F.lit(1 << 20)).cast("int") + 1)
    t = target.select(*[F.col(c).alias(f"t{i}") for c, i in place.items()], spread.alias("t_spread"))
    on = reduce(lambda a, b: a & b, [F.col(f"t{place[k]}") == F.col(f"s{place[k]}") for k in keys])
    joined = t.join(combined, on & (F.col("t_spread") == F.col("s_spread")), "full_outer")
    in_t, in_s = F.col("t_spread").isNotNull(), F.col("n").isNotNull()
    if check_cardinality:
        message = F.lit(f"MERGE matched a target row with several source rows on key {key!r}")
        several = F.when(in_t & (F.col("n") > 1), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        joined = joined.filter(several).filter(in_t | (F.col("n") == 1))

    def value(c: str) -> Column:
        t_c, s_c = F.col(f"t{place[c]}"), F.col(f"s{place[c]}")
        return (F.when(in_s, s_c).otherwise(t_c) if c in set_cols else F.when(in_t, t_c).otherwise(s_c)).alias(c)

    out = joined.select(*[value(c) for c in columns]).unionByName(blank)
    if check_cardinality:
        repeated = combined.filter(F.col("n") > 1).select(*[F.col(f"s{place[k]}").alias(k) for k in keys])
        out = out.unionByName(keyed.join(repeated, keys, "left_semi").select(*columns))
    return out


def merge_upsert_sql(spark, table: str, updates_view: str, key: str | list[str],
                     set_cols: list[str]) -> DataFrame:
    """The same change through ``DataFrame.mergeInto`` for catalogs with row-level operations."""
    src = spark.table(updates_view)
    assignments = {c: F.col(f"source.{c}") for c in set_cols}
    cond = " AND ".join(f"{table}.{k} = source.{k}" for k in _keys(key))
    return (src.alias("source").mergeInto(table, F.expr(cond))
            .whenMatched().update(assignments)
            .whenNotMatched().insertAll()
            .merge())


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """DELETE ... WHERE predicate: drop rows where it is TRUE; NULL keeps the row."""
    cond = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(~F.coalesce(cond, F.lit(False)))


def update_round(df: DataFrame, column: str) -> DataFrame:
    """UPDATE t SET c = ROUND(c) on a float column: ties to even, type kept."""
    dtype = df.schema[column].dataType
    return df.withColumn(column, round_half_even(column).cast(dtype))


def alter_column_type(df: DataFrame, column: str, type_name: str) -> DataFrame:
    """ALTER COLUMN c TYPE <type> USING c::<type>.

    Float -> integral casts round to nearest (ties to even) as the source
    database does; other casts are Spark casts (ANSI: invalid values raise).
    """
    src = df.schema[column].dataType.typeName()
    integral = type_name.lower() in ("int", "integer", "bigint", "long", "smallint", "short")
    if integral and src in ("float", "double"):
        expr = float_to_int(column, type_name)
    else:
        expr = F.col(column).cast(type_name)
    return df.withColumn(column, expr)


def stamp_column(df: DataFrame, name: str = "updated_at", epoch_seconds: float | None = None) -> DataFrame:
    """Add a constant epoch-seconds column, evaluated once on the driver."""
    import time
    value = time.time() if epoch_seconds is None else float(epoch_seconds)
    return df.withColumn(name, F.lit(value).cast("double"))
