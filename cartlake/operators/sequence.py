"""row_number() / lag() / lead() within groups, with hot groups split across tasks.

A window ``PARTITION BY keys`` sends every row of a group to one task.  When a
single group holds a large share of the table (a third, say), that task sorts
a third of the data alone.  ``group_window`` (and ``group_row_number``) cuts such
groups into ranges of their own order, numbers the ranges in parallel and adds
the rows of the ranges before:

1. group sizes: one partial-then-final aggregate over the key columns only;
2. a group is hot when it holds more than ``max(min_hot_rows, rows / P)`` rows
   (P = shuffle partitions), so there are at most P hot groups, cut into about
   2P ranges in all: the side tables below are bounded by that and broadcast;
3. the cuts are splitters from a sample of the hot groups' rows, over *all* ordering
   columns and a hash of the row, so rows that tie in the order are split as evenly as
   any others.  The sample is chosen by that hash: however often, and wherever, it
   is computed, it is the same;
4. row_number over (keys, range) runs in parallel; the rows of the group's earlier
   ranges (a prefix sum over the range counts) are added, which makes the numbering
   exact however uneven the ranges are;
5. lag / lead on a range's first / last row come from the neighbouring range's
   last / first row (same small table).

Without hot groups the side tables would be empty, so they are not built and every
group is one range: the same numbers, of the same type.  Numbers are bigint.  NULL keys form a group like any
other (null-safe joins throughout).  Rows that are equal in every column cannot be
told apart and stay in one range.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A group below this many rows is one task's work, whatever the table's size.
MIN_HOT_ROWS = 1_000_000
#: Sampled rows per range; the ranges' sizes vary by about 1 / sqrt(SAMPLES).
SAMPLES = 32
_DRAWS = 1 << 40
_STRIDE = 64


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def largest_group(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows, rows of the biggest group): one aggregate over the key columns only."""
    _, rows, biggest = _sizes_stats(df.select(*keys), keys, None)
    return rows, biggest


def _sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def _sizes_stats(df: DataFrame, keys: list[str], sizes: DataFrame | None):
    sizes = _sizes(df, keys) if sizes is None else sizes
    stats = sizes.agg(F.sum("__n").alias("rows"), F.max("__n").alias("biggest")).first()
    return sizes, (stats["rows"] or 0), (stats["biggest"] or 0)


def _row_hash(df: DataFrame) -> Column:
    hashable = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*hashable)


def _splitters(df: DataFrame, keys: list[str], place: Column, hot: DataFrame, hot_rows: int,
               buckets: int | None) -> DataFrame:
    """Keys (as ``__b_<key>``) of the hot groups and ``__cuts``, the sorted splitters of each."""
    rows_per_range = hot_rows
    if buckets:
        rows_per_range = max(1, hot_rows // buckets)
    draw = F.pmod(_row_hash(df), F.lit(_DRAWS)) < F.lit(max(1, math.ceil(_DRAWS * min(1.0, SAMPLES / rows_per_range))))
    h = hot.select(*[F.col(k).alias(f"__h_{k}") for k in keys], "__n")
    on = reduce(lambda a, c: a & c, [df[k].eqNullSafe(h[f"__h_{k}"]) for k in keys])
    sample = (df.join(F.broadcast(h), on).filter(draw)
              .groupBy(*[F.col(f"__h_{k}").alias(f"__b_{k}") for k in keys])
              .agg(F.sort_array(F.collect_list(place)).alias("__s"), F.max("__n").alias("__n")))
    n = F.lit(buckets) if buckets else F.ceil(F.col("__n") / F.lit(hot_rows)).cast("int")
    at = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                     lambda i: F.element_at("__s", F.greatest(F.lit(1), F.floor(i * F.size("__s") / n).cast("int"))))
    return sample.select(*[f"__b_{k}" for k in keys], at.alias("__cuts"))


def _range_of(place: Column) -> Column:
    """How many of ``__cuts`` lie below ``place``: a step over every _STRIDE-th, then within one stride."""
    cuts = F.col("__cuts")
    coarse = F.transform(F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / _STRIDE).cast("int")), lambda i: F.get(cuts, i * _STRIDE))
    stride = F.greatest(F.size(F.filter(coarse, lambda x: x < place)) - 1, F.lit(0)) * _STRIDE
    return stride + F.size(F.filter(F.slice(cuts, stride + 1, F.lit(_STRIDE)), lambda x: x < place))


def group_window(df: DataFrame, keys: list[str], order: list[str], number: str | None = None,
                 lag: dict[str, str] | None = None, lead: dict[str, str] | None = None,
                 min_hot_rows: int | None = None, buckets: int | None = None,
                 sizes: DataFrame | None = None, stats: tuple[int, int] | None = None,
                 max_group_rows: int | None = None) -> DataFrame:
    """Per group of ``keys`` in ``order`` (ascending, NULLs first), add

    * ``number``: row_number(), as bigint,
    * ``lag``  {column: output}: the column's value on the previous row,
    * ``lead`` {column: output}: the column's value on the next row,

    exactly as the window functions would.  ``sizes`` (keys + ``__n``) may give
    upper bounds of the group sizes from a cheaper source; otherwise they are
    counted from ``df`` (key columns only).  ``stats`` = (rows, biggest group),
    when already known, skips the counting job; so does ``max_group_rows``, a
    caller-known upper bound of the largest group, when it is small.

    With hot groups ``df`` is read up to four times (sizes, sample, range
    counts, numbering), three of them as narrow column sets; pass a written table
    rather than a long derived plan when ``df`` is expensive to compute.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    min_hot_rows = MIN_HOT_ROWS if min_hot_rows is None else min_hot_rows
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if max_group_rows is not None and max_group_rows <= min_hot_rows and stats is None:
        stats = (0, max_group_rows)   # no group can be hot
    if stats is None:
        sizes, rows, biggest = _sizes_stats(df, keys, sizes)
    else:
        rows, biggest = stats
        sizes = _sizes(df, keys) if sizes is None else sizes
    hot_rows = max(min_hot_rows, math.ceil(rows / max(parts, 1)), 1)
    if biggest <= hot_rows:      # every group is one range
        w = Window.partitionBy(*keys).orderBy(*order)
        added = {number: F.row_number().over(w).cast("bigint")} if number else {}
        added |= {name: F.lag(c).over(w) for c, name in lag.items()} | {name: F.lead(c).over(w) for c, name in lead.items()}
        return df.select(*[F.col(c) for c in df.columns], *[x.alias(name) for name, x in added.items()])

    hot = sizes.filter(F.col("__n") > hot_rows)
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], _row_hash(df).alias("tie"))
    cuts = _splitters(df, keys, place, hot, hot_rows, buckets)
    on = reduce(lambda x, y: x & y, [df[k].eqNullSafe(cuts[f"__b_{k}"]) for k in keys])
    hot_row = F.col("__cuts").isNotNull()
    salted = (df.join(F.broadcast(cuts), on, "left")
              .withColumn("__bucket", F.when(hot_row, _range_of(place)).otherwise(F.lit(0)))
              .withColumn("__tie", F.when(hot_row, _row_hash(df)))
              .withColumn("__hot", hot_row).drop("__cuts", *[f"__b_{k}" for k in keys]))

    # Rows, first row's lead columns and last row's lag columns of every range of a hot group.
    okey = F.struct(*order, "__tie")
    edge_aggs = [F.count(F.lit(1)).alias("__c")]
    if lead:
        edge_aggs.append(F.min_by(F.struct(*[F.col(c).alias(c) for c in lead]), okey).alias("__first"))
    if lag:
        edge_aggs.append(F.max_by(F.struct(*[F.col(c).alias(c) for c in lag]), okey).alias("__last"))
    edges = salted.filter("__hot").groupBy(*keys, "__bucket").agg(*edge_aggs)
    per_group = Window.partitionBy(*keys).orderBy("__bucket")
    before = per_group.rowsBetween(Window.unboundedPreceding, -1)
    edge_cols = [*[F.col(k).alias(f"__e_{k}") for k in keys], F.col("__bucket").alias("__e_b"), "__c",
                 F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__offset")]
    if lag:
        edge_cols.append(F.lag("__last").over(per_group).alias("__prev_last"))
    if lead:
        edge_cols.append(F.lead("__first").over(per_group).alias("__next_first"))
    edges = edges.select(*edge_cols)

    wl = Window.partitionBy(*keys, "__bucket").orderBy(*order, "__tie")
    numbered = salted.withColumn("__local", F.row_number().over(wl))
    for c in lag:
        numbered = numbered.withColumn(f"__lag_{c}", F.lag(c).over(wl))
    for c in lead:
        numbered = numbered.withColumn(f"__lead_{c}", F.lead(c).over(wl))
    on2 = reduce(lambda x, y: x & y, [numbered[k].eqNullSafe(edges[f"__e_{k}"]) for k in keys])
    on2 = on2 & (numbered["__bucket"] == edges["__e_b"])
    j = numbered.join(F.broadcast(edges), on2, "left")
    split = F.col("__hot")
    out_cols = [F.col(c) for c in df.columns]
    if number:
        out_cols.append((F.col("__local").cast("bigint") + F.coalesce(F.col("__offset"), F.lit(0))).alias(number))
    for c, name in lag.items():
        out_cols.append(F.when(split & (F.col("__local") == 1), F.col("__prev_last")[c])
                        .otherwise(F.col(f"__lag_{c}")).alias(name))
    for c, name in lead.items():
        out_cols.append(F.when(split & (F.col("__local") == F.col("__c")), F.col("__next_first")[c])
                        .otherwise(F.col(f"__lead_{c}")).alias(name))
    return j.select(*out_cols)


def group_row_number(df: DataFrame, keys: list[str], order: list[str], out: str = "row_number",
                     min_hot_rows: int | None = None, buckets: int | None = None,
                     sizes: DataFrame | None = None) -> DataFrame:
    """``df`` plus ``out`` = row_number() OVER (PARTITION BY keys ORDER BY order).

    Give enough ``order`` columns to make the order total if the numbering
    must be deterministic.
    """
    return group_window(df, keys, order, number=out, min_hot_rows=min_hot_rows, buckets=buckets,
                        sizes=sizes)
