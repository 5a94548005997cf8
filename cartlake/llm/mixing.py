"""Mixing sources to target weights by capped water-filling (DataFrame operations only).

Every source asks for its weight's share of ``share`` x all words, clamped at
``max_epochs`` x its own words; what the clamp frees is dealt out again by weight
until no source is above its clamp.  A target of r epochs is then sampled as
floor(r) whole repetitions of every document and one fractional repetition: the
documents in a seeded order until the rest of the target is reached, the last one
cut to the words that are missing, so each source meets its rounded target exactly.

Defined results: a NULL text has size 0; a NULL source is a source of its own, last
in order; rows are never merged (repeated rows each take part; rows that tie in the
seeded order are equal in doc_id and size, so their order cannot show); an empty
table gives an empty result; a corpus of empty texts takes nothing.  Columns of the
input other than the three named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, shuffle_width

SEED = "mix-1"
WEIGHTS = (3, 1, 2)
#: The seeded order is cut into 2**BUCKET_BITS ranges, so that no window holds a whole source.
BUCKET_BITS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(id_col: str, seed: str) -> Column:
    """48 seeded bits of a document's id: md5 of "seed:id" (an absent id: "seed:"), first 12 hex digits."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """sources (source, source_size) plus ``rank`` by code point, NULL last: ranges are
    numbered inside, then shifted by the rows of the ranges before them; only one row
    a range meets in one place."""
    spark = sources.sparkSession
    cut = (sources.withColumn("absent", F.col("source").isNull())
           .repartitionByRange(shuffle_width(spark), "absent", "source")
           .withColumn("part", F.spark_partition_id()))
    cut = materialize(cut, "mix-sources")
    inside = cut.withColumn("inside", F.row_number().over(
        Window.partitionBy("part").orderBy("absent", "source")))
    before = (cut.groupBy("part").agg(F.count("*").alias("rows"))
              .withColumn("before", F.sum("rows").over(
                  Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))))
    return (inside.join(before.select("part", F.coalesce("before", F.lit(0)).alias("before")), "part")
            .withColumn("rank", F.col("inside") + F.col("before") - 1)
            .drop("absent", "part", "inside", "before"))


def water_fill(sources: DataFrame, share_pct: int = 150, max_epochs: int = 2) -> DataFrame:
    """sources (source_size, weight, ...) plus ``target`` (double).

    Each round is one aggregate over the source table; ``level`` (words a unit of
    weight) only rises, so a clamped source stays clamped and the rounds end."""
    level = None
    while True:
        clamped = (F.lit(False) if level is None else
                   F.col("source_size") * max_epochs <= F.col("weight") * F.lit(level))
        total, full, weight, n = sources.agg(
            F.sum("source_size"), F.sum(F.when(clamped, F.col("source_size") * max_epochs)),
            F.sum(F.when(~clamped, F.col("weight"))), F.count(F.when(clamped, 1))).first()
        if level is not None and n == was or not weight:
            break
        was = n
        level = ((total or 0) * share_pct / 100 - (full or 0)) / weight
    cap = (F.col("source_size") * max_epochs).cast("double")
    target = cap if level is None else F.least(cap, F.col("weight") * F.lit(float(level)))
    return sources.withColumn("target", target)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share_pct: int = 150, max_epochs: int = 2,
        seed: str = SEED, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, extra, taken): a document is
    taken ``copies`` times whole and then for its first ``extra`` words."""
    sized = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"), _draw(id_col, seed).alias("draw")), "mix-sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(per_source).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    targets = materialize(water_fill(materialize(ranked, "mix-ranked"), share_pct, max_epochs)
                          .select("rank", "source", "source_size", "target"), "mix-targets")
    # numbers stand for names from here on: no NULL keys
    rows = (sized.join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
            .withColumn("bucket", F.shiftright("draw", 48 - bucket_bits)))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("rank", "bucket", F.coalesce(F.sum("words").over(
        Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("size").over(
        Window.partitionBy("rank", "bucket").orderBy("draw", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    goal = F.round("target").cast("long")
    copies = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    left = goal - F.col("copies") * F.col("source_size") - F.col("before") - F.col("inside")
    return (rows.withColumn("inside", inside).join(before, ["rank", "bucket"])
            .withColumn("copies", copies)
            .withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size") + F.col("extra"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", "extra", "taken"))


def repeat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: every document ``copies`` times, and
    once more, cut after its first ``extra`` words, where the fractional repetition takes
    part of it.  Documents of no words cost nothing and stay once.  Rows that share an
    id and a size share one plan."""
    # the plan is per row; among rows of one id and size it is summed and dealt out evenly first
    plan = (mix(docs, id_col, text_col, source_col, **options)
            .groupBy("doc_id", "source", "size")
            .agg(F.sum("taken").alias("taken"), F.count("*").alias("rows")))
    each = F.floor(F.col("taken") / F.col("rows"))
    plan = plan.select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"),
        each.alias("__each"))
    at = docs.withColumn("__n", n_words(F.col(text_col)))
    joined = at.join(plan, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__n") == F.col("__size"))
                     & F.col(source_col).eqNullSafe(F.col("__source")))
    whole = F.when(F.col("__n") > 0, F.floor(F.col("__each") / F.col("__n"))).otherwise(1)
    extra = F.when(F.col("__n") > 0, F.col("__each") % F.col("__n")).otherwise(0)
    pieces = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")),
                      F.when(extra > 0, F.array(extra.cast("long"))).otherwise(F.array().cast("array<long>")))
    # possessive, so that the matcher loops and does not recurse
    cut = F.call_function("regexp_extract", F.col(text_col), F.concat(
        F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), F.col("__take").cast("string"),
        F.lit("}+")), F.lit(0))
    out = joined.withColumn("__take", F.explode(pieces))
    text = F.when(F.col("__take") < 0, F.col(text_col)).otherwise(cut)
    return out.withColumn(text_col, text).select(*docs.columns)
