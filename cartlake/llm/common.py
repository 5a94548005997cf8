"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import workspace

#: White space of the word contracts: [\x20\x09-\x0D]; everything else is a word character.
WORD = r"[^\x20\x09-\x0D]+"
#: of the marks that tell which wide rows a join needs: 2 MB
BITS = 1 << 24


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch folder and read it back: the
    lineage is cut at files that survive a lost executor."""
    spark = df.sparkSession
    path = workspace(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def grouped(items: Iterator, weight, limit: int) -> Iterator[list]:
    """Lists of consecutive items of total weight about ``limit``; an item above it stands alone."""
    block, total = [], 0
    for item in items:
        w = weight(item)
        if block and total + w > limit:
            yield block
            block, total = [], 0
        block.append(item)
        total += w
    if block:
        yield block


def _marked(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> tuple[DataFrame, Column]:
    """``rows`` with the marks of ``wanted``, and whether the hash of the row's ``key`` is marked.  The marks are
    BITS bits, sent to every task in parts of a few KB."""
    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(BITS)) + 1          # bitmap buckets are numbered from 1
    marked = wanted.select(place(wanted_key).alias("at"))
    marked = marked.groupBy(F.bitmap_bucket_number("at").alias("__part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__marks"))
    bit = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.expr("substring(__marks, CAST(__bit DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    near = rows.withColumns({"__part": F.bitmap_bucket_number(place(key)), "__bit": bit}).join(F.broadcast(marked), "__part", "left")
    return near, F.coalesce(F.getbit(byte, F.pmod("__bit", F.lit(8)).cast("int")) == 1, F.lit(False))


def may_hold(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``, and with all the others, so that a join that
    follows shuffles few wide rows."""
    near, held = _marked(rows, key, wanted, wanted_key)
    return near.where(held).select(*rows.columns)


def surely_not_held(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows that ``may_hold`` leaves out: no ``key`` of theirs is in ``wanted``."""
    near, held = _marked(rows, key, wanted, wanted_key)
    return near.where(~held).select(*rows.columns)
