"""A table laid out by key buckets, to which a change batch is applied where it belongs.

``<root>/bucket=<b>`` holds the rows whose key hashes to ``b``, each with the sequence
number of the change that made it; a deleted key stays as a row marked deleted.  A batch

1. is reduced to the latest change per key (partial aggregation);
2. reads the buckets it touches only (partition pruning);
3. is joined to them once, null-safe on the key; the newer of row and change wins;
4. replaces these buckets by one dynamic partition overwrite.

Bytes read and written follow the batch, not the table.  The sequence numbers lie in
the rows they belong to, so there is no second table to keep in step: a batch that
is replayed, after whatever part of it was put in place, finds its own numbers and changes
nothing, and late older changes lose.  One writer at a time; a reader that wants a
consistent view of several batches reads between them.

Hot keys: a bucket is a folder, not a task; its rows are joined by the whole key, and rows
are written by as many tasks as the join has.  NULL parts of keys are values like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from cartlake.session import hadoop_path
from cartlake.streaming.changes import DELETE, _same_key, latest_changes

BUCKETS = 64
BUCKET, SEQ, GONE = "bucket", "applied_seq", "deleted"


class KeyedTable:
    """The table under ``root`` with ``columns`` (a schema), keyed by ``key``, in ``buckets`` folders."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str | list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys = [key] if isinstance(key, str) else list(key)
        self.buckets = buckets
        clash = {BUCKET, SEQ, GONE} & set(schema.fieldNames())
        if clash:
            raise ValueError(f"columns {sorted(clash)} are the layout's own")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _stored(self) -> DataFrame:
        own = [StructField(SEQ, LongType()), StructField(GONE, BooleanType()), StructField(BUCKET, IntegerType())]
        layout = StructType([*self.schema.fields, *own])
        path, files = hadoop_path(self.spark, self.root)
        if not files.exists(path):
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(self.root)

    def _put(self, rows: DataFrame) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.root))

    def load(self, df: DataFrame) -> None:
        """Start the table with ``df``; any change is newer than these rows."""
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        self._put(rows.select("*", F.lit(None).cast("long").alias(SEQ), F.lit(False).alias(GONE), self._bucket()))

    def read(self) -> DataFrame:
        return self._stored().filter(~F.col(GONE)).select(*self.schema.fieldNames())

    def apply(self, changes: DataFrame, seq: str = "seq", op: str = "op") -> list[int]:
        """Apply a batch; returns the buckets it touched (at most ``buckets`` numbers)."""
        latest = latest_changes(changes, self.keys, seq).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields],
            F.col(seq).cast("long").alias(SEQ), F.coalesce(F.col(op) == DELETE, F.lit(False)).alias(GONE))
        latest = latest.select("*", self._bucket())
        touched = sorted(r[0] for r in latest.select(BUCKET).distinct().collect())
        if not touched:
            return []
        names = [*self.schema.fieldNames(), SEQ, GONE, BUCKET]
        old = self._stored().filter(F.col(BUCKET).isin(touched)).select(*[F.col(x).alias(f"t{i}") for i, x in enumerate(names)])
        new = latest.select(*[F.col(x).alias(f"c{i}") for i, x in enumerate(names)])
        at, seq_at, bucket_at = [names.index(k) for k in self.keys], names.index(SEQ), names.index(BUCKET)
        same = _same_key([f"t{i}" for i in (*at, bucket_at)], [f"c{i}" for i in (*at, bucket_at)])
        joined = old.join(new, same, "full_outer")
        has_old, has_new = F.col(f"t{bucket_at}").isNotNull(), F.col(f"c{bucket_at}").isNotNull()
        newer = has_new & (~has_old | F.col(f"t{seq_at}").isNull() | (F.col(f"c{seq_at}") > F.col(f"t{seq_at}")))
        self._put(joined.select(*[F.when(newer, F.col(f"c{i}")).otherwise(F.col(f"t{i}")).alias(x) for i, x in enumerate(names)]))
        return touched

    def stream(self, source: str, schema: StructType | str, checkpoint: str, seq: str = "seq", op: str = "op",
               files_per_batch: int = 1, available_now: bool = True) -> StreamingQuery:
        """Apply the change files that arrive under ``source``, one micro-batch at a time."""
        feed = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

        def apply_batch(batch: DataFrame, epoch: int) -> None:
            self.apply(batch, seq, op)

        writer = feed.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()
