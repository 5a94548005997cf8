"""Incremental loads: apply a change feed (insert / update / delete rows with a
sequence number) to a table, in batch or as a stream.

* ``latest_changes`` keeps the last change per key with a plain aggregate
  (``max`` of a struct led by the sequence number), so a key with millions of
  changes is pre-combined map-side instead of ranked in one task.
* ``apply_changes`` is one full outer join of the target and the latest changes;
  applying the same batch twice gives the same table.
* ``stream_changes`` runs it per micro-batch with ``foreachBatch`` and
  publishes a new version per batch.  Because a replayed batch is idempotent,
  a batch re-run after a failure between publish and checkpoint commit does not
  change the result.  The last applied sequence number per key is kept in a
  companion table (``<table>__applied_seq``, deletes as tombstones), so a late
  or replayed older change is ignored instead of overwriting newer state.
* ``cartlake.streaming.keyed`` applies changes to the key buckets they touch only.

One rule for keys: a change names its row by the key as it stands, NULL parts
included.  NULL equals NULL here (unlike MERGE, where it matches nothing): a
replayed insert of a NULL key finds the row it made, and a change of a NULL key
changes every row that has it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cartlake.operators.changes import conform
from cartlake.sinks.versioned import VersionedTables

DELETE = "D"


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _same_key(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def latest_changes(changes: DataFrame, key: str | list[str], seq: str) -> DataFrame:
    """One row per key: the change with the highest ``seq`` (ties: larger other values win)."""
    keys = _keys(key)
    rest = [c for c in changes.columns if c not in (*keys, seq)]
    latest = changes.groupBy(*keys).agg(F.max(F.struct(seq, *rest)).alias("__c"))
    return latest.select(*keys, *[F.col(f"__c.{c}").alias(c) for c in [seq, *rest]]).select(*changes.columns)


def fresh_changes(latest: DataFrame, applied: DataFrame | None, key: str | list[str], seq: str) -> DataFrame:
    """Drop changes whose sequence number is not newer than the one already applied
    for their key (``applied``: key, seq; deletes stay there as tombstones)."""
    if applied is None:
        return latest
    keys = _keys(key)
    done = applied.select(*[F.col(k).alias(f"done{i}") for i, k in enumerate(keys)], F.col(seq).alias("done_seq"))
    newer = F.col("done_seq").isNull() | (F.col(f"now.{seq}") > F.col("done_seq"))
    same = _same_key([f"now.{k}" for k in keys], [f"done{i}" for i in range(len(keys))])
    return latest.alias("now").join(done, same, "left").filter(newer).select("now.*")


def applied_sequences(applied: DataFrame | None, latest: DataFrame, key: str | list[str],
                      seq: str) -> DataFrame:
    """The per-key last applied sequence number after this batch."""
    keys = _keys(key)
    batch = latest.select(*keys, seq)
    if applied is None:
        return batch
    return applied.select(*keys, seq).unionByName(batch).groupBy(*keys).agg(F.max(seq).alias(seq))


def apply_changes(target: DataFrame, changes: DataFrame, key: str | list[str], seq: str = "seq",
                  op: str = "op", applied: DataFrame | None = None) -> DataFrame:
    """Target after the change batch: the latest change per key wins; 'D' deletes,
    any other op (I / U) upserts every target column.  With ``applied`` (key,
    last applied seq), changes no newer than what was already applied are ignored."""
    keys = _keys(key)
    latest = fresh_changes(latest_changes(changes, keys, seq), applied, keys, seq)
    columns = target.columns
    change = conform(latest, target).columns  # a missing column is an error
    cast = {f.name: f.dataType for f in target.schema.fields}
    c = latest.select(*[F.col(x).cast(cast[x]).alias(f"c{i}") for i, x in enumerate(change)],
                      F.coalesce(F.col(op) == DELETE, F.lit(False)).alias("c_deletes"))
    t = target.select(*[F.col(x).alias(f"t{i}") for i, x in enumerate(columns)])
    at = [columns.index(k) for k in keys]
    joined = t.join(c, _same_key([f"t{i}" for i in at], [f"c{i}" for i in at]), "full_outer")
    changed = F.col("c_deletes").isNotNull()
    return joined.filter(~F.coalesce("c_deletes", F.lit(False))).select(*[
        F.when(changed, F.col(f"c{i}")).otherwise(F.col(f"t{i}")).alias(x) for i, x in enumerate(columns)])


def stream_changes(spark: SparkSession, source: str, schema: StructType | str, tables: VersionedTables,
                   table: str, key: str | list[str], checkpoint: str, seq: str = "seq", op: str = "op",
                   files_per_batch: int = 1, available_now: bool = True,
                   keep_versions: int | None = None) -> StreamingQuery:
    """Start a stream that applies change files under ``source`` to ``tables.table``.

    Every micro-batch publishes full new versions; ``keep_versions`` (2 or more,
    so readers of the previous version can finish) expires older ones; None keeps all."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(source))

    seq_table = f"{table}__applied_seq"

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        if tables.current(table) is None:       # first batch of a new table
            cols = [c for c in batch.columns if c not in (seq, op)]
            current = spark.createDataFrame([], batch.select(*cols).schema)
        else:
            current = tables.table(table)
        applied = tables.table(seq_table) if tables.current(seq_table) is not None else None
        latest = fresh_changes(latest_changes(batch, key, seq), applied, key, seq)
        summary = {"stream-epoch": str(epoch_id)}
        tables.publish(table, apply_changes(current, latest, key, seq, op),
                       operation="overwrite", extra_summary=summary)
        # Published second: a crash in between replays this batch, which is idempotent.
        tables.publish(seq_table, applied_sequences(applied, latest, key, seq), extra_summary=summary)
        if keep_versions:
            tables.expire_versions(table, keep_versions)
            tables.expire_versions(seq_table, keep_versions)

    writer = stream.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
