"""Versioned table publishing with a queryable history.

``create or replace`` on a snapshotting table format becomes, on plain Parquet:

1. write the new contents to a fresh folder ``<root>/<db>/<table>/data/snapshot_id=<id>``
   (never over the files being read, so a table can be rebuilt from itself);
2. add one commit record ``<root>/<db>/<table>/_log/<sequence>.json`` (a tiny JSON dataset);
3. point the catalog table ``<db>.<table>`` at the new folder.

Readers take the newest commit, looked up each time.  A commit record is written under
another name and renamed, so it is whole or not there; what a crash left of an unfinished
one is not a commit, and the next commit takes its place.  A failed write leaves no commit,
so the previous version stays current; ``repair`` points the catalog at it if a crash came
between the two.  ``history`` and ``snapshots`` expose the log with the usual
metadata-table columns.  The log has one row per commit; one writer per table at a time.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from cartlake.functions import map_value
from cartlake.session import hadoop_path
from pyspark.sql.types import (LongType, MapType, StringType, StructField, StructType,
                               TimestampType)

LOG_SCHEMA = StructType([
    StructField("snapshot_id", LongType(), False),
    StructField("parent_id", LongType(), True),
    StructField("sequence_number", LongType(), False),
    StructField("committed_at", TimestampType(), False),
    StructField("operation", StringType(), False),
    StructField("manifest_list", StringType(), False),
    StructField("summary", MapType(StringType(), StringType()), True),
])

FORMAT_VERSION = "2"


@dataclass(frozen=True)
class Staged:
    """A written but not yet committed table version."""
    name: str
    snapshot_id: int
    path: str
    added_records: int
    schema: StructType


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str, database: str, register: bool = True):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.register = register
        if register:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/{database}'")

    # ------------------------------------------------------------ layout
    def table_dir(self, name: str) -> str:
        return f"{self.root}/{self.database}/{name}"

    def _log_dir(self, name: str) -> str:
        return f"{self.table_dir(name)}/_log"

    def _fs(self, path: str):
        return hadoop_path(self.spark, path)

    def _exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return fs.exists(p)

    def _commits(self, name: str) -> list[str]:
        """Paths of the commit records, the newest first (file names only, one per commit)."""
        p, fs = self._fs(self._log_dir(name))
        if not fs.exists(p):
            return []
        names = [str(f.getPath()) for f in fs.listStatus(p) if f.getPath().getName()[:1] not in "._"]
        return sorted((n for n in names if n.endswith(".json")), reverse=True)

    def _read_commit(self, path: str) -> Row | None:
        """A commit record; None for one that a crash left unfinished."""
        p, fs = self._fs(path)
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            rec = json.loads(text)
            rec["committed_at"] = _dt.datetime.fromisoformat(rec["committed_at"]).astimezone(_dt.timezone.utc).replace(tzinfo=None)
            return Row(**{f.name: rec[f.name] for f in LOG_SCHEMA.fields})
        except (ValueError, KeyError, TypeError):
            return None

    def log(self, name: str) -> DataFrame:
        """Commit rows of ``name`` (empty before the first commit)."""
        paths = self._commits(name)
        if not paths:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(paths).filter("manifest_list IS NOT NULL")

    def current(self, name: str):
        """The newest commit row, or None for a table never published."""
        for path in self._commits(name):
            row = self._read_commit(path)
            if row is not None:
                return row
        return None

    def repair(self, name: str) -> None:
        """Point the catalog at the current version again (after a crash between commit and catalog)."""
        row = self.current(name)
        if row is not None and self.register:
            self._point_catalog(name, row["manifest_list"], self.spark.read.parquet(row["manifest_list"]).schema)

    def discard(self, staged: Staged) -> None:
        """Delete a staged version that will not be committed."""
        p, fs = self._fs(staged.path)
        fs.delete(p, True)

    # ------------------------------------------------------------ write
    def stage(self, name: str, df: DataFrame) -> Staged:
        """Write ``df`` to a fresh version folder of ``name``; nothing becomes
        visible until ``commit``.  Safe to call from several threads at once."""
        snapshot_id = uuid.uuid4().int >> 65
        path = f"{self.table_dir(name)}/data/snapshot_id={snapshot_id}"
        obs = Observation(f"publish_{name}_{snapshot_id}")
        sc = self.spark.sparkContext
        # Named jobs: event logs attribute cluster time to the table (per thread).
        sc.setJobDescription(f"publish {self.database}.{name}")
        try:
            (df.observe(obs, F.count(F.lit(1)).alias("added_records"))
               .write.mode("errorifexists").parquet(path))
        finally:
            sc.setJobDescription(None)
        return Staged(name, snapshot_id, path, int(obs.get.get("added_records", 0)), df.schema)

    def commit(self, staged: Staged, operation: str = "overwrite",
               extra_summary: dict[str, str] | None = None) -> int:
        """Make a staged version current: one commit record, then the catalog pointer."""
        name = staged.name
        parent = self.current(name)
        summary = {
            "spark.app.id": self.spark.sparkContext.applicationId,
            "added-records": str(staged.added_records),
            "format-version": FORMAT_VERSION,
            **(extra_summary or {}),
        }
        seq = 0 if parent is None else parent["sequence_number"] + 1
        commit = Row(snapshot_id=staged.snapshot_id,
                     parent_id=None if parent is None else parent["snapshot_id"],
                     sequence_number=seq,
                     committed_at=_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
                     operation=operation, manifest_list=staged.path, summary=summary)
        self._write_commit(name, commit)
        if self.register:
            self._point_catalog(name, staged.path, staged.schema)
        return staged.snapshot_id

    def publish(self, name: str, df: DataFrame, operation: str = "overwrite",
                extra_summary: dict[str, str] | None = None) -> int:
        """Create or replace ``name`` with ``df``'s rows; returns the new snapshot id."""
        return self.commit(self.stage(name, df), operation, extra_summary)

    def _write_commit(self, name: str, commit: Row) -> None:
        """One JSON line per commit, renamed into place whole; a second writer that took the same
        sequence number first makes this one fail instead of forking the history."""
        rec = commit.asDict()
        # Explicit UTC offset: readers in any session time zone get the same instant.
        rec["committed_at"] = rec["committed_at"].isoformat(timespec="microseconds") + "+00:00"
        place = f"{self._log_dir(name)}/{commit['sequence_number']:012d}.json"
        p, fs = self._fs(place)
        part, _ = self._fs(f"{self._log_dir(name)}/.{commit['snapshot_id']}.part")
        out = fs.create(part, False)
        try:
            out.write(bytearray((json.dumps(rec) + "\n").encode("utf-8")))
        finally:
            out.close()
        if fs.exists(p):
            if self._read_commit(place) is not None:
                fs.delete(part, False)
                raise FileExistsError(f"commit {commit['sequence_number']} of {self.database}.{name} was made by another writer")
            fs.delete(p, False)      # the rest of an unfinished commit
        if not fs.rename(part, p):
            raise FileExistsError(f"commit {commit['sequence_number']} of {self.database}.{name} was made by another writer")

    def _point_catalog(self, name: str, path: str, schema) -> None:
        """Point ``<db>.<name>`` at the new version.  Same columns and types: one
        location swap in the metastore, so readers always find the table.  A
        changed schema re-creates the (external) entry; files are never dropped."""
        full = f"`{self.database}`.`{name}`"
        shape = [(f.name, f.dataType) for f in schema.fields]
        if self.spark.catalog.tableExists(f"{self.database}.{name}"):
            current = [(f.name, f.dataType) for f in self.spark.table(full).schema.fields]
            if current == shape:
                self.spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
                self.spark.sql(f"REFRESH TABLE {full}")
                return
            self.spark.sql(f"DROP TABLE {full}")
        self.spark.catalog.createTable(f"{self.database}.{name}", path=path, source="parquet", schema=schema)

    # ------------------------------------------------------------ read
    def table(self, name: str, snapshot_id: int | None = None) -> DataFrame:
        """Current contents, or those of an older snapshot (time travel)."""
        if snapshot_id is None:
            row = self.current(name)
        else:
            row = self.log(name).filter(F.col("snapshot_id") == snapshot_id).first()
        if row is None:
            raise KeyError(f"no such table/snapshot: {self.database}.{name} {snapshot_id or ''}")
        if snapshot_id is not None and not self._exists(row["manifest_list"]):
            raise KeyError(f"snapshot {snapshot_id} of {self.database}.{name} has expired")
        return self.spark.read.parquet(row["manifest_list"])

    def expire_versions(self, name: str, keep_last: int = 1) -> list[int]:
        """Delete the data of all but the newest ``keep_last`` versions (each version
        is a full copy).  Commit records stay, so history is complete; reading an
        expired version raises.  Returns the expired snapshot ids."""
        if keep_last < 1:
            raise ValueError("keep_last must be at least 1")
        old = (self.log(name).orderBy(F.col("sequence_number").desc())
               .select("snapshot_id", "manifest_list").offset(keep_last).collect())  # one row per commit
        expired = []
        for r in old:
            p, fs = self._fs(r["manifest_list"])
            if fs.exists(p):
                fs.delete(p, True)
                expired.append(r["snapshot_id"])
        return expired

    def history(self, name: str) -> DataFrame:
        """made_current_at, snapshot_id, parent_id, is_current_ancestor.

        Commits only ever append a child of the current snapshot, so every
        logged snapshot is an ancestor of (or is) the current one.
        """
        return self.log(name).select(
            F.col("committed_at").alias("made_current_at"), "snapshot_id", "parent_id",
            F.lit(True).alias("is_current_ancestor"))

    def snapshots(self, name: str) -> DataFrame:
        """committed_at, snapshot_id, parent_id, operation, manifest_list, summary."""
        return self.log(name).select("committed_at", "snapshot_id", "parent_id", "operation",
                                     "manifest_list", "summary")


def create_or_replace_table(tables: VersionedTables, name: str, df: DataFrame) -> int:
    """Atomic replace of one table (new version folder + commit row)."""
    return tables.publish(name, df, operation="overwrite")


def publish_all(tables: VersionedTables, frames: list[tuple[str, DataFrame]],
                parallelism: int = 1) -> dict[str, int]:
    """Publish tables in the given order and stop at the first failure: the
    tables before it are published, it and the ones after are not.

    With ``parallelism`` > 1 the writes run as concurrent Spark jobs (small
    tables no longer leave the cluster idle one after another), while the
    commits still happen one by one in the given order.  A version written
    after a failed one is deleted and never committed, so the visible outcome is the same
    as publishing sequentially.
    """
    done: dict[str, int] = {}
    if parallelism <= 1:
        for name, df in frames:
            done[name] = tables.publish(name, df)
        return done
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = [(name, pool.submit(tables.stage, name, df)) for name, df in frames]
        failure = None
        for name, fut in futures:
            try:
                staged = fut.result()
                if failure is None:
                    done[name] = tables.commit(staged)
                else:
                    tables.discard(staged)
            except Exception as e:  # keep waiting for the rest, commit nothing after this
                failure = failure or e
    if failure is not None:
        raise failure
    return done


def audit_log(history: DataFrame, snapshots: DataFrame) -> DataFrame:
    """history JOIN snapshots ON snapshot_id: when each snapshot became current, its
    operation and the app that wrote it, ordered by time."""
    h, s = history.alias("h"), snapshots.alias("s")
    return (h.join(s, F.col("h.snapshot_id") == F.col("s.snapshot_id"))
            .select(F.col("h.made_current_at"), F.col("s.operation"), F.col("h.snapshot_id"),
                    F.col("h.is_current_ancestor"),
                    map_value(F.col("s.summary"), "spark.app.id").alias("spark_app_id"))
            .orderBy("made_current_at"))
