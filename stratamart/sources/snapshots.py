"""Tables that keep every run, as snapshots: small files are joined, old runs forgotten, unneeded files deleted.

A snapshot is a list of files, each with the least and greatest run it holds, and of the
runs loaded so far. Appending, compacting and forgetting write new files and then a new
snapshot; they never change a file. Readers take the newest finished snapshot, or one
they name, and are not affected by what comes after it until it is expired. One writer at
a time; expiring counts as writing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratamart.session import side_by_side
from stratamart.sources.landing import finished_runs

RUN = "_run"
TARGET_BYTES = 256 << 20
# A row per file, and one without a path per run that was loaded, with the rows it brought.
_ENTRIES = "path string, bytes bigint, row_count bigint, first_run string, last_run string"


class SnapshotLog:
    """A table of ``schema`` to which runs are added; readers see their name in the column ``_run``.

    The driver holds the names of the files, which Spark needs to read them, never rows.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        if RUN in schema.names:
            raise ValueError(f"the column {RUN} is the log's own")
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])

    def snapshots(self) -> list[str]:
        """Names of the finished snapshots, oldest first."""
        return sorted(finished_runs(self.spark, self.root, "snapshot"))

    def entries(self, snapshot: str | None = None) -> DataFrame:
        """Files and runs of a snapshot, by default the newest; none before the first run."""
        found = self.snapshots()
        if not found:
            return self.spark.createDataFrame([], _ENTRIES)
        return self.spark.read.schema(_ENTRIES).parquet(f"{self.root}/snapshot/run_id={snapshot or found[-1]}")

    def files(self, snapshot: str | None = None) -> DataFrame:
        return self.entries(snapshot).where("path IS NOT NULL")

    def runs(self, snapshot: str | None = None) -> DataFrame:
        """Every run that was loaded, forgotten ones too, and its rows."""
        return self.entries(snapshot).where("path IS NULL").select(F.col("first_run").alias(RUN), "row_count")

    def read(self, snapshot: str | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """The rows of a snapshot, or only those of the runs from ``since`` to ``until``; only files with such runs are opened."""
        files = self.files(snapshot)
        if since is not None:
            files = files.where(F.col("last_run") >= since)
        if until is not None:
            files = files.where(F.col("first_run") <= until)
        rows = self._open(files)
        if since is not None:
            rows = rows.where(F.col(RUN) >= since)
        return rows if until is None else rows.where(F.col(RUN) <= until)

    def append(self, df: DataFrame, run: str) -> int:
        """Add the rows of a run; returns how many. A run that was loaded before adds nothing, also after it was forgotten."""
        if self.runs().where(F.col(RUN) == run).limit(1).count():
            return 0
        new = self._store(df.withColumn(RUN, F.lit(run)))
        added = new.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
        loaded = self.spark.createDataFrame([(None, None, added, run, run)], _ENTRIES)
        self._publish(self.entries().unionByName(new).unionByName(loaded))
        return added

    def compact(self, target_bytes: int = TARGET_BYTES) -> int:
        """Join files of less than half the target to files of about the target; returns how many files are fewer.

        Small files are taken by run, and as many neighbours as make up an even part are read
        one after another into one file, so a file holds neighbouring runs and a run of any
        size is cut into even parts. Rows are neither shuffled nor sorted: a task holds what
        its writer buffers, whatever the target. Larger files stay as they are.
        """
        files = self.files()
        small = files.where(F.col("bytes") < target_bytes // 2)
        before, size = small.agg(F.count(F.lit(1)), F.sum("bytes")).first()
        parts = -(-(size or 0) // target_bytes)
        if before <= parts:
            return 0
        groups: dict[int, list[str]] = {}
        passed = 0
        for row in small.select("path", "bytes", "first_run", "last_run").orderBy("first_run", "last_run", "path").collect():
            groups.setdefault((2 * passed + row["bytes"]) * parts // (2 * size), []).append(row["path"])
            passed += row["bytes"]
        joined, wave = [], max(self.spark.sparkContext.defaultParallelism, 1)
        jobs = [lambda paths=paths: self._store(self._open_paths(paths).coalesce(1)) for paths in groups.values()]
        for start in range(0, len(jobs), wave):
            joined += [row for stored in side_by_side(jobs[start : start + wave]) for row in stored.collect()]
        new = self.spark.createDataFrame(joined, _ENTRIES)
        self._replace(small, new, keeps_rows=True)
        return before - new.count()

    def forget(self, before: str) -> int:
        """Take the runs whose name is less than ``before`` out of the table; returns how many rows went.

        A file of such runs alone is left out, a file that also holds others is rewritten.
        """
        old = self.files().where(F.col("first_run") < before)
        if not old.limit(1).count():
            return 0
        stays = F.col(RUN) >= before
        new = self._store(self._open(old.where(F.col("last_run") >= before)).where(stays))
        return self._replace(old, new)

    def expire(self, keep: int = 1) -> int:
        """Delete snapshots older than the newest ``keep`` and every file that none of those names; returns how many files went.

        What failed attempts left behind goes too.
        """
        found = self.snapshots()
        live: dict[str, set[str]] = {}
        for snapshot in found[-keep:]:
            for row in self.files(snapshot).select("path").collect():
                folder, name = row["path"].split("/")
                live.setdefault(folder, set()).add(name)
        for snapshot in found[:-keep]:  # first, so that no reader finds one whose files are missing
            self._delete(f"snapshot/run_id={snapshot}")
        gone = 0
        for folder in self._names("data"):
            stored = [n for n in self._names(f"data/{folder}") if n.endswith(".parquet")]
            dead = [n for n in stored if n not in live.get(folder, ())]
            gone += len(dead)
            if folder not in live:
                self._delete(f"data/{folder}")
            else:
                for name in dead:
                    self._delete(f"data/{folder}/{name}")
        return gone

    def _open(self, files: DataFrame) -> DataFrame:
        return self._open_paths([row["path"] for row in files.select("path").collect()])

    def _open_paths(self, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/data/{path}" for path in paths])

    def _store(self, rows: DataFrame) -> DataFrame:
        """Write rows to a folder of their own; the entries of its files."""
        folder = uuid.uuid4().hex
        rows.select(*self.schema.names).write.parquet(f"{self.root}/data/{folder}")
        stored = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{folder}")
        path = F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name"))
        files = stored.groupBy(path.alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count(F.lit(1)).alias("row_count"), F.min(RUN).alias("first_run"), F.max(RUN).alias("last_run")
        )
        return self.spark.createDataFrame(files.collect(), _ENTRIES)  # used several times

    def _replace(self, old: DataFrame, new: DataFrame, keeps_rows: bool = False) -> int:
        """Publish a snapshot with ``new`` files for ``old`` ones; returns how many rows are fewer."""
        fewer = _rows(old) - _rows(new)
        if keeps_rows and fewer:
            raise RuntimeError(f"the new files hold {fewer} rows fewer; the table is unchanged")
        gone = old.select(F.col("path").alias("_gone"))
        self._publish(self.entries().join(gone, F.col("path") == F.col("_gone"), "left_anti").unionByName(new))
        return fewer

    def _publish(self, entries: DataFrame) -> None:
        found = self.snapshots()
        number = int(found[-1]) + 1 if found else 0
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/snapshot/run_id={number:010d}")

    def _names(self, folder: str) -> Sequence[str]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []

    def _delete(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def _rows(files: DataFrame) -> int:
    return files.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
