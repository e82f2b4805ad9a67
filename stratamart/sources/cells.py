"""Keyed tables of which a change rewrites only the files that hold its keys.

Rows are laid out in cells, ranges of an integer key, and each cell is a folder. A version
of the table is a manifest: the folder of every cell, its least and greatest key and its
rows. A change writes new folders for the cells it touches and then a manifest that
names them and the old folders of all others. Readers take the newest finished manifest,
so they see the table before or after a change. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratamart.operators.merge import upsert
from stratamart.sources.landing import finished_runs

_MANIFEST = "cell bigint, folder string, least bigint, greatest bigint, row_count bigint"


class CellTable:
    """A table of ``schema`` in cells of ``width`` values of the integer column ``key``.

    A NULL key is a cell of its own. The manifest has a row per cell, not per row, and is
    what the driver holds: choose ``width`` so that a cell is some hundred megabytes.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, width: int):
        self.spark, self.root, self.schema, self.key, self.width = spark, root.rstrip("/"), schema, key, width

    def cell(self, key: Column | None = None) -> Column:
        return F.floor((F.col(self.key) if key is None else key) / F.lit(self.width)).cast("bigint")

    def versions(self) -> list[str]:
        """Names of the finished versions, oldest first."""
        return sorted(finished_runs(self.spark, self.root, "manifest"))

    def manifest(self, version: str | None = None) -> DataFrame:
        """The cells of a version, by default the newest; none before the first write."""
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/run_id={version or found[-1]}")

    def read_before(self, version: str, cells: DataFrame) -> DataFrame:
        """What the cells held before a version was written."""
        base = self.before(version)
        return self.spark.createDataFrame([], self.schema) if base is None else self.read(base, cells)

    def read(self, version: str | None = None, cells: DataFrame | None = None) -> DataFrame:
        """The table, or only the cells named in the column ``cell`` of a frame."""
        chosen = self.manifest(version)
        if cells is not None:
            same = F.col("cell").eqNullSafe(F.col("_wanted"))
            chosen = chosen.join(F.broadcast(cells.select(F.col("cell").alias("_wanted")).distinct()), same, "left_semi")
        folders = [row["folder"] for row in chosen.select("folder").collect()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def before(self, version: str) -> str | None:
        """The newest version older than ``version``, whether that exists or not."""
        return max((v for v in self.versions() if v < version), default=None)

    def lookup(self, keys: Sequence[int], version: str | None = None) -> DataFrame:
        """The rows of some keys. Only the folders of their cells are opened, and in them the row groups that may hold them."""
        cells = self.spark.createDataFrame([(k // self.width,) for k in keys], "cell bigint")
        return self.read(version, cells).where(F.col(self.key).isin(list(keys)))

    def write(self, df: DataFrame, version: str | None = None) -> None:
        """Replace the whole table."""
        self._publish(self.stage(df)[1], None, version)

    def replace(self, cells: DataFrame, df: DataFrame, version: str | None = None) -> None:
        """Give the cells named in ``cells`` the rows of ``df``; all others keep their files.

        ``version`` names the result, which must sort after all others; a version that
        exists is left as it is, so a run that is repeated changes nothing twice.
        """
        if version is None or version not in self.versions():
            self.publish(cells, self.stage(df)[1], version)

    def stage(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Store rows that no version names yet: the stored rows, to go on from, and their cells for ``publish``."""
        stored, path = self._files(df)
        return stored.select(*self.schema.names), self._cells_of(stored, path)

    def publish(self, cells: DataFrame, staged: DataFrame, version: str | None = None) -> None:
        """``replace`` with rows that ``stage`` has stored."""
        if version is None or version not in self.versions():
            self._publish(staged, cells.select("cell").distinct(), version)

    def touched(self, changes: DataFrame) -> DataFrame:
        """The cells that hold, or would hold, the keys of ``changes``: a row per cell."""
        return changes.select(self.cell().alias("cell")).distinct()

    def upsert(self, changes: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = ()) -> None:
        """Apply a change set as ``operators.merge.upsert`` does, to the touched cells alone.

        ``changes`` is read several times; pass a stored frame.
        """
        changes = changes.dropna(subset=list(keys))
        cells = self.named(self.touched(changes))
        self.replace(cells, upsert(self.read(cells=cells), changes, keys, order, tiebreak))

    def expire(self, keep: int = 1) -> list[str]:
        """Delete versions older than the newest ``keep`` and the folders that none of the rest names.

        Readers of a kept version are not affected. Returns the deleted folders.
        """
        found = self.versions()
        old, kept = found[:-keep], found[-keep:]
        names = {v: {row["folder"] for row in self.manifest(v).select("folder").collect()} for v in found}
        gone = sorted(set().union(*(names[v] for v in old)) - set().union(*(names[v] for v in kept)))
        # Manifests first, so that no reader finds one whose folders are missing.
        for path in [f"{self.root}/manifest/run_id={v}" for v in old] + gone:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        return gone

    def named(self, cells: DataFrame) -> DataFrame:
        """Cell numbers as a local frame: they are few, and are used several times."""
        return self.spark.createDataFrame([(row["cell"],) for row in cells.collect()], "cell bigint")

    def _files(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Write rows by cell; the written rows and their folder."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        rows = df.select(*self.schema.names).withColumn("_cell", self.cell())
        # Rows of a cell come together, and a large cell is still split into several files.
        rows.hint("rebalance", "_cell").sortWithinPartitions("_cell", self.key).write.partitionBy("_cell").parquet(path)
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_cell", T.LongType())])).parquet(path), path

    def _cells_of(self, stored: DataFrame, path: str) -> DataFrame:
        """The manifest rows of what was written."""
        folder = F.concat(F.lit(f"{path}/_cell="), F.coalesce(F.col("_cell").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
        return stored.groupBy("_cell").agg(
            F.min(self.key).cast("bigint").alias("least"), F.max(self.key).cast("bigint").alias("greatest"), F.count(F.lit(1)).alias("row_count")
        ).select(F.col("_cell").alias("cell"), folder.alias("folder"), "least", "greatest", "row_count")

    def _publish(self, new: DataFrame, replaced: DataFrame | None, version: str | None) -> None:
        found = self.versions()
        manifest = new
        if replaced is not None:
            same = F.col("cell").eqNullSafe(F.col("_gone"))
            kept = self.manifest().join(F.broadcast(replaced.select(F.col("cell").alias("_gone"))), same, "left_anti")
            manifest = kept.unionByName(new)
        version = version or f"{int(found[-1]) + 1 if found else 0:010d}"
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/run_id={version}")
