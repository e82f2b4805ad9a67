"""Layer tables: versioned folders behind catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from stratamart.constants import LAYERS


# Paths of files, long and few. Parquet compares every value of a column byte by byte with the least
# and greatest one, which for these takes longer than all else of a row, and nothing filters by them.
_PATHS = ("_source_file", "_raw_source_file")
_OPTIONS = {f"parquet.column.statistics.enabled#{column}": "false" for column in _PATHS}


def _quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class LayerStore:
    """Tables of all layers under one root folder.

    Every attempt to write goes to a folder of its own and then moves the table's
    location to it. Readers see the old or the new version, never an empty or
    half-written table, and a failed attempt leaves the current version as it was,
    also when it repeats the run that wrote it. Only a change of columns has to drop
    and create the catalog entry, so for that moment the table is missing.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}{layer}`.`{table}`"

    def path(self, layer: str, table: str, run_id: str) -> str:
        """A new folder for one attempt to write."""
        return f"{self.root}/{layer}/{table}/run_id={run_id}/{uuid.uuid4().hex}"

    def create_layers(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}`")

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.prefix}{layer}.{table}")

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def create_empty(self, layer: str, table: str, schema: T.StructType) -> None:
        """Declare a table that has no rows yet."""
        if not self.exists(layer, table):
            self.write(self.spark.createDataFrame([], schema), layer, table, "empty")

    def write(self, df: DataFrame, layer: str, table: str, run_id: str) -> int:
        """Replace a table's content; returns its rows, counted by the write."""
        counter, path = Observation(), self.path(layer, table, run_id)
        df.observe(counter, F.count(F.lit(1)).alias("rows")).write.options(**_OPTIONS).mode("overwrite").parquet(path)
        self._point(layer, table, path, df.schema)
        return counter.get["rows"]

    def append(self, df: DataFrame, layer: str, table: str) -> int:
        """Add rows to a small table kept across runs."""
        counter, path = Observation(), self._log(layer, table)
        df.observe(counter, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
        if self.exists(layer, table):
            self.spark.catalog.refreshTable(self.name(layer, table))
        else:
            self._create(layer, table, path)
        return counter.get["rows"]

    def append_run(self, df: DataFrame, layer: str, table: str, run_id: str) -> int:
        """Add a run to a table that keeps every run, as the partition ``_run`` of its own.

        Repeating a run replaces its partition, so a retried load adds nothing twice. A
        table that runs replaced so far goes on as one that keeps them, with its rows as
        the run ``initial``.
        """
        counter = Observation()
        replaced = self.exists(layer, table) and not self._is_log(layer, table)
        path = self._new_log(layer, table) if replaced else self._log(layer, table)
        if replaced:
            self.read(layer, table).write.options(**_OPTIONS).parquet(f"{path}/_run=initial")
        counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
        counted.write.options(**_OPTIONS).mode("overwrite").parquet(f"{path}/_run={run_id}")
        if replaced:
            self.spark.sql(f"DROP TABLE {self.name(layer, table)}")
        if not self.exists(layer, table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            self.spark.sql(
                f"CREATE TABLE {self.name(layer, table)} ({columns}, `_run` STRING) USING parquet "
                f"PARTITIONED BY (`_run`) LOCATION {_quoted(path)}"
            )
        for run in (["initial"] if replaced else []) + [run_id]:
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD IF NOT EXISTS PARTITION (`_run` = {_quoted(run)})")
        self.spark.catalog.refreshTable(self.name(layer, table))
        return counter.get["rows"]

    def _log(self, layer: str, table: str) -> str:
        """Folder of a table that is added to; one that runs replace cannot be added to.

        A table that does not exist yet, or no longer, starts in a new folder.
        """
        if not self.exists(layer, table):
            return self._new_log(layer, table)
        if not self._is_log(layer, table):
            raise ValueError(f"{layer}.{table} is replaced by each run; reset it before adding to it")
        return self.location(layer, table)

    def _new_log(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}/log-{uuid.uuid4().hex}"

    def _is_log(self, layer: str, table: str) -> bool:
        return self.location(layer, table).rsplit("/", 1)[-1].startswith("log-")

    def location(self, layer: str, table: str) -> str:
        """Folder the table points at now."""
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name(layer, table)}")
        return rows.where("col_name = 'Location'").first()["data_type"]

    def mark(self, layer: str, table: str, key: str) -> str | None:
        """A note kept with a table, across its versions of the same columns."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").where(F.col("key") == key)
        found = rows.first()
        return found["value"] if found else None

    def set_mark(self, layer: str, table: str, key: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(layer, table)} SET TBLPROPERTIES ({_quoted(key)} = {_quoted(value)})")

    def reset(self) -> None:
        """Drop every table of every layer. Files stay on storage, but no later table reads them."""
        for layer in LAYERS:
            database = self.prefix + layer
            if self.spark.catalog.databaseExists(database):
                for table in self.spark.catalog.listTables(database):
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table.name)}")

    def _create(self, layer: str, table: str, path: str) -> None:
        self.spark.sql(f"CREATE TABLE {self.name(layer, table)} USING parquet LOCATION {_quoted(path)}")

    def _point(self, layer: str, table: str, path: str, schema: T.StructType) -> None:
        name = self.name(layer, table)
        if self.exists(layer, table):
            if self.spark.table(name).schema.simpleString() == schema.simpleString():
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
                self.spark.catalog.refreshTable(name)
                return
            self.spark.sql(f"DROP TABLE {name}")
        self._create(layer, table, path)
