"""Deduplication of a stream in Spark's state store, with late rows kept apart.

The keys seen within the watermark's delay are state, so a repeat is recognised without
reading what was written. Spark drops rows older than the watermark; here they go to a
side table instead. Both come out of one streaming query: the deduplicated rows and the
rows as they arrived reach a batch together, so what is missing from the first is known
without asking where the watermark stood.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from stratamart.operators.lookups import BROADCAST_BYTES, BROADCAST_ROWS, pin, stored_bytes
from stratamart.sources.landing import exists


MOST_DAYS = 1000  # that a filter names one by one
NO_DAY = date(1000, 1, 1)  # of rows without an event time


@dataclass(frozen=True)
class Deduplicated:
    """Two tables under ``root``: ``log``, rows in time, and ``late``, rows the watermark had passed.

    Each is a folder of batches, and within a batch of days of the event time. A repeat is a
    row whose key came before, with an event time at most ``delay`` from that of the first.
    No repeat is in either table. Rows without a key cannot be told apart and are all in
    ``late``; so are rows without an event time, but for their repeats.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    event_time: str
    delay: str

    def read(self, table: str, before: int | None = None) -> DataFrame:
        """Rows of ``log`` or ``late``, of all batches or of those before one."""
        path = f"{self.root}/{table}"
        stored = T.StructType([*self.schema.fields, T.StructField("_batch", T.LongType()), T.StructField("_day", T.DateType())])
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], stored)
        rows = self.spark.read.schema(stored).parquet(path)
        return rows if before is None else rows.where(F.col("_batch") < before)

    def rows(self) -> DataFrame:
        """Every row that arrived, without repeats, and whether it was late."""
        return self.read("log").withColumn("late", F.lit(False)).unionByName(self.read("late").withColumn("late", F.lit(True))).drop("_batch", "_day")

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take in what has arrived, then stop. ``stream`` has the columns of ``schema``.

        With very many keys within the delay, set ``spark.sql.streaming.stateStore.providerClass``
        to Spark's RocksDB provider, which keeps them outside the heap.
        """
        # A watermark needs a zoned timestamp; in the session's zone, UTC, it is the same moment.
        timed = stream.where(F.col(self.event_time).isNotNull()).withColumn("_event", F.col(self.event_time).cast("timestamp"))
        kept = timed.withWatermark("_event", self.delay).dropDuplicatesWithinWatermark(list(self.keys)).drop("_event")
        both = kept.withColumn("_kept", F.lit(True)).unionByName(stream.withColumn("_kept", F.lit(False)))
        return both.writeStream.foreachBatch(self._write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch; a repeated one replaces what it wrote."""
        names = self.schema.names
        # Read twice; a cached batch would be lost with its executor, a written one is not.
        stored, count = pin(batch.select(*names, "_kept"), "stream-batch")
        if not count:
            return
        kept, arrived = stored.where("_kept").drop("_kept"), stored.where("NOT _kept").drop("_kept")
        keyless = self._without_key()
        # Repeats within a batch that passed, and in it those of late rows, are one row.
        missing = arrived.where(~keyless).join(kept.select(*self.keys).distinct(), list(self.keys), "left_anti")
        first = Window.partitionBy(*self.keys).orderBy(F.col(self.event_time).asc_nulls_last(), F.xxhash64(*names))
        missing = missing.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")
        late = self._unseen(missing, batch_id).unionByName(arrived.where(keyless))
        self._put(late, "late", batch_id)
        # State expires, and late rows were never in it, so rows in time are looked up too, where it may be.
        self._put(self._unseen(kept.where(~keyless), batch_id, ("late",)), "log", batch_id)

    def _without_key(self) -> Column:
        found = F.lit(False)
        for k in self.keys:
            found |= F.col(k).isNull()
        return found

    def _unseen(self, rows: DataFrame, batch_id: int, tables: Sequence[str] = ("log", "late")) -> DataFrame:
        """Rows whose key no earlier batch holds at most ``delay`` from their event time.

        Only the days around those of the rows are read: the other folders are pruned.
        """
        rows, count = pin(rows, "stream-rows")
        if not count:
            return rows
        asked = rows.select(*self.keys, self.event_time)
        reach = F.expr(f"INTERVAL '{self.delay}'")
        at = F.col(self.event_time)
        edges = asked.select(F.explode(F.array(self._day(at - reach), self._day(at), self._day(at + reach))).alias("day"))
        days = [row["day"] for row in edges.distinct().collect()]
        own = reduce(DataFrame.unionByName, [self._held(table, batch_id, days) for table in tables])
        same = [F.col(f"_{k}") == F.col(k) for k in self.keys]

        def near(moment: Column) -> Column:
            return F.col("_own").eqNullSafe(moment) | F.col("_own").between(moment - reach, moment + reach)

        if count > BROADCAST_ROWS or stored_bytes(asked) > BROADCAST_BYTES:
            return rows.join(own, [*same, near(at)], "left_anti")  # rows and held keys meet in one shuffle
        around = F.broadcast(asked.select(*self.keys, at.alias("_at")))
        seen = own.join(around, [*same, near(F.col("_at"))]).select(*[f"_{k}" for k in self.keys], F.col("_at").alias("_own")).distinct()
        return rows.join(seen, [*same, F.col("_own").eqNullSafe(at)], "left_anti")

    def _held(self, table: str, batch_id: int, days: Sequence[date]) -> DataFrame:
        """Keys and event times of a table's earlier batches, of some days."""
        held = self.read(table, before=batch_id)
        between = held.where(F.col("_day").between(min(days), max(days))) if len(days) > MOST_DAYS else held.where(F.col("_day").isin(days))
        return between.select(*[F.col(k).alias(f"_{k}") for k in self.keys], F.col(self.event_time).alias("_own"))

    def _day(self, moment: Column) -> Column:
        """The folder of a moment; rows without one have a day of their own."""
        return F.coalesce(F.to_date(moment), F.lit(NO_DAY))

    def _put(self, rows: DataFrame, table: str, batch_id: int) -> None:
        dated = rows.withColumn("_day", self._day(F.col(self.event_time)))
        dated.hint("rebalance", "_day").write.mode("overwrite").partitionBy("_day").parquet(f"{self.root}/{table}/_batch={batch_id}")
