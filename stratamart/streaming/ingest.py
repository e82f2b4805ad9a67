"""Continuous ingest of landed files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from stratamart.operators.latest import latest_by_key
from stratamart.operators.lookups import pin
from stratamart.operators.merge import upsert
from stratamart.sources.cells import CellTable
from stratamart.sources.store import LayerStore


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_filter: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder, or of all folders and files a pattern matches, as a stream."""
    reader = spark.readStream.schema(schema)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def without_repeats(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key of a log; rows without a key are all kept.

    Repeats are left out when a log is read, not while it is written: a watermark
    would also drop rows that are merely late.
    """
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return latest_by_key(log.where(~keyless), keys, order).unionByName(log.where(keyless))


def append_log(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a Parquet log, each arrived row once however late it is, then stop.

    This is the form for large tables: nothing is rewritten and no state is kept. The
    job that reads the log takes ``without_repeats`` of it.
    """
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def upsert_available(
    stream: DataFrame,
    store: LayerStore,
    layer: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    name: str = "stream",
) -> StreamingQuery:
    """Merge what has arrived into a layer table, then stop.

    Each micro-batch writes a version of its own, switches to it, and then records its
    number under the id of its streaming query, which a checkpoint keeps. Streams into
    one table therefore never take each other's batches for their own. A batch repeated
    after a failure finds its record and does nothing, or is merged again, which an
    upsert makes harmless. One stream at a time may write a table.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not store.exists(layer, table):
            merged = latest_by_key(batch.dropna(subset=list(keys)), keys, order, tiebreak)
        elif int(store.mark(layer, table, f"stream.{query}") or -1) >= batch_id:
            return
        else:
            merged = upsert(store.read(layer, table), batch, keys, order, tiebreak)
        store.write(merged, layer, table, f"{name}-{batch_id:010d}")
        store.set_mark(layer, table, f"stream.{query}", str(batch_id))

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_cells_available(
    stream: DataFrame, table: CellTable, keys: Sequence[str], order: Sequence[str], checkpoint: str, tiebreak: Sequence[str] = ()
) -> StreamingQuery:
    """Merge what has arrived into a table in cells, then stop: the form of ``upsert_available`` for large tables.

    Each micro-batch is reduced to one row per key and rewrites the cells that hold those
    keys, as a version of the table; rows without a key are left out. A batch repeated after
    a failure is merged again, which an upsert makes harmless. One stream at a time may
    write a table.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        changes, rows = pin(latest_by_key(batch.dropna(subset=list(keys)), keys, order, tiebreak), "changes")
        if rows:
            cells = CellTable(batch.sparkSession, table.root, table.schema, table.key, table.width)
            cells.upsert(changes, keys, order, tiebreak)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
