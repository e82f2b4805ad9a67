"""High-water marks of incremental extracts, kept in ``metadata.watermarks``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.timestamps import run_timestamp
from stratamart.operators.merge import changed_since, high_water_mark
from stratamart.sources.store import LayerStore


def stored_mark(store: LayerStore, dataset: str):
    """The dataset's last recorded mark, or None before its first extract."""
    if not store.exists("metadata", "watermarks"):
        return None
    marks = store.read("metadata", "watermarks").where(F.col("dataset") == dataset)
    return marks.agg(F.max("high_water_mark")).first()[0]


def record_mark(store: LayerStore, dataset: str, loaded: DataFrame, modified: str, run_ts=None) -> None:
    """Remember the newest modification time that was loaded; an empty load changes nothing."""
    mark = high_water_mark(loaded, modified).where(F.col("high_water_mark").isNotNull())
    store.append(
        mark.select(
            F.lit(dataset).alias("dataset"),
            F.col("high_water_mark").cast("timestamp_ntz"),
            run_timestamp(run_ts).alias("recorded_at"),
        ),
        "metadata",
        "watermarks",
    )


def extract_changes(store: LayerStore, source: DataFrame, dataset: str, modified: str) -> DataFrame:
    """Rows of the source modified since the dataset's mark."""
    return changed_since(source, modified, stored_mark(store, dataset))
