"""Landed files: one folder per dataset, one ``run_id=`` folder per run."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from stratamart.functions.timestamps import from_epoch_micros, run_timestamp, utc_naive
from stratamart.session import side_by_side

_COLUMNS = "_columns.json"  # readers of Parquet pass over names that begin so


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    counter = Observation()
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def land_parquet(df: DataFrame, landing: str, dataset: str, run_id: str) -> int:
    """Write a dataset of a run as Parquet, with a note of its columns; the rows are counted by the write."""
    df, counter = _observed(df)
    path = f"{landing}/{dataset}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)  # takes an older note away
    _note_columns(df.sparkSession, path, df.schema)
    return counter.get["rows"]


def _note_columns(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep the columns of a folder's files, and how many files there are, beside them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path, _COLUMNS)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    note = {"files": len(files.listStatus(at.getParent())), "columns": schema.jsonValue()}
    out = files.create(at, True)
    try:
        out.write(bytearray(json.dumps(note).encode()))
    finally:
        out.close()


def _noted_columns(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns noted beside a folder's files, unless files were added since, perhaps with others."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path, _COLUMNS)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        note = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    unchanged = len(files.listStatus(at.getParent())) == note["files"] + 1  # the note itself
    return T.StructType.fromJson(note["columns"]) if unchanged else None


def land_json(df: DataFrame, landing: str, dataset: str, run_id: str) -> int:
    """Write a feed of a run as JSON lines, which readers can split (gzipped ones are read too, one task a file).

    A frame with the one column ``json`` holds finished JSON text, line by line.
    """
    is_text = df.columns == ["json"]
    df, counter = _observed(df)
    writer = df.write.mode("overwrite")
    (writer.text if is_text else writer.json)(f"{landing}/{dataset}/run_id={run_id}")
    return counter.get["rows"]


def land_all(frames: Mapping[str, DataFrame], feeds: Collection[str], landing: str, run_id: str) -> dict[str, dict]:
    """Land every dataset of a run, side by side; return ``{dataset: {path, row_count}}``."""

    def land(dataset: str) -> dict:
        write = land_json if dataset in feeds else land_parquet
        rows = write(frames[dataset], landing, dataset, run_id)
        return {"path": f"{landing}/{dataset}/run_id={run_id}", "row_count": rows}

    return dict(zip(frames, side_by_side([lambda d=dataset: land(d) for dataset in frames])))


def latest_run(spark: SparkSession, landing: str, dataset: str) -> str:
    """The last finished run of a dataset in name order; a run is finished once it has ``_SUCCESS``."""
    finished = finished_runs(spark, landing, dataset)
    if not finished:
        raise FileNotFoundError(f"no finished run of {dataset} under {landing}")
    return max(finished)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def finished_runs(spark: SparkSession, landing: str, dataset: str) -> set[str]:
    """Names of a dataset's runs whose writing has ended well."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/{dataset}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return set()
    folders = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith("run_id=")]
    has = lambda folder, name: files.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, name))
    together = has(path, "_SUCCESS")  # runs written by one partitioned job are marked together
    done = [f for f in folders if has(f, "_SUCCESS") or (together and not has(f, "_temporary"))]
    return {f.getName().removeprefix("run_id=") for f in done}


def latest_common_run(spark: SparkSession, landing: str, datasets: Collection[str]) -> str:
    """The last run that every dataset has finished, so that no two are mixed."""
    common = set.intersection(*[finished_runs(spark, landing, d) for d in datasets])
    if not common:
        raise FileNotFoundError(f"no run under {landing} is finished for all of {', '.join(datasets)}")
    return max(common)


def with_lineage(df: DataFrame, run_ts=None, source: Column | None = None) -> DataFrame:
    """Add the load time and the file each row came from."""
    return df.withColumn("_load_ts", run_timestamp(run_ts)).withColumn(
        "_source_file", F.col("_metadata.file_path") if source is None else source
    )


def _as_declared(field: T.StructField, stored: T.StructType) -> Column:
    """A file's column as the declared type, whatever type the file has it in."""
    names = {name.lower(): name for name in stored.names}
    if field.name.lower() not in names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    name = names[field.name.lower()]
    column, kind = F.col(f"`{name}`"), stored[name].dataType
    if isinstance(field.dataType, T.TimestampNTZType):
        if isinstance(kind, T.IntegralType):
            column = from_epoch_micros(column)
        elif isinstance(kind, T.TimestampType):
            column = utc_naive(column)
    return column.cast(field.dataType).alias(field.name)


def read_landed_parquet(
    spark: SparkSession,
    landing: str,
    dataset: str,
    schema: T.StructType,
    run_id: str | None = None,
    run_ts=None,
) -> DataFrame:
    """A run of a dataset in the declared schema, with lineage columns.

    Columns are matched by name without regard to case or order. Missing ones are
    NULL, further ones are ignored, others are cast, and a value that does not fit
    fails the job. Integers declared as timestamps are microseconds of the epoch.
    """
    run_id = run_id or latest_run(spark, landing, dataset)
    path = f"{landing}/{dataset}/run_id={run_id}"
    noted = _noted_columns(spark, path)
    # Files that others wrote may differ in their columns, so all their footers are read; types
    # that cannot be merged fail the job.
    files = spark.read.option("mergeSchema", True).parquet(path) if noted is None else spark.read.schema(noted).parquet(path)
    columns = [_as_declared(field, files.schema) for field in schema.fields]
    return with_lineage(files.select(*columns, "_metadata"), run_ts).drop("_metadata")


def read_landed_feed(
    spark: SparkSession, landing: str, dataset: str, run_id: str | None = None, run_ts=None
) -> DataFrame:
    """A run of a JSON feed as variant rows, with lineage columns."""
    run_id = run_id or latest_run(spark, landing, dataset)
    return read_json_rows(spark, f"{landing}/{dataset}/run_id={run_id}", run_ts=run_ts)


def read_json_rows(
    spark: SparkSession, path: str, whole_file: bool = False, require_array: bool = False, run_ts=None
) -> DataFrame:
    """``(raw_data variant, _load_ts, _source_file)``, one row per JSON object.

    A record is an object or an array of objects, whose outer array is taken off.
    By default each line is a record, so large files are split between tasks;
    ``whole_file`` is for pretty-printed files that hold one record. Malformed
    JSON fails the job, and so does a record that is no array if one is required.
    """
    records = (
        spark.read.option("singleVariantColumn", "_record")
        .option("multiLine", whole_file)
        .option("mode", "FAILFAST")
        .json(path)
        .select("_record", "_metadata")
    )
    items = F.try_variant_get("_record", "$", "array<variant>")
    if require_array:
        single = F.raise_error(F.lit("feed record is not a list")).cast("array<variant>")
    else:
        single = F.array("_record")
    rows = records.select(F.explode(F.coalesce(items, single)).alias("raw_data"), "_metadata")
    return with_lineage(rows, run_ts).drop("_metadata")
