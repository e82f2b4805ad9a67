"""Checked loads: good rows, and bad rows with their reasons, out of one scan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from stratamart.session import shared_dir


class LoadRejected(ValueError):
    """Too many rows of a load are bad."""


@dataclass(frozen=True)
class CheckedLoad:
    """``good`` rows in their declared types, ``bad`` rows as they came with ``reasons``, and how many of each."""

    good: DataFrame
    bad: DataFrame
    good_rows: int
    bad_rows: int


def _reason(name: str, bad: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(name))


def _declared(df: DataFrame, schema: T.StructType) -> tuple[list[Column], dict[str, Column]]:
    """Columns in their declared types, and for each a test whether a value does not fit. Missing columns are NULL."""
    columns, unfit = [], {}
    for field in schema:
        kind = field.dataType.simpleString()
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            if not field.nullable:
                unfit[f"{field.name} is missing"] = F.lit(True)
            continue
        own = F.col(f"`{field.name}`")
        cast = own.try_cast(field.dataType)
        columns.append(cast.alias(field.name))
        unfit[f"{field.name} is no {kind}"] = own.isNotNull() & cast.isNull()
        if not field.nullable:
            unfit[f"{field.name} is missing"] = own.isNull()
    return columns, unfit


def load_checked(
    df: DataFrame,
    schema: T.StructType,
    rules: Mapping[str, Column] | None = None,
    max_bad_share: float = 1.0,
    path: str | None = None,
) -> CheckedLoad:
    """Write rows once, good and bad ones apart, and read both back.

    A row is bad if a value does not fit its declared type, if a column that must not be
    null is, or if one of ``rules`` holds; these are conditions over the declared columns, by the
    reason they stand for, and one that is NULL does not hold. Bad rows keep all their
    columns as they came, under ``row``. Both sides are written by one job, whose
    counters tell whether more than ``max_bad_share`` of the rows are bad: the load is
    then rejected, and the files stay to be looked at. An empty load is good.
    """
    path = path or shared_dir(df.sparkSession, "checked")
    columns, unfit = _declared(df, schema)
    tests = [_reason(name, bad) for name, bad in unfit.items()]
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    typed = df.select(own, F.struct(*columns).alias("typed"), F.array_compact(F.array(*tests)).alias("unfit"))
    # A rule over a value that does not fit says nothing; its column is NULL.
    named = typed.select("row", "typed", "unfit", "typed.*")
    reasons = F.concat("unfit", F.array_compact(F.array(*[_reason(n, c) for n, c in (rules or {}).items()])) if rules else F.array().cast("array<string>"))
    judged = named.select("row", "typed", reasons.alias("reasons")).withColumn("bad", F.size("reasons") > 0)
    # Good rows are stored typed, bad ones as they came; neither carries the other.
    kept = judged.select(
        F.when(F.col("bad"), F.col("row")).alias("row"), F.when(~F.col("bad"), F.col("typed")).alias("typed"),
        F.when(F.col("bad"), F.col("reasons")).alias("reasons"), "bad",
    )
    counted = Observation()
    kept.observe(counted, F.count(F.lit(1)).alias("rows"), F.count_if("bad").alias("bad")).write.partitionBy("bad").parquet(path)
    rows, bad_rows = counted.get["rows"], counted.get["bad"]
    if rows and bad_rows > max_bad_share * rows:
        raise LoadRejected(f"{bad_rows} of {rows} rows are bad; see {path}")
    stored = df.sparkSession.read.schema(kept.schema).parquet(path)
    return CheckedLoad(
        stored.where("NOT bad").select("typed.*"), stored.where("bad").select("row", "reasons"), rows - bad_rows, bad_rows
    )


def reason_counts(load: CheckedLoad) -> DataFrame:
    """``reason, rows``: the bad rows of each reason; a row may have several."""
    return load.bad.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
