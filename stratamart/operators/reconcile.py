"""Reconciliation of two copies of a table, by checksums first and by rows where those differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.operators.lookups import pin

BUCKETS = 4096


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def checksums(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, rows, low, high, both``: a fingerprint of the rows of each bucket of keys, in whatever order they come.

    Halves of row hashes are added up, so a row that stands twice changes them; their
    exclusive or is taken as well. The aggregate is combined before the shuffle: each
    task sends a row per bucket.
    """
    rows = df.select(_bucket(keys, buckets).alias("bucket"), F.xxhash64(*keys, *columns).alias("h"))
    # Halves of 32 bits, so that sums of some billion rows fit.
    low, high = F.col("h").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright("h", 32)
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.bit_xor("h").alias("both")
    )


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys whose rows differ: the keys, ``problem``, ``left_rows`` and ``right_rows``.

    ``problem`` is ``missing`` (no row on the right), ``unexpected`` (none on the left),
    ``repeated`` (the same rows, some more often on one side) or ``changed``. Only rows in
    buckets whose checksums differ are shuffled; the list of these has ``buckets`` rows at
    most. NULLs equal NULLs. Both sides are read when this is called, and again by the result.
    """
    names = ["rows", "low", "high", "both"]
    one, two = (checksums(df, keys, columns, buckets) for df in (left, right))
    met = one.select("bucket", F.struct(*names).alias("l")).join(two.select("bucket", F.struct(*names).alias("r")), "bucket", "full")
    differ, _ = pin(met.where(~F.col("l").eqNullSafe(F.col("r"))).select("bucket"), "differing-buckets")

    def rows(df: DataFrame, side: str) -> DataFrame:
        suspect = df.withColumn("bucket", _bucket(keys, buckets)).join(F.broadcast(differ), "bucket", "left_semi")
        other = {"left": "right", "right": "left"}[side]
        return suspect.select(*keys, F.xxhash64(*keys, *columns).alias("_h"), F.lit(1).alias(side), F.lit(0).alias(other))

    both = rows(left, "left").unionByName(rows(right, "right"))
    # Rows of equal content are counted before keys are judged, so a hot key is one row per content.
    content = both.groupBy(*keys, "_h").agg(F.sum("left").alias("left"), F.sum("right").alias("right"))
    judged = content.groupBy(*keys).agg(
        F.sum("left").alias("left_rows"), F.sum("right").alias("right_rows"),
        F.max((F.col("left") != F.col("right"))).alias("_differs"), F.max((F.col("left") == 0) | (F.col("right") == 0)).alias("_changed"),
    )
    problem = (
        F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "unexpected").when(F.col("_changed"), "changed").otherwise("repeated")
    )
    return judged.where("_differs").select(*keys, problem.alias("problem"), "left_rows", "right_rows")
