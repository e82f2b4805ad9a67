"""Joins of a large table to a reference table whose size is checked, not assumed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from stratamart.session import shared_dir

# Rows of a lookup that may be sent to every executor, and bytes as stored.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
SALTS = 64


def pin(df: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """Write ``df`` once to the shared folder; return the written table and its rows.

    The table has no lineage left to recompute when an executor is lost, and the
    count comes from the write itself.
    """
    written = Observation()
    path = shared_dir(df.sparkSession, purpose)
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), written.get["rows"]


def stored_bytes(pinned: DataFrame) -> int:
    """Size of a written table's files."""
    return int(pinned._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def salted_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str, salts: int = SALTS, salt_by: Sequence[str] = ()
) -> DataFrame:
    """Equi-join in which every key of ``facts`` is spread over ``salts`` tasks.

    The salt is a hash of the columns ``salt_by``, best a key of the facts, and without
    them of the whole row, for which every column has to be read. It is no random
    number, so a re-run task sends its rows to the same partitions.
    """
    atomic = [f.name for f in facts.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    hashed = list(salt_by) or atomic
    spread = facts.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salt_by: Sequence[str] = (),
) -> DataFrame:
    """Join ``facts`` to ``lookup`` without shuffling the facts where that is safe.

    The lookup is written once and measured when this is called. Up to ``max_rows``
    rows and ``BROADCAST_BYTES`` bytes it is broadcast; beyond that the join is salted
    by ``salt_by``, because lookup keys are few and one of them may belong to most facts.
    """
    pinned, rows = pin(lookup, "lookup")
    if rows <= max_rows and stored_bytes(pinned) <= BROADCAST_BYTES:
        return facts.join(F.broadcast(pinned), list(on), how)
    return salted_join(facts, pinned, on, how, salt_by=salt_by)
