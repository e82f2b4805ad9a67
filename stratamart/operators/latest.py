"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Keep the newest row of every key, NULL order values counting as newest.

    ``row_number() = 1`` is planned as a group limit on both sides of the shuffle:
    each map task sends on at most one row per key, so a key that holds a large
    share of the input does not land as a whole in one task. ``tiebreak`` makes
    equal ``order`` values deterministic, which a retried task needs too.
    """
    recency = [F.col(c).desc_nulls_first() for c in (*order, *tiebreak)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*recency))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")
