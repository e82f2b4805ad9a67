"""Incremental reads and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratamart.operators.latest import latest_by_key
from stratamart.operators.lookups import BROADCAST_BYTES, BROADCAST_ROWS, pin, stored_bytes


def changed_since(df: DataFrame, modified: str, high_water_mark) -> DataFrame:
    """Rows modified at the mark or later, and rows without a modification time.

    The comparison with a literal reaches the source. Rows at the mark itself are read
    again, since more of them may have been committed after it was taken; where commits
    can lag by more, pass a mark that is earlier by the lag. Untimed rows count as newest
    everywhere else, so they too are read each time. An upsert makes both harmless.
    """
    if high_water_mark is None:
        return df
    return df.where(F.col(modified).isNull() | (F.col(modified) >= F.lit(high_water_mark)))


def high_water_mark(df: DataFrame, modified: str) -> DataFrame:
    """The newest modification time as a one-row frame."""
    return df.agg(F.max(modified).alias("high_water_mark"))


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] = (),
    max_keys: int = BROADCAST_ROWS,
) -> DataFrame:
    """Apply a change set to a keyed table; a change older than the row it meets loses.

    Only target rows with a changed key are compared; all others, those without a
    key among them, pass through as they are. The distinct changed keys are written
    once and counted when this is called. Up to ``max_keys`` they are broadcast, and
    the untouched rows are not shuffled; beyond that the same two joins shuffle.
    Changes without a key are left out.
    """
    changes = changes.select(*target.columns).dropna(subset=list(keys))
    changed_keys, count = pin(changes.select(*keys).distinct(), "changed-keys")
    small = count <= max_keys and stored_bytes(changed_keys) <= BROADCAST_BYTES
    changed_keys = F.broadcast(changed_keys) if small else changed_keys
    contested = target.join(changed_keys, list(keys), "left_semi").unionByName(changes)
    untouched = target.join(changed_keys, list(keys), "left_anti")
    return untouched.unionByName(latest_by_key(contested, keys, order, tiebreak))
