"""Type 2 history: one row per key and unbroken spell of the same state."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.functions.timestamps import to_epoch_micros
from stratamart.operators.lookups import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join, pin, stored_bytes

# Rows of one key that a task may sort; a key with more is cut along its time line.
ROWS_PER_TASK = 5_000_000


def _stretches(rows: DataFrame, keys: Sequence[str], changed_at: str, rows_per_task: int) -> DataFrame | None:
    """Add ``_stretch``, which cuts the time line of each hot key; None when no key is hot.

    Rows per key are counted with partial sums. For hot keys alone, approximate
    quantiles of the time give cuts that leave about equal numbers of rows, however
    unevenly the rows lie in time.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows_per_task)
    hot, number = pin(counts, "hot-keys")
    if number == 0:
        return None
    pieces = math.ceil(hot.agg(F.max("_rows")).first()[0] / rows_per_task)
    chosen = hot.select(*keys)
    hot_rows = rows.join(F.broadcast(chosen) if number <= BROADCAST_ROWS else chosen, list(keys), "left_semi")
    # Untimed rows are the newest, and so lie in the last stretch.
    moment = F.coalesce(to_epoch_micros(changed_at), F.lit((1 << 63) - 1))
    accuracy = max(10_000, 4 * pieces)
    cuts = hot_rows.groupBy(*keys).agg(
        F.percentile_approx(moment, [i / pieces for i in range(1, pieces)], accuracy).alias("_cuts")
    )
    # Every step-th cut is tried first, then the cuts up to the next of those.
    step = math.isqrt(pieces) + 1
    cuts = cuts.withColumn("_coarse", F.filter("_cuts", lambda _, i: (i + 1) % step == 0))
    passed = F.size(F.filter("_coarse", lambda cut: cut < moment)) * step
    passed += F.size(F.filter(F.slice("_cuts", passed + 1, F.lit(step)), lambda cut: cut < moment))
    joined = lookup_join(rows, cuts, keys, max_rows=BROADCAST_ROWS // pieces)
    return joined.withColumn(
        "_stretch", F.when(F.col("_cuts").isNotNull(), passed).otherwise(0)
    ).drop("_cuts", "_coarse")


def _across(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: Column,
    neighbour: Callable[[Column | str], Column],
    edge: Callable[[Column, Column], Column],
    name: str,
) -> DataFrame:
    """Add the neighbouring row's ``value`` where keys may be cut into stretches.

    The window runs within a stretch. A row at its border takes the edge value of
    the next non-empty stretch, of which one aggregated row per stretch is kept.
    """
    cell = [*keys, "_stretch"]
    within = Window.partitionBy(*cell).orderBy(*order)
    edges = rows.groupBy(*cell).agg(edge(value, F.struct(*order)).alias("_own"))
    beyond = edges.select(*cell, neighbour("_own").over(Window.partitionBy(*keys).orderBy("_stretch")).alias("_beyond"))
    return (
        rows.withColumn("_inside", neighbour(value).over(within))
        .withColumn("_border", neighbour(F.lit(1)).over(within).isNull())
        .join(beyond, cell)
        .withColumn(name, F.when(F.col("_border"), F.col("_beyond")).otherwise(F.col("_inside")))
        .drop("_inside", "_border", "_beyond")
    )


def _order(changed_at: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(changed_at).isNull(), F.col(changed_at), *map(F.col, tiebreak)]


def _compared(
    df: DataFrame, keys: Sequence[str], changed_at: str, state: Sequence[str], tiebreak: Sequence[str], rows_per_task: int
) -> tuple[DataFrame, bool]:
    """Rows with a key and their previous row's state; whether keys were cut into stretches."""
    rows = df.dropna(subset=list(keys)).withColumn("_state", F.struct(*state))
    order = _order(changed_at, tiebreak)
    cut = _stretches(rows, keys, changed_at, rows_per_task)
    if cut is None:
        return rows.withColumn("_before", F.lag("_state").over(Window.partitionBy(*keys).orderBy(*order))), False
    return _across(cut, keys, order, F.col("_state"), F.lag, F.max_by, "_before"), True


def _opens() -> Column:
    return ~F.col("_before").eqNullSafe(F.col("_state"))


def _spells(changes: DataFrame, keys: Sequence[str], changed_at: str, tiebreak: Sequence[str], cut: bool) -> DataFrame:
    """Rows that open a spell, with its bounds."""
    order, following = _order(changed_at, tiebreak), F.struct(F.col(changed_at).alias("at"))
    if cut:
        spells = _across(changes, keys, order, following, F.lead, F.min_by, "_next").drop("_stretch")
    else:
        spells = changes.withColumn("_next", F.lead(following).over(Window.partitionBy(*keys).orderBy(*order)))
    return (
        spells.withColumn("valid_from", F.col(changed_at))
        .withColumn("valid_to", F.col("_next.at"))
        .withColumn("is_current", F.col("_next").isNull())
        .drop("_next")
    )


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    state: Sequence[str],
    tiebreak: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``valid_from``, ``valid_to`` and ``is_current`` to the rows that change the state.

    A row that repeats the previous state of its key opens no new spell. Rows
    without a key have no history; untimed rows come last, as the newest. A key has
    one current spell, the last one. Keys with more than ``rows_per_task`` rows are cut
    into stretches of time that are worked on apart; rows of one moment stay together.
    Rows per key are counted when this is called.
    """
    before, cut = _compared(df, keys, changed_at, state, tiebreak, rows_per_task)
    return _spells(before.where(_opens()).drop("_before", "_state"), keys, changed_at, tiebreak, cut)


def observed(
    df: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    state: Sequence[str],
    tiebreak: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Like ``scd2``, but all distinct versions stay, marked by ``opens``.

    A version that repeats the state before it opens no spell and has no bounds, but a
    late version may come to stand before it; it then opens one.
    """
    versions = df.select(*dict.fromkeys([*keys, changed_at, *state, *tiebreak])).distinct()
    before, cut = _compared(versions, keys, changed_at, state, tiebreak, rows_per_task)
    before, _ = pin(before, "history-compared")
    plain = before.drop("_before", "_state")
    spells = _spells(before.where(_opens()).drop("_before", "_state"), keys, changed_at, tiebreak, cut)
    repeats = before.where(~_opens()).select(*plain.drop("_stretch").columns)
    return spells.withColumn("opens", F.lit(True)).unionByName(repeats.withColumn("opens", F.lit(False)), allowMissingColumns=True).fillna(
        False, ["is_current"]
    )


def merge_history(
    stored: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    state: Sequence[str],
    tiebreak: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    max_keys: int = BROADCAST_ROWS,
) -> DataFrame:
    """Merge versions into a history kept by ``observed``, in whatever order they arrive.

    A late version splits the spell it falls into, or shortens it where what follows
    differs; a version seen before changes nothing. Only keys that have a change are
    worked out again, the rest pass through. Merging any batches of versions, in any order,
    gives the history of all of them. Changes without a key are left out.
    """
    own = list(dict.fromkeys([*keys, changed_at, *state, *tiebreak]))
    changes = changes.select(*own).dropna(subset=list(keys))
    changed_keys, count = pin(changes.select(*keys).distinct(), "changed-keys")
    small = count <= max_keys and stored_bytes(changed_keys) <= BROADCAST_BYTES
    changed_keys = F.broadcast(changed_keys) if small else changed_keys
    met = stored.join(changed_keys, list(keys), "left_semi").select(*own).unionByName(changes)
    again = observed(met, keys, changed_at, state, tiebreak, rows_per_task)
    return stored.join(changed_keys, list(keys), "left_anti").unionByName(again.select(*stored.columns))
