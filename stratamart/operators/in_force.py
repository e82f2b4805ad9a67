"""Joins by time: the spell that holds a moment, and the last value at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.functions.timestamps import to_epoch_micros

DAY_MICROS = 86_400_000_000


def _micros(moment: str) -> Column:
    return to_epoch_micros(F.col(moment).cast("timestamp_ntz"))


def _slot(micros: Column, days: float) -> Column:
    """Number of the stretch of time that holds a moment."""
    return F.floor(micros / F.lit(int(days * DAY_MICROS))).cast("bigint")


def join_in_force(
    facts: DataFrame,
    spells: DataFrame,
    keys: Sequence[str],
    at: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    slot_days: float = 90,
) -> DataFrame:
    """Add ``columns`` of the spell of a fact's key with ``valid_from <= at < valid_to``.

    Spells are copied to the stretches of ``slot_days`` they reach into, within the time
    the facts span, and meet the facts by key and stretch. So a key that holds a large
    share of the facts is spread over its stretches, and as the join is by equality AQE
    can split one of them further. A spell without an end has not ended; one without a
    beginning holds no moment. Facts without a spell, a key or a moment keep NULLs. Spells
    of one key must not overlap. The time span of the facts is read when this is called.
    """
    span = facts.agg(F.min(at).alias("first"), F.max(at).alias("last")).select(_slot(_micros("first"), slot_days), _slot(_micros("last"), slot_days))
    first, last = span.first()
    start, end = _micros(valid_from), _micros(valid_to)
    reach = spells.select(*keys, *columns, start.alias("_from"), end.alias("_to")).where("_from IS NOT NULL AND (_to IS NULL OR _from < _to)")
    begin = F.greatest(_slot(F.col("_from"), slot_days), F.lit(first))
    stop = F.least(F.coalesce(_slot(F.col("_to") - 1, slot_days), F.lit(last)), F.lit(last))
    placed = reach.withColumn("_begin", begin).withColumn("_stop", stop).where("_begin <= _stop")
    copies = placed.withColumn("_slot", F.explode(F.sequence("_begin", "_stop"))).drop("_begin", "_stop")
    moments = facts.withColumn("_at", _micros(at)).withColumn("_slot", _slot(F.col("_at"), slot_days))
    f, s = moments.alias("f"), copies.alias("s")
    same = [F.col(f"f.{k}") == F.col(f"s.{k}") for k in (*keys, "_slot")]
    holds = (F.col("f._at") >= F.col("s._from")) & (F.col("s._to").isNull() | (F.col("f._at") < F.col("s._to")))
    joined = f.join(s, [*same, holds], "left")
    return joined.select(*[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"s.{c}") for c in columns])


def join_as_of(
    facts: DataFrame,
    values: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    columns: Sequence[str],
    tiebreak: Sequence[str] = (),
    slot_days: float = 1,
) -> DataFrame:
    """Add ``columns`` of the last row of ``values`` with the fact's key and ``since <= at``, to the microsecond.

    Time is cut into stretches of ``slot_days``. Within one, facts and values of a key are
    lined up in a window; the last value of each stretch is carried on to those after it,
    which takes a row per key and stretch. So the time line of one key is as many tasks
    as it has stretches. Of values of one moment the last by ``tiebreak`` counts. Facts
    without a key, a moment or a value before it keep NULLs.
    """
    order = F.struct(_micros(since).alias("at"), *[F.col(c) for c in tiebreak])
    known = values.where(F.col(since).isNotNull()).select(*keys, F.struct(*columns).alias("_value"), order.alias("_order"))
    known = known.withColumn("_slot", _slot(F.col("_order.at"), slot_days)).dropna(subset=list(keys))
    # Distinct names: facts may have columns like those of the values.
    row = F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact")
    asked = facts.select(*keys, row, _micros(at).alias("_at")).withColumn("_slot", _slot(F.col("_at"), slot_days))
    findable = F.col("_at").isNotNull()
    for k in keys:
        findable &= F.col(k).isNotNull()

    cell = [*keys, "_slot"]
    lines = known.select(*cell, "_value", F.col("_order.at").alias("_at"), F.lit(0).alias("_kind"), "_order").unionByName(
        asked.where(findable).select(*cell, "_fact", "_at", F.lit(1).alias("_kind")), allowMissingColumns=True
    )
    # A value of the fact's own moment comes before it.
    within = Window.partitionBy(*cell).orderBy("_at", "_kind", "_order").rowsBetween(Window.unboundedPreceding, 0)
    found = lines.withColumn("_own", F.last("_value", ignorenulls=True).over(within)).where("_kind = 1")

    ends = known.groupBy(*cell).agg(F.max_by("_value", "_order").alias("_last"))
    places = ends.unionByName(asked.where(findable).select(*cell).distinct(), allowMissingColumns=True).groupBy(*cell).agg(
        F.first("_last", ignorenulls=True).alias("_last")
    )
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).select(*cell, "_carried")
    met = found.join(carried, cell).withColumn("_value", F.coalesce("_own", "_carried")).select("_fact", "_value")
    lost = asked.where(~findable).select("_fact", F.lit(None).cast(known.schema["_value"].dataType).alias("_value"))
    both = met.unionByName(lost)
    return both.select("_fact.*", *[F.col(f"_value.{c}").alias(c) for c in columns])
