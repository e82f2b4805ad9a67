"""Exchange rates: feed payloads to rows, latest rate, rate in force on a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from stratamart.constants import BASE_CURRENCY
from stratamart.functions.text import drop_prefix
from stratamart.functions.timestamps import utc_date
from stratamart.operators.latest import latest_by_key
from stratamart.operators.lookups import BROADCAST_ROWS, lookup_join

_PAYLOAD = (
    "source string, base string, date string, timestamp bigint, "
    "quotes map<string,double>, rates map<string,double>"
)


def flatten_fx_payload(payloads: DataFrame, json_col: str, keep: tuple[str, ...] = (), on_empty: str = "fail") -> DataFrame:
    """One row ``(base, rate_date, currency, rate)`` per quote of each payload.

    Two payload shapes are read: ``quotes`` keyed by base plus currency, and
    ``rates`` keyed by currency. Base and date have fall-backs. A payload without
    any quote fails the job, or yields no row with ``on_empty='drop'``.
    """
    body = F.col("_body")
    base = F.coalesce(F.nullif(body["source"], F.lit("")), body["base"], F.lit(BASE_CURRENCY))
    day = F.coalesce(F.nullif(body["date"], F.lit("")).cast("date"), utc_date(body["timestamp"]))
    any_rates = (F.size(body["quotes"]) > 0) | (F.size(body["rates"]) > 0)
    # What the quotes of a payload share is read before the explode, which then copies that to each, not the
    # payload. The date of a payload without any quote is not looked at: it need not be one.
    shared = payloads.select(*keep, F.from_json(json_col, _PAYLOAD, {"mode": "FAILFAST"}).alias("_body")).select(
        *keep,
        base.alias("base"),
        F.when(any_rates, day).alias("rate_date"),
        (F.size(body["quotes"]) > 0).alias("_prefixed"),
        body["quotes"].alias("_quotes"),
        body["rates"].alias("_rates"),
    )
    published = F.when(F.size("_quotes") > 0, F.col("_quotes")).when(F.size("_rates") > 0, F.col("_rates"))
    if on_empty == "fail":
        published = published.otherwise(F.raise_error(F.lit("fx payload has no rates")))
    quotes = shared.select(*keep, "base", "rate_date", "_prefixed", F.explode(published).alias("_key", "rate"))
    currency = F.when(F.col("_prefixed"), drop_prefix(F.col("_key"), F.col("base"))).otherwise(F.col("_key"))
    return quotes.select(*keep, "base", "rate_date", currency.alias("currency"), "rate")


def latest_fx(rates: DataFrame) -> DataFrame:
    """``(target_currency, usd_per_unit)`` of each currency's newest rate date."""
    newest = latest_by_key(rates, ["target_currency"], ["rate_date"], ["usd_per_unit"])
    return newest.select("target_currency", "usd_per_unit")


def with_latest_fx(facts: DataFrame, rates: DataFrame, currency: str, max_rows: int = BROADCAST_ROWS, salt_by: Sequence[str] = ()) -> DataFrame:
    """Add ``usd_per_unit`` by currency; NULL where the currency has no rate."""
    lookup = latest_fx(rates).withColumnRenamed("target_currency", currency)
    return lookup_join(facts, lookup, [currency], max_rows=max_rows, salt_by=salt_by)


def with_fx_as_of(facts: DataFrame, rates: DataFrame, currency: str, day: str, salt_by: Sequence[str] = ()) -> DataFrame:
    """Add the ``usd_per_unit`` in force on the row's day: the last rate at or before it.

    The distinct (currency, day) pairs of the facts, reduced before they are
    shuffled, are lined up with the rates, and each takes the last rate seen. The
    window therefore holds at most one row per calendar day and rate date of a
    currency, never the facts themselves; these meet the result in a lookup join.
    """
    asked = facts.select(currency, day).distinct().select(
        F.col(currency), F.col(day), F.lit(None).cast("double").alias("usd_per_unit"), F.lit(True).alias("_asked")
    )
    known = latest_by_key(
        rates.where(F.col("rate_date").isNotNull()), ["target_currency", "rate_date"], ["usd_per_unit"]
    ).select(
        F.col("target_currency").alias(currency), F.col("rate_date").alias(day), "usd_per_unit",
        F.lit(False).alias("_asked"),
    )
    # A rate of the same day comes first: false sorts before true.
    timeline = Window.partitionBy(currency).orderBy(day, "_asked").rowsBetween(Window.unboundedPreceding, 0)
    in_force = F.last("usd_per_unit", ignorenulls=True).over(timeline)
    lookup = (
        known.unionByName(asked)
        .withColumn("usd_per_unit", in_force)
        .where("_asked")
        .drop("_asked")
    )
    return lookup_join(facts, lookup, [currency, day], salt_by=salt_by)
