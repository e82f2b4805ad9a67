"""Money as decimals: exact, and independent of the order rows are summed in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratamart.constants import MONEY, TOTAL, USD_RATE


def line_total(quantity: Column | str, unit_price: Column | str) -> Column:
    quantity = F.col(quantity) if isinstance(quantity, str) else quantity
    unit_price = F.col(unit_price) if isinstance(unit_price, str) else unit_price
    return (quantity * unit_price).cast(MONEY)


def usd_per_unit(rate: Column | str) -> Column:
    """Reciprocal of a 'units per USD' rate. A zero rate raises under ANSI mode."""
    return F.lit(1.0) / (F.col(rate) if isinstance(rate, str) else rate)


def to_usd(amount: Column, usd_rate: Column, exact: bool = True) -> Column:
    """``amount`` in USD, rounded half away from zero to cents.

    The exact form multiplies decimals. ``exact=False`` multiplies by the double
    rate and returns a double, for callers that need floating-point parity.
    """
    if exact:
        return F.round(amount * usd_rate.cast(USD_RATE), 2).cast(MONEY)
    return F.round(amount.cast("double") * usd_rate, 2)


def total(amount: Column | str) -> Column:
    """Sum rounded to cents."""
    return F.round(F.sum(amount), 2).cast(TOTAL)


def mean(amount: Column | str) -> Column:
    """Mean of the non-null amounts rounded to cents; NULL when there are none."""
    return ratio(F.sum(amount), F.count(amount))


def ratio(numerator: Column, count: Column) -> Column:
    """``numerator / count`` as money; NULL for an empty group instead of an error."""
    return F.round(numerator.cast(TOTAL) / F.nullif(count, F.lit(0)), 2).cast(MONEY)
