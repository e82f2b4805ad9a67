"""Results depend on them, so they are stated as they must be."""

from __future__ import annotations

from datetime import date

# Layers, in build order, and the one that holds run records.
LAYERS = ("raw", "staging", "curated", "marts", "metadata")

# Business rule of the order staging step.
EXCLUDED_ORDER_STATUS = "CANCELLED"

# Currency every amount is converted to.
BASE_CURRENCY = "USD"

# Product rating buckets: lower bound (inclusive) and label, then the rest.
RATING_BUCKETS = ((4.5, "EXCELLENT"), (4.0, "GOOD"), (3.0, "AVERAGE"))
RATING_REST = "POOR"

# Default calendar.
CALENDAR_START = date(2022, 1, 1)
CALENDAR_END = date(2030, 12, 31)

# Characters after which a name part starts with a capital, besides whitespace.
NAME_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"

# Decimal types of money, of its sums, and of USD per unit of a currency.
MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"
PRICE = "decimal(12,2)"
USD_RATE = "decimal(18,12)"
