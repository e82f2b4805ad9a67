"""Keys of dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(natural_key: Column | str) -> Column:
    """64-bit hash of a natural key.

    The key is cast to bigint first: the same number hashes differently as int,
    bigint and decimal. On one 8-byte value xxhash64 is a bijection, so two
    different ids never share a key however many rows there are. NULL gets a
    constant non-null key.
    """
    column = F.col(natural_key) if isinstance(natural_key, str) else natural_key
    return F.xxhash64(column.cast("bigint"))


def date_key(day: Column | str) -> Column:
    """The day as the integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
