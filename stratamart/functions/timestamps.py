"""Zone-free UTC timestamps and dates, whatever the session time zone is."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

_DAY_SECONDS = 86400


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def from_epoch_micros(micros: Column | str) -> Column:
    """Microseconds since the epoch as naive UTC."""
    return F.timestamp_add("MICROSECOND", F.col(micros) if isinstance(micros, str) else micros, _epoch())


def to_epoch_micros(moment: Column | str) -> Column:
    """Naive UTC as microseconds since the epoch."""
    return F.timestamp_diff("MICROSECOND", _epoch(), F.col(moment) if isinstance(moment, str) else moment)


def utc_naive(moment: Column | str) -> Column:
    """A zoned timestamp as naive UTC, to the microsecond."""
    return from_epoch_micros(F.unix_micros(moment))


def utc_date(epoch_seconds: Column | str) -> Column:
    """UTC calendar day of a unix time."""
    column = F.col(epoch_seconds) if isinstance(epoch_seconds, str) else epoch_seconds
    return F.date_from_unix_date(F.floor(column / _DAY_SECONDS).cast("int"))


def run_timestamp(run_ts: datetime | str | None) -> Column:
    """One load or build time for a whole run; now when none is given."""
    return utc_naive(F.current_timestamp()) if run_ts is None else F.lit(str(run_ts)).cast("timestamp_ntz")
