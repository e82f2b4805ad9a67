"""Files clustered by several columns at once, so that a filter on any of them skips most files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BITS = 8  # of a column's rank


def ranks(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, Column]:
    """The quantile of each row in each column, 0 to ``2 ** bits - 1``; NULL comes first.

    Cuts are approximate quantiles, so ranks are used evenly however values are
    distributed. They are ``2 ** bits - 1`` values per column, the only ones the driver sees.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10 * len(shares)).alias(c) for c in columns]).first()
    out = {}
    for c in columns:
        below = _below(F.col(c).cast("double"), cuts[c] or [], 1 << (bits // 2))
        out[c] = F.when(F.col(c).isNull(), 0).otherwise(below).cast("long")
    return out


def _below(value: Column, cuts: list[float], step: int) -> Column:
    """How many cuts lie below the value: every ``step``-th is tried first, then those up to the next of these."""
    coarse, every = (F.array(*[F.lit(c) for c in some]).cast("array<double>") for some in (cuts[step - 1 :: step], cuts))
    passed = F.size(F.filter(coarse, lambda cut: cut < value)) * step
    return passed + F.size(F.filter(F.slice(every, passed + 1, F.lit(step)), lambda cut: cut < value))


def interleaved(values: Sequence[Column], bits: int = BITS) -> Column:
    """One number whose bits are taken from each value in turn, highest first."""
    picked = []
    for bit in range(bits - 1, -1, -1):
        for k, v in enumerate(values):
            place = bit * len(values) + len(values) - 1 - k
            picked.append(F.shiftleft(F.shiftright(v, bit).bitwiseAND(F.lit(1)), place))
    return reduce(lambda a, b: a.bitwiseOR(b), picked)


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """``df`` in ``files`` ranges of the interleaved ranks of some numeric or time columns, ready to be written.

    Rows that are near in all columns come together, so the least and greatest value that
    Parquet keeps of each column let a filter on any of them skip files. ``df`` is read for
    the quantiles and then twice by the range partitioning; pass a stored frame. The range
    ends with a hash of the row, so that a value many rows share is still split.
    """
    measured = df.withColumns({f"_m{i}": _number(df, c) for i, c in enumerate(columns)})
    names = [f"_m{i}" for i in range(len(columns))]
    curve = measured.withColumn("_curve", interleaved(list(ranks(measured, names).values())))
    spread = F.xxhash64(*columns)
    ordered = curve.withColumn("_spread", spread).repartitionByRange(files, "_curve", "_spread").sortWithinPartitions("_curve")
    return ordered.select(*df.columns)


def _number(df: DataFrame, column: str) -> Column:
    """A column as a number that keeps its order."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")
