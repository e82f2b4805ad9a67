"""Byte-level words, their hashes, and small helpers the operators share.

A word is a run of bytes other than space and the control characters 9 to 13,
as in the pattern ``[^\\x20\\x09-\\x0D]+``. ``A`` to ``Z`` count as lower case.
"""

from __future__ import annotations

import binascii
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

Columns = dict[str, list]

WORD_CHARS = r"[^\x20\x09-\x0D]+"
_BLOCK = 1 << 18
BITMAP_WORDS = 1 << 18  # 64-bit words of a bitmap of wanted values, whatever the corpus

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_END_MARK = np.zeros(256, bool)
_END_MARK[[ord(c) for c in ".!?"]] = True

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit."""
    x = np.atleast_1d(np.asarray(x, np.uint64))  # arrays wrap around silently, scalars warn
    x = x ^ (x >> np.uint64(30))  # a new array; the rest is in place
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, as ``np.unique`` gives them; a sort alone takes less time."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]][: len(values)]]


_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)
_BYTE = mix(_FOLD + np.uint64(0x1234567))


class _Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, ()  # each worker grows its own

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _MULTIPLIER, np.uint64)], dtype=np.uint64)
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _INVERSE, np.uint64)], dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` that depend on the content alone."""
    up, down = _POWERS.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word."""
    space = np.r_[True, _SPACE[data], True]
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


def _blocks(data: np.ndarray):
    """Cut a text at white space into blocks of about 256 kilobytes."""
    start = 0
    while len(data) - start > _BLOCK:
        end = start + _BLOCK
        while end < len(data) and not (gap := _SPACE[data[end : end + _BLOCK]]).any():
            end += _BLOCK
        end = min(len(data), end + int(gap.argmax()) if end < len(data) else end)
        yield start, data[start:end]
        start = end
    yield start, data[start:]


def text_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text, and start, end and hash of each of its words."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    starts, ends, hashes = [], [], []
    for at, block in _blocks(data):
        s, e = word_bounds(block)
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(range_hashes(_BYTE[block], s, e))
    return data, np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; a shorter text is one shingle, one without words none."""
    if not text:
        return np.zeros(0, np.uint64)
    words = text_words(text)[3]
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    starts = np.arange(n)
    return distinct(range_hashes(words, starts, np.minimum(starts + k, len(words))))


def _slide(op: Callable, values: np.ndarray, window: int) -> np.ndarray:
    """``op`` (minimum or maximum) over each full window."""
    width = 1
    while width < window:
        step = min(width, window - width)
        values = op(values[:-step], values[step:])
        width += step
    return values


def least_in_window(hashes: np.ndarray, window: int) -> np.ndarray:
    """Which words have the least hash, or an equal one, of some ``window`` words in a row.

    Each window holds one at least, and windows of equal words have the same ones.
    """
    if len(hashes) < window:
        return np.zeros(len(hashes), bool)
    edge = np.zeros(window - 1, hashes.dtype)
    return _slide(np.maximum, np.r_[edge, _slide(np.minimum, hashes, window), edge], window) == hashes


def sentence_starts(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chosen: np.ndarray, longest: int
) -> np.ndarray:
    """Index of the first word of each sentence.

    A sentence ends with a word that ends in ``.``, ``!`` or ``?``, or at a line end. One
    of more than ``longest`` words is also cut after the words ``chosen``: where the cuts
    are does not depend on where the sentence began.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64)
    lines = np.r_[0, np.cumsum(data == 10)]
    closes = _END_MARK[data[ends[:-1] - 1]] | (lines[starts[1:]] > lines[ends[:-1]])
    sentence = np.r_[0, np.cumsum(closes)]
    long = (np.bincount(sentence) > longest)[sentence]
    return np.flatnonzero(np.r_[True, closes | (long[:-1] & chosen[:-1])])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _to_arrow(ddl: str) -> Callable[[Columns], dict]:
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    return lambda columns: {"arrays": [pa.array(columns[f.name], f.type) for f in schema], "schema": schema}


def map_columns(df: DataFrame, work: Callable[[Iterator[Columns]], Iterator[Columns]], ddl: str) -> DataFrame:
    """Map the batches of each partition, as lists by column, to new ones."""
    arrow = _to_arrow(ddl)

    def run(batches):
        read = ({name: column.to_pylist() for name, column in zip(b.schema.names, b.columns)} for b in batches)
        for out in work(read):
            yield pa.RecordBatch.from_arrays(**arrow(out))

    return df.mapInArrow(run, ddl)


def map_groups(groups: GroupedData, work: Callable[[Columns], Columns], ddl: str) -> DataFrame:
    """Map each group, of bounded size, as lists by column."""
    arrow = _to_arrow(ddl)
    return groups.applyInArrow(lambda t: pa.Table.from_arrays(**arrow(work(t.to_pydict()))), ddl)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hand rows with whole texts to Python in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def _hashed_bit(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(64 * BITMAP_WORDS))


def maybe_in(wanted: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that all values of a column pass and most others do not, by a bitmap of fixed size.

    The words of the bitmap are aggregates; at most ``BITMAP_WORDS`` rows reach the driver.
    Once it is full of bits the test passes everything, which is right but saves nothing.
    """
    bit = _hashed_bit(F.col(column))
    one = F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")
    words = wanted.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.bit_or(one).alias("bits"))
    bitmap = np.zeros(BITMAP_WORDS, np.int64)
    for word, bits in words.collect():
        bitmap[word] = bits

    def test(bits: pd.Series) -> pd.Series:
        b = bits.to_numpy(np.int64)
        return pd.Series(bitmap[b >> 6] >> (b & 63) & 1 == 1)

    return lambda c: F.pandas_udf(test, "boolean")(_hashed_bit(c))


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds


def crc_fold(value, folds: int) -> int:
    """``fold`` for one value, for tests."""
    return binascii.crc32(("" if value is None else str(value)).encode()) % folds


def spaced(text: Column) -> Column:
    """Every white space character of a text as a space; null as empty text.

    ``replace`` looks for bytes; ``translate`` would look up every character.
    """
    out = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words(text: Column) -> Column:
    """Words of a text as an array, with JVM functions only; null gives no words."""
    return F.filter(F.split(spaced(text), " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")
