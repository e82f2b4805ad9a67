"""Mixing sources to target weights by the cube method (balanced sampling).

A source's target is a multiple of its size: every document is taken the whole part
of that multiple times, and once more with the fraction as its probability. The cube
method decides those fractions. It moves three undecided probabilities at a time
along the null space of the constraints "documents" and "tokens", so both totals
stay exact, until one of the three is 0 or 1. A pass over any number of rows leaves
at most two undecided rows per source; those of all tasks meet in a second pass, and
what is left then, two rows per source, is landed by rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from stratamart.llm.common import Columns, map_columns, word_count
from stratamart.operators.lookups import pin

WEIGHTS = (1, 2, 3)
CAP = 3.0
ROWS_PER_TASK = 250_000
_EDGE = 1e-9


def source_targets(sizes: DataFrame, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, take the weights in turn. All targets
    add up to all sizes; a target stops at ``cap`` sizes and the excess goes to the
    others by weight. In closed form: with sources ordered by size per weight, the
    first ones stop at their cap and the rest share what is left by weight.
    Works on the table of sources, never on documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_weight", F.get(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights)))
    ranked = ranked.withColumn("_room", F.lit(cap) * F.col("source_size"))
    by_room = Window.orderBy(F.col("_room") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, after = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_room").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    ranked = ranked.withColumn("_level", level).withColumn("_open", F.col("_room") > F.col("_weight") * F.col("_level"))
    # The first source that does not reach its cap fixes the level for all after it.
    fixed = F.min(F.when(F.col("_open"), F.struct(F.col("_room") / F.col("_weight"), F.col("source").isNull(), F.col("source"), F.col("_level").alias("level")))).over(everything)
    ranked = ranked.withColumn("_level", fixed["level"])
    return ranked.select(
        "source", "source_size",
        F.when(F.col("_level").isNull(), F.col("_room")).otherwise(F.least("_room", F.col("_weight") * F.col("_level"))).alias("target"),
    )


class Flight:
    """The flight phase for one source: holds at most two undecided rows."""

    def __init__(self) -> None:
        self.waiting: list[list] = []

    def add(self, row: list) -> list[list]:
        """Take in ``[size, probability, luck, ...]``; return the rows now decided."""
        waiting = self.waiting
        waiting.append(row)
        if len(waiting) < 3:
            return []
        (za, pa), (zb, pb), (zc, pc) = (r[:2] for r in waiting)
        u = (zb - zc, zc - za, za - zb)
        if u == (0, 0, 0):  # equal sizes: moving any two keeps both totals
            u = (1, -1, 0)
        up = down = float("inf")
        for p, d in zip((pa, pb, pc), u):
            if d > 0:
                up, down = min(up, (1 - p) / d), min(down, p / d)
            elif d < 0:
                up, down = min(up, p / -d), min(down, (1 - p) / -d)
        step = up if row[2] * (up + down) < down else -down
        done = []
        for r, d in zip(list(waiting), u):
            r[1] = min(1.0, max(0.0, r[1] + step * d))
            if r[1] < _EDGE or r[1] > 1 - _EDGE:
                r[1] = float(r[1] > 0.5)
                done.append(r)
                waiting.remove(r)
        return done

    def land(self) -> list[list]:
        """Round what is left, keeping the token total as near as it gets."""
        due = sum(z * p for z, p, *_ in self.waiting)
        best = min(
            range(1 << len(self.waiting)),
            key=lambda bits: (abs(due - sum(r[0] for k, r in enumerate(self.waiting) if bits >> k & 1)), bits),
        )
        for k, r in enumerate(self.waiting):
            r[1] = float(best >> k & 1)
        return self.waiting


_SCHEMA = "doc_id long, source string, size long, luck double, probability double, key long"


def _flight(last: bool):
    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        flights: dict = {}

        def columns(rows: list[list]) -> Columns:
            names = ("size", "probability", "luck", "doc_id", "source", "key")
            return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

        for b in batches:
            done: list[list] = []
            for row in map(list, zip(b["size"], b["probability"], b["luck"], b["doc_id"], b["source"], b["key"])):
                if _EDGE <= row[1] <= 1 - _EDGE:
                    done += flights.setdefault(row[4], Flight()).add(row)
                else:
                    row[1] = float(row[1] > 0.5)
                    done.append(row)
            yield columns(done)
        for flight in flights.values():
            yield columns(flight.land() if last else flight.waiting)

    return run


def _passed(df: DataFrame, parts: int, last: bool, *by: str) -> DataFrame:
    # Large documents come first, so that those left undecided at the end are small.
    dealt = df.repartition(parts, *by).sortWithinPartitions(F.desc("size"), "luck", "doc_id", "source", "key")
    return map_columns(dealt, _flight(last), _SCHEMA)


def balanced_sample(df: DataFrame, rows: int, seed: int = 0, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Decide ``probability`` of each row (``doc_id, source, size, probability, key``) to 0 or 1,
    balanced per source on documents and tokens.

    Rows are dealt by id and text and streamed, so rows without an id are spread, and a hot
    source or a row repeated any number of times costs no memory. The deal depends on the number of rows, not
    on the cluster or the files, so reruns agree.
    """
    luck = (F.shiftrightunsigned(F.xxhash64("doc_id", "size", F.lit(seed)), 11) / F.lit(float(1 << 53))).alias("luck")
    df = df.select("doc_id", "source", "size", luck, "probability", "key")
    first, _ = pin(_passed(df, max(1, -(-rows // rows_per_task)), False, "doc_id", "key"), "mix-first")
    open_rows = F.col("probability").between(_EDGE, 1 - _EDGE)
    return first.where(~open_rows).unionByName(_passed(first.where(open_rows), 8, True, "source"))


def mix_sources(
    docs: DataFrame, text: str = "text", cap: float = CAP, weights: tuple[int, ...] = WEIGHTS, seed: int = 0,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken, text_key``.

    ``taken`` is ``copies`` times ``size``; ``text_key`` (``xxhash64`` of the text) tells
    rows of one doc_id apart. Null and empty texts have size 0 and take
    part without moving tokens; a source without words has target 0 and no copies.
    A null source is a source of its own, a null doc_id is kept. Equal rows are
    decided one by one. An empty table gives no rows. Other columns are not read.
    """
    sized, rows = pin(docs.select("doc_id", "source", word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("key")), "mix-sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets, _ = pin(source_targets(per_source, cap, weights), "mix-targets")
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(ratio + _EDGE)
    with_ratio = sized.join(t, F.col("source").eqNullSafe(F.col("_source")), "left")
    chance = F.greatest(F.lit(0.0), ratio - base)
    decided = balanced_sample(with_ratio.select("doc_id", "source", "size", chance.alias("probability"), "key"), rows, seed)
    copies = (base + F.col("probability")).cast("long")
    return decided.join(t, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
        F.col("key").alias("text_key"),
    )
