"""Best-fit packing of documents into bins of a fixed number of words.

Documents are dealt by hash to shards of bounded size, and each shard is packed on
its own: largest first, each into the open bin with the least room that still fits
and has no conflict. Bins are kept in order of their room. A bin carries two bitmaps,
of the sources that have used up their places in it and of the duplicate clusters in
it; the search goes from the tightest bin to its successors until one is compatible.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Columns, map_groups, word_count
from stratamart.operators.lookups import pin

CAPACITY = 2048
PER_SOURCE = 2
SHARD_ROWS = 20_000


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> list[int]:
    """Bin of each item, items in the order given. ``clusters`` below 0: no conflict."""
    order: list[tuple[int, int]] = []  # (room, bin)
    full: list[int] = []  # per bin, sources without a place left
    held: list[int] = []  # per bin, clusters
    count: list[dict] = []
    bins = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = 1 << source, (1 << cluster if cluster >= 0 else 0)
        at = bisect_left(order, (size, -1))
        while at < len(order) and (full[order[at][1]] & s or held[order[at][1]] & c):
            at += 1
        if at < len(order):
            room, b = order.pop(at)
        else:
            room, b = capacity, len(full)
            full.append(0)
            held.append(0)
            count.append({})
        count[b][source] = count[b].get(source, 0) + 1
        if count[b][source] >= per_source:
            full[b] |= s
        held[b] |= c
        if room > size:
            insort(order, (room - size, b))
        bins.append(b)
    return bins


def _dense(values: list) -> list[int]:
    """Numbers from 0 for the distinct values, null among them."""
    seen: dict = {}
    return [seen.setdefault(v, len(seen)) for v in values]


def _pack_shard(capacity: int, per_source: int):
    def run(c: Columns) -> Columns:
        number = lambda v: (v is not None, v or 0)
        rank = sorted(
            range(len(c["n_words"])),
            key=lambda i: (-c["n_words"][i], c["cluster"][i] or "", number(c["doc_id"][i]), c["piece"][i]),
        )
        take = lambda name: [c[name][i] for i in rank]
        out = {name: take(name) for name in ("doc_id", "piece", "start_word", "n_words")}
        clusters = take("cluster")
        shared = {v for v, n in Counter(clusters).items() if n > 1 and v is not None}
        ids = iter(_dense([v for v in clusters if v in shared]))
        numbers = [next(ids) if v in shared else -1 for v in clusters]
        bins = best_fit(out["n_words"], _dense(take("source")), numbers, capacity, per_source)
        filled: dict[int, int] = {}
        out["bin_offset"] = []
        for b, n in zip(bins, out["n_words"]):
            out["bin_offset"].append(filled.get(b, 0))
            filled[b] = filled.get(b, 0) + n
        out["bin_id"] = [c["_shard"][0] * (1 << 24) + b for b in bins]
        return out

    return run


_SCHEMA = "doc_id long, piece int, start_word long, n_words long, bin_id long, bin_offset long"


def pack(
    docs: DataFrame,
    text: str = "text",
    cluster: str | None = None,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start_word, n_words, bin_id, bin_offset``.

    No bin holds more than ``capacity`` words, two pieces of one cluster, or more than
    ``per_source`` pieces of one source. A document longer than ``capacity`` is cut
    into full bins and a rest; full pieces get a bin each (negative ``bin_id``).
    ``cluster`` names a column of duplicate clusters; by default documents with equal
    words form one. Documents without words (null, empty) are piece 0 with 0 words in
    bin null. Equal rows are packed one by one. An empty table gives no rows.
    """
    label = F.col(cluster).cast("string") if cluster else F.md5(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", " ")))
    sized, rows = pin(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), label.alias("cluster"), word_count(F.col(text)).alias("size")),
        "pack-sizes",
    )
    pieces = sized.select(
        "*",
        F.posexplode(
            F.when(F.col("size") == 0, F.array(F.lit(0).cast("long"))).otherwise(
                F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(capacity).cast("long"))
            )
        ).alias("piece", "start_word"),
    ).withColumn("n_words", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("start_word")))
    # Numbered by the scan, so that the pieces of equal rows get bins of their own too.
    whole = pieces.where("n_words = 0 OR n_words = %d" % capacity).select(
        "doc_id", "piece", "start_word", "n_words",
        F.when(F.col("n_words") > 0, -1 - F.monotonically_increasing_id()).alias("bin_id"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    shards = max(1, -(-rows // shard_rows))
    # The order of the scan salts the deal, so rows that repeat a doc_id spread too.
    dealt = pieces.where("n_words > 0 AND n_words < %d" % capacity).withColumn(
        "_shard", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(shards))
    )
    packed = map_groups(dealt.groupBy("_shard"), _pack_shard(capacity, per_source), _SCHEMA)
    return whole.unionByName(packed)
