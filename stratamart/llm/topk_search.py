"""Exact top-k search by integer inner product over a bit-sliced index.

Vectors become integers, floor(256 * x). A block of rows is indexed by slices of
each component: bitmaps over the rows, one for each of the highest bits of the
component above its least value in the block. A query is rounded to few bits as well,
and its approximate score of every row of the block is added up in bitmap arithmetic
(a bit-sliced sum, with complemented slices for negative query components). The k
best approximate scores are found from the most significant slice of that sum
downward. Rounding errors are bounded for the block, so every row that could still be
among the k best lies at or above a bound on the sum; those rows are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.llm.common import Columns, map_columns
from stratamart.operators.lookups import pin

SCALE = 256
BITS = 7  # of a component in the index
QUERY_BITS = 5  # of a query component, without its sign
BLOCK_ROWS = 16_384
QUERY_ROWS = 1024


def quantised(vector: Column) -> Column:
    """Integer components, or null if the vector or a component is null or not finite."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))

    whole = F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & ~F.exists(vector, bad), whole)


def _matrix(rows: list[list[int]], width: int | None = None) -> np.ndarray:
    """Rows of one width; shorter vectors count as ending in zeros."""
    width = max([width or 0, *map(len, rows)]) if rows else (width or 0)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


class SlicedIndex:
    """Bit slices of a block of integer vectors, with what exact answers need."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        self.ids, self.values = ids, values
        n, width = values.shape
        self.low = values.min(axis=0) if n else np.zeros(width, np.int64)
        span = int((values.max(axis=0) - self.low).max()) if n and width else 0
        self.shift = max(0, span.bit_length() - BITS)
        coarse = (values - self.low) >> self.shift
        rough = self.low + (coarse << self.shift) + ((1 << self.shift) >> 1)
        self.error = float(np.sqrt(((values - rough).astype(np.float64) ** 2).sum(axis=1).max())) if n else 0.0
        self.norm = float(np.sqrt((values.astype(np.float64) ** 2).sum(axis=1).max())) if n else 0.0
        self.highest = float(np.abs(values).max(initial=0))
        self.floats = values.astype(np.float64)
        self.words = -(-n // 64)
        # slices[component][bit]: one bitmap over the rows of the block
        self.slices = np.stack([self._bitmaps(coarse >> b & 1) for b in range(BITS)], axis=1)
        self.everyone = self._bitmaps(np.ones((n, 1), np.int64))[0]

    def _bitmaps(self, bits: np.ndarray) -> np.ndarray:
        padded = np.zeros((bits.shape[1], self.words * 64), np.uint8)
        padded[:, : len(bits)] = bits.T
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def _sum(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, lowest first, of the sum over components of |q| times the (complemented) component."""
        total: list[np.ndarray] = []
        for q, own in zip(query.tolist(), self.slices):
            if q < 0:
                own = own ^ self.everyone  # highest value minus the value
            q = abs(q)
            place = 0
            while q:
                if q & 1:
                    carry = None
                    at = place
                    for s in own:
                        while len(total) <= at:
                            total.append(np.zeros(self.words, np.uint64))
                        t = total[at]
                        if carry is None:
                            total[at], carry = t ^ s, t & s
                        else:
                            x = t ^ s
                            total[at], carry = x ^ carry, (t & s) | (x & carry)
                        at += 1
                    while carry.any():
                        if len(total) <= at:
                            total.append(np.zeros(self.words, np.uint64))
                        total[at], carry = total[at] ^ carry, total[at] & carry
                        at += 1
                q >>= 1
                place += 1
        return total

    @staticmethod
    def _kth(total: list[np.ndarray], among: np.ndarray, k: int) -> int:
        """The k-th highest sum among the given rows, from the most significant slice downward."""
        sure, tied, value = 0, among, 0
        for bit in range(len(total) - 1, -1, -1):
            ones = tied & total[bit]
            count = int(np.bitwise_count(ones).sum())
            if sure + count >= k:
                tied, value = ones, value | 1 << bit
            else:
                sure += count
                tied = tied & ~total[bit]
        return value

    @staticmethod
    def _at_least(total: list[np.ndarray], among: np.ndarray, bound: int) -> np.ndarray:
        """Rows whose sum is at least ``bound``."""
        if bound <= 0:
            return among
        if bound >> len(total):
            return np.zeros_like(among)
        above, equal = np.zeros_like(among), among
        for bit in range(len(total) - 1, -1, -1):
            if bound >> bit & 1:
                equal = equal & total[bit]
            else:
                above |= equal & total[bit]
                equal = equal & ~total[bit]
        return above | equal

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) of rows with another id, ties to the smaller id."""
        among = self.everyone
        own = self.ids == query_id
        if own.any():
            among = among & ~self._bitmaps(own[:, None].astype(np.int64))[0]
        rows = int(np.bitwise_count(among).sum())
        if not rows:
            return []
        if rows > k:
            top = int(np.abs(query).max(initial=0))
            step = max(0, top.bit_length() - QUERY_BITS)
            coarse = np.sign(query) * ((np.abs(query) + ((1 << step) >> 1)) >> step)
            total = self._sum(coarse)
            taken = (coarse << step).astype(np.float64)
            off = np.sqrt((taken**2).sum()) * self.error + np.sqrt(((query - taken) ** 2).sum()) * self.norm
            slack = int(2 * off * (1 + 1e-9) / 2.0 ** (self.shift + step)) + 2
            among = self._at_least(total, among, self._kth(total, among, k) - slack)
        left = np.flatnonzero(np.unpackbits(among.view(np.uint8), bitorder="little"))
        scores = self.exact(left, query)
        order = np.lexsort((self.ids[left], -scores))[:k]
        return [(int(scores[i]), int(self.ids[left[i]])) for i in order]

    def exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Integer inner products; by floating point only where that is exact."""
        if float(np.abs(query).sum()) * self.highest < 2**52:
            return (self.floats[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.values[rows] @ query


def _blocks(rows: int):
    """Cut a partition into blocks of at most ``rows`` rows, as one row each."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        ids: list = []
        vectors: list = []

        def out() -> Columns:
            m = _matrix(vectors)
            return {"ids": [np.array(ids, np.int64).tobytes()], "vectors": [m.tobytes()], "width": [m.shape[1]]}

        for b in batches:
            for i, v in zip(b["vec_id"], b["v"]):
                ids.append(i)
                vectors.append(v)
                if len(ids) == rows:
                    yield out()
                    ids, vectors = [], []
        if ids:
            yield out()

    return run


def _unpack(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors, np.int64).reshape(len(i), width)


def _search(k: int):
    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        index, of = None, None
        for b in batches:
            for row in zip(b["ids"], b["vectors"], b["width"], b["q_ids"], b["q_vectors"], b["q_width"]):
                ids, values = _unpack(*row[:3])
                q_ids, queries = _unpack(*row[3:])
                width = max(values.shape[1], queries.shape[1])
                if of != (row[0], row[1], width):  # blocks come several times in a row, with other queries
                    index = SlicedIndex(ids, np.pad(values, ((0, 0), (0, width - values.shape[1]))))
                    of = (row[0], row[1], width)
                queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
                out: Columns = {"query_id": [], "vec_id": [], "score": []}
                for q_id, q in zip(q_ids.tolist(), queries):
                    for score, vec_id in index.search(q_id, q, k):
                        out["query_id"].append(q_id)
                        out["vec_id"].append(vec_id)
                        out["score"].append(score)
                yield out

    return run


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """The ``k`` best rows for each query row: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``embedding``; queries are its rows where
    ``is_query`` holds. A query's own row, and any other row with its vec_id, is no
    candidate for it. Vectors (and ids) that are null, or hold null or non-finite
    components, take no part. Vectors of different lengths count as ending in zeros.
    Equal rows are candidates each; a repeated query id has one list, the best of its
    rows. Ties go to the smaller vec_id. An empty table gives no rows.

    Blocks of queries meet blocks of rows through a key: rows' blocks are dealt to as
    many keys as there are shuffle partitions, and queries are copied to each key. No
    block grows with the table, and k rows per query and block are all that leaves it.
    """
    spark = vectors.sparkSession
    usable = vectors.where(F.col("vec_id").isNotNull()).select("vec_id", quantised(F.col("embedding")).alias("v")).where("v IS NOT NULL")
    schema = "ids binary, vectors binary, width int"
    # Even blocks, whatever the files: many small blocks would repeat the work of a query.
    even = usable.repartition(max(1, -(-usable.count() // block_rows)))
    blocks, _ = pin(map_columns(even, _blocks(block_rows), schema), "topk-blocks")
    keys = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = blocks.withColumn("_key", F.pmod(F.xxhash64("ids"), F.lit(keys)))
    asked = map_columns(usable.where(is_query), _blocks(query_rows), schema).select(
        F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("width").alias("q_width"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(keys - 1).cast("long"))).alias("_key"),
    )
    pairs = dealt.join(asked, "_key").drop("_key")
    found = map_columns(pairs, _search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
