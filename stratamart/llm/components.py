"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Columns, map_columns
from stratamart.operators.lookups import pin

FOREST_NODES = 500_000


class Forest:
    """Links added so far as links to the least node of each component."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def __len__(self) -> int:
        return len(self.parent)

    def _find(self, x: int) -> int:
        parent = self.parent
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = parent[x]
        return x

    def add(self, ones: Iterable[int], others: Iterable[int]) -> None:
        for a, b in zip(ones, others):
            a, b = self._find(a), self._find(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def links(self) -> Columns:
        pairs = [(x, r) for x in list(self.parent) if (r := self._find(x)) != x]
        return {"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}


def spanning(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Replace a partition's edges by edges to the least node of each of its components.

    Starts anew when many nodes have been seen, so memory is bounded.
    """
    forest = Forest()
    for batch in batches:
        forest.add(batch["a"], batch["b"])
        if len(forest) >= FOREST_NODES:
            yield forest.links()
            forest = Forest()
    yield forest.links()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge; the root is the least node of its component.

    ``edges`` has columns ``a`` and ``b``. Each round joins every node's larger
    neighbours, then its smaller ones, to its least neighbour. Least neighbours are
    aggregates and the joins are on nodes, so AQE can split a node with many edges.
    Rounds grow with the logarithm of the longest path; each is written to the shared
    folder, and the last leaves the edges as the one before.
    """
    local = map_columns(edges.where("a != b").select("a", "b"), spanning, "a long, b long")
    current, rows = pin(local.distinct(), "components")
    mark = None
    while rows:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = small.unionByName(least.withColumnRenamed("m", "b"))
        current, rows = pin(stars.distinct(), "components")
        now = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())
        if now == mark:
            break
        mark = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
