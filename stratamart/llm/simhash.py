"""SimHash near-dedup by a hierarchical index in Gray order.

Distinct fingerprints are sorted by Gray rank, in which neighbours share most bits, and
runs of neighbours are the leaves of an index. A node of the index is a masked bit
pattern: the mask holds the bits on which all fingerprints below agree, the pattern
their values. Patterns of leaves combine to those of upper nodes, ``FAN`` at a time, up
to one root.

The index is joined with itself from the root downward. Two nodes whose patterns differ
in more than ``DISTANCE`` bits of both masks hold no similar fingerprints, and neither
does anything below them, so the pair goes; a child's mask holds its parent's, so
differences add up on the way down. The frontier of node pairs is a table, and each
level is a join of it with the next level's nodes. Pairs of leaves that are left go down
the same way inside a task, over nodes of ``NODE_SIZES`` fingerprints, until single
fingerprints are compared.

A node has at most ``FAN`` children and a leaf at most ``LEAF`` fingerprints, so no task
grows with a group of copies: equal texts are one fingerprint, and near copies lie in
leaves of their own with wide masks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Columns, map_columns, small_batches
from stratamart.llm.components import connected_components
from stratamart.operators.lookups import pin

SHINGLE = 3  # words
SEED = 42
DISTANCE = 2  # bits
LEAF = 4096  # fingerprints
LEAVES_PER_TASK = 64
FAN_BITS = 4
FAN = 1 << FAN_BITS
NODE_SIZES = (512, 64, 8, 1)  # fingerprints of the nodes inside a leaf, each a multiple of the next
PIECE = 1 << 20  # characters of a text looked at in one go
PAIRS_AT_ONCE = 1 << 18

_U = np.uint64


def _pieces(text: str) -> Iterator[list[bytes]]:
    """Lower-cased words of a text, some at a time; only a word longer than a piece takes more."""
    rest = b""
    for at in range(0, len(text), PIECE):
        data = rest + text[at : at + PIECE].encode("utf-8", "replace").lower()
        found = data.split()
        whole = at + PIECE >= len(text) or data[-1:].isspace()
        rest = b"" if whole or not found else found.pop()
        yield found
    if rest:
        yield [rest]


def _shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each ``width`` words in a row, joined by one space."""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    h = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([h(joined[i:j], SEED) for i, j in spans], _U)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None) -> int:
    """The bits set in over half the shingle hashes, repeats included; without words zero."""
    counts, n = np.zeros(64, np.int64), 0
    before: list[bytes] = []
    for found in _pieces(text or ""):
        words = before + found
        if len(words) >= SHINGLE:
            hashes = _shingle_hashes(words, SHINGLE)
            counts += _bit_counts(hashes)
            n += len(hashes)
            before = words[1 - SHINGLE :]
        else:
            before = words
    if not n and before:  # fewer words: the whole sequence
        counts, n = _bit_counts(_shingle_hashes(before, len(before))), 1
    return int(np.packbits(2 * counts > n, bitorder="little").view(_U)[0]) if n else 0


def _fingerprints(batches: Iterator[Columns]) -> Iterator[Columns]:
    for b in batches:
        prints = np.array([fingerprint(t) for t in b["text"]], _U)
        yield {"doc_id": b["doc_id"], "f": prints.view(np.int64)}


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order (bit i: parity of the bits from i upward)."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> _U(shift)
    return rank


def _ranked(batches: Iterator[Columns]) -> Iterator[Columns]:
    for b in batches:
        f = np.array(b["f"], np.int64)
        # Signed order starts the Gray cycle in its middle, which keeps neighbours alike.
        yield {"f": f, "rank": gray_rank(f.view(_U)).view(np.int64)}


def _shared(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits on which the codes of each row agree, and their values."""
    every, some = np.bitwise_and.reduce(codes, axis=-1), np.bitwise_or.reduce(codes, axis=-1)
    return ~(every ^ some), every


def _leaf_rows(size: int):
    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        context = TaskContext.get()
        part, at = context.partitionId() if context else 0, 0
        held = np.zeros(0, np.int64)

        def out(codes: np.ndarray) -> Columns:
            nonlocal at
            mask, pattern = _shared(codes.view(_U))
            row = {"part": [part], "at": [at], "mask": [int(mask.view(np.int64))], "pattern": [int(pattern.view(np.int64))],
                   "codes": [codes.tobytes()]}
            at += 1
            return row

        for b in batches:
            held = np.concatenate([held, np.array(b["f"], np.int64)])
            while len(held) >= size:
                yield out(held[:size])
                held = held[size:]
        if len(held):
            yield out(held)

    return run


class _Tree:
    """Nodes inside a leaf: masks and patterns by level, from coarse to single fingerprints."""

    def __init__(self, codes: np.ndarray) -> None:
        full = -(-len(codes) // NODE_SIZES[0]) * NODE_SIZES[0]
        padded = np.r_[codes, np.full(full - len(codes), codes[-1], _U)]  # repeats of the last code
        self.codes = padded
        self.levels = [_shared(padded.reshape(-1, size)) for size in NODE_SIZES]


def _near(a: _Tree, b: _Tree, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    (mask_a, pattern_a), (mask_b, pattern_b) = a.levels[level], b.levels[level]
    return np.bitwise_count((pattern_a[i] ^ pattern_b[j]) & mask_a[i] & mask_b[j]) <= DISTANCE


def similar_pairs(a: _Tree, b: _Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of fingerprints of ``a`` and ``b`` that differ in at most ``DISTANCE`` bits."""
    n, m = len(a.levels[0][0]), len(b.levels[0][0])
    stack = [(0, *(x.ravel() for x in np.indices((n, m))))]
    while stack:
        level, i, j = stack.pop()
        near = _near(a, b, level, i, j)
        i, j = i[near], j[near]
        if not len(i):
            continue
        if level == len(NODE_SIZES) - 1:
            yield i, j
            continue
        fan = NODE_SIZES[level] // NODE_SIZES[level + 1]
        ci, cj = (x.ravel() for x in np.indices((fan, fan)))
        step = max(1, PAIRS_AT_ONCE // (fan * fan))
        for at in range(0, len(i), step):
            below_i = (i[at : at + step, None] * fan + ci).ravel()
            below_j = (j[at : at + step, None] * fan + cj).ravel()
            stack.append((level + 1, below_i, below_j))


def _settle(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked places the least root among them, until nothing changes."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (higher := root[root] != root).any():
            root[higher] = root[root][higher]


def link_leaves(a: np.ndarray, b: np.ndarray | None) -> np.ndarray:
    """Links that connect the similar fingerprints of two leaves (or of one with itself), as rows of two."""
    first = _Tree(a)
    second = first if b is None else _Tree(b)
    codes = first.codes if b is None else np.r_[first.codes, second.codes]
    codes, place = np.unique(codes, return_inverse=True)
    shift = 0 if b is None else len(first.codes)
    root = np.arange(len(codes))
    for i, j in similar_pairs(first, second):
        _settle(root, place[i], place[j + shift])
    linked = np.flatnonzero(root != np.arange(len(codes)))
    return np.stack([codes[linked], codes[root[linked]]], 1).view(np.int64)


def _leaf_links(batches: Iterator[Columns]) -> Iterator[Columns]:
    for b in batches:
        for x, y in zip(b["codes"], b["others"]):
            links = link_leaves(np.frombuffer(x, _U), None if y is None else np.frombuffer(y, _U))
            if len(links):
                yield {"a": links[:, 0], "b": links[:, 1]}


def _different_bits(a: str, b: str):
    shared = F.col(f"{a}_mask").bitwiseAND(F.col(f"{b}_mask"))
    return F.bit_count(F.col(f"{a}_pattern").bitwiseXOR(F.col(f"{b}_pattern")).bitwiseAND(shared)) <= DISTANCE


def _nodes_above(nodes: DataFrame) -> DataFrame:
    """Parents of nodes: bits in all their masks on which their patterns agree."""
    parent = F.shiftright("id", FAN_BITS).alias("id")
    found = nodes.groupBy(parent).agg(
        F.bit_and("mask").alias("masks"), F.bit_and("pattern").alias("pattern"), F.bit_or("pattern").alias("some")
    )
    return found.select("id", F.col("masks").bitwiseAND(F.bitwise_not(F.col("pattern").bitwiseXOR(F.col("some")))).alias("mask"), "pattern")


def _leaf_pairs(leaves: DataFrame, levels: int) -> DataFrame:
    """Pairs ``a <= b`` of leaves that may hold similar fingerprints, by descent from the root."""
    index = [leaves.select("id", "mask", "pattern")]
    for _ in range(levels):
        index.append(pin(_nodes_above(index[-1]), "simhash-nodes")[0])

    def named(nodes: DataFrame, name: str) -> DataFrame:
        return nodes.select(
            F.shiftright("id", FAN_BITS).alias(f"{name}_above"), F.col("id").alias(name),
            F.col("mask").alias(f"{name}_mask"), F.col("pattern").alias(f"{name}_pattern"),
        )

    top = named(index[-1], "a").drop("a_above")
    frontier = top.join(named(index[-1], "b"), F.col("a") == F.col("b")).drop("b_above")
    for nodes in reversed(index[:-1]):
        above = frontier.select(F.col("a").alias("a_above"), F.col("b").alias("b_above"), "b_mask", "b_pattern")
        one = above.join(named(nodes, "a"), "a_above").where(_different_bits("a", "b")).drop("b_mask", "b_pattern")
        both = one.join(named(nodes, "b"), "b_above").where(F.col("a") <= F.col("b")).where(_different_bits("a", "b"))
        frontier, _ = pin(both.select("a", "b", "a_mask", "a_pattern", "b_mask", "b_pattern"), "simhash-frontier")
    return frontier.select("a", "b")


def similar_fingerprints(prints: DataFrame) -> DataFrame:
    """``node, root`` for every fingerprint ``f`` (distinct rows) that links with another one."""
    spark = prints.sparkSession
    small_batches(spark)
    prints, n = pin(map_columns(prints, _ranked, "f long, rank long"), "simhash-prints")
    parts = max(1, -(-n // (LEAF * LEAVES_PER_TASK)))
    ordered = prints.repartitionByRange(parts, "rank").sortWithinPartitions("rank")
    stored, _ = pin(map_columns(ordered, _leaf_rows(LEAF), "part int, at long, mask long, pattern long, codes binary"), "simhash-leaves")
    most = stored.agg(F.max("at"), F.max("part")).first()
    # Leaves count on in Gray order: part, then place, each in whole steps of the fan.
    steps = -(-int(most[0] or 0).bit_length() // FAN_BITS)
    levels = steps + -(-int(most[1] or 0).bit_length() // FAN_BITS)
    number = F.shiftleft(F.col("part").cast("long"), FAN_BITS * steps).bitwiseOR(F.col("at"))
    leaves = stored.select(number.alias("id"), "mask", "pattern", "codes")
    pairs = _leaf_pairs(leaves, levels)
    # Each leaf meets itself and then its partners; its own fingerprints travel once per partner.
    met = (
        pairs.join(leaves.select(F.col("id").alias("a"), "codes"), "a")
        .join(leaves.select(F.col("id").alias("b"), F.col("codes").alias("others")), "b")
        .select("codes", F.when(F.col("a") != F.col("b"), F.col("others")).alias("others"))
    )
    return connected_components(map_columns(met, _leaf_links, "a long, b long"))


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    Texts are compared by their 3-word shingles, lower-cased in A-Z, repeats included;
    very long ones are read in pieces. A text of fewer words is one shingle. Null, empty
    and word-free texts have the fingerprint zero, which links like any other. A bit that
    exactly half the hashes set is 0. ``fingerprint`` is 16 lowercase hex digits.

    ``component_id`` is the smallest doc_id that links of at most ``DISTANCE`` different bits
    reach, the row's own included. A null doc_id takes part; a component of null ids
    alone has a null id. Rows that repeat a doc_id are rows of their own, so they may
    stand in two components. An empty table gives no rows. Columns other than ``doc_id``
    and ``text`` are not read.
    """
    small_batches(docs.sparkSession)
    members, _ = pin(map_columns(docs.select("doc_id", "text"), _fingerprints, "doc_id long, f long"), "simhash-members")
    least, _ = pin(members.groupBy("f").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = similar_fingerprints(least.select("f")).withColumnRenamed("node", "f")
    joined = least.join(linked, "f", "left").withColumn("root", F.coalesce("root", "f"))
    first = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named, _ = pin(joined.join(first, "root").select("f", "component_id"), "simhash-components")
    digits = F.lower(F.lpad(F.hex("f"), 16, "0"))
    return members.join(named, "f").select("doc_id", digits.alias("fingerprint"), "component_id")
