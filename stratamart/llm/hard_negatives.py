"""Hard negatives by angular triangle filtering.

Vectors become integers, floor(256 * x), and each row stores its angles to a few reference
directions. For an anchor at angle s and a row at angle t from the same direction, the
angle between them lies within |s - t| and min(s + t, 2 pi - s - t); every direction
narrows that interval. Its cosines times both norms, widened by more than all rounding,
bound the integer inner product. Only rows whose bounds overlap what is looked for get
integer scoring: for positives the k best of the anchor's label, for negatives the
windows of scores that the anchor's positives set.

Rows are sorted by label, nearest direction and angle to it, and cut into blocks. A block
is sent to a task once; packs of anchors stream past it. A block whose widest interval
misses an anchor's windows is passed over whole. The k best of each block are merged in
a window over the anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.llm.common import Columns, map_columns, small_batches
from stratamart.llm.topk_search import quantised
from stratamart.operators.lookups import pin

REFERENCES = 8  # directions
SAMPLE_ROWS = 2048  # rows the directions are chosen from; they change costs and not results
BLOCK_ROWS = 16_384
ANCHOR_ROWS = 256
SALTS = 64
CHUNK = 1024  # rows scored in one go
ANGLE_SLACK = 4e-6  # radians; stored angles are single precision, good to 3e-7
SCORE_SLACK = 2e-6  # of the product of norms

_PACK = (
    "part int, at long, labels array<long>, ids binary, marks binary, keys binary, "
    "vectors binary, width int, angles binary, asked binary"
)


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Rows of one width; shorter vectors count as ending in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def norms(values: np.ndarray) -> np.ndarray:
    return np.sqrt((values.astype(np.float64) ** 2).sum(axis=1))


def angles(values: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of each row to each direction, in radians; a zero vector counts as orthogonal."""
    width = max(values.shape[1], directions.shape[1])
    x = np.pad(values.astype(np.float64), ((0, 0), (0, width - values.shape[1])))
    d = np.pad(directions, ((0, 0), (0, width - directions.shape[1])))
    length = np.maximum(norms(values), 1e-300)[:, None]
    return np.arccos(np.clip(x @ d.T / length, -1, 1)).astype(np.float32)


def choose_directions(sample: list[list[int]]) -> np.ndarray:
    """Unit vectors far from each other: each is the sampled row farthest from those before it."""
    values = matrix(sample, max(map(len, sample), default=0)).astype(np.float64)
    values = values[norms(values) > 0]
    if not len(values):
        return np.zeros((1, 1))
    unit = np.unique(values / norms(values)[:, None], axis=0)
    chosen = [int(np.argmax(unit @ unit.mean(axis=0)))]
    nearest = unit @ unit[chosen[0]]
    while len(chosen) < min(REFERENCES, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def _directions(usable: DataFrame, rows: int) -> np.ndarray:
    share = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / max(rows, 1)) * (1 << 30))
    return choose_directions([r["v"] for r in usable.where(share).select("v").limit(SAMPLE_ROWS).collect()])


def _place_rows(directions: np.ndarray):
    """Each row with its nearest direction and the angle to it."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for b in batches:
            if not b["v"]:
                continue
            own = [np.array(v, np.int64) for v in b["v"]]
            a = angles(matrix(own, max(map(len, own))), directions)
            kept = {name: b[name] for name in ("vec_id", "label", "asked") if name in b}
            yield kept | {"v": [v.tobytes() for v in own], "near": a.argmin(axis=1), "angle": a.min(axis=1)}

    return run


def _packs(directions: np.ndarray, rows: int, by_label: bool):
    """Sorted rows in packs of at most ``rows``, with their angles to all directions."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        context = TaskContext.get()
        part, at = context.partitionId() if context else 0, 0
        held: list[tuple] = []

        def out() -> Columns:
            nonlocal at
            vectors = [np.frombuffer(r[2], np.int64) for r in held]
            width = max(map(len, vectors))
            m = matrix(vectors, width)
            top = max(int(m.max(initial=0)), -int(m.min(initial=0)))
            small = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
            row = {
                "part": [part], "at": [at], "labels": [sorted({r[1] for r in held})],
                "ids": [np.array([r[0] for r in held], np.int64).tobytes()],
                "marks": [np.array([r[1] for r in held], np.int64).tobytes()],
                "keys": [np.array([r[3] for r in held], np.int64).tobytes()],
                "vectors": [m.astype(small).tobytes()], "width": [width],
                "angles": [np.ascontiguousarray(angles(m, directions).T).tobytes()],
                "asked": [b"".join(r[4] or b"" for r in held)],
            }
            at += 1
            return row

        for b in batches:
            n = len(b["vec_id"])
            for r in zip(b["vec_id"], b["label"], b["v"], b.get("key", [0] * n), b.get("asked", [None] * n)):
                if held and (len(held) == rows or by_label and held[-1][1] != r[1]):
                    yield out()
                    held = []
                held.append(r)
        if held:
            yield out()

    return run


class Pack:
    """Rows of a block, or anchors, with norms and angles."""

    def __init__(self, ids: bytes, marks: bytes, keys: bytes, vectors: bytes, width: int, angles: bytes, asked: bytes) -> None:
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(marks, np.int64)
        self.keys = np.frombuffer(keys, np.int64)
        n = len(self.ids)
        kind = {2: np.int16, 4: np.int32}.get(len(vectors) // max(1, n * width), np.int64)
        self.values = np.frombuffer(vectors, kind).reshape(n, width).astype(np.int64)
        self.floats = self.values.astype(np.float64)
        self.norms = norms(self.values)
        self.highest = float(np.abs(self.values).max(initial=0))
        self.angles = np.frombuffer(angles, np.float32).reshape(-1, n)  # by direction
        self.least, self.most = self.angles.min(axis=1), self.angles.max(axis=1)
        self.asked = np.frombuffer(asked, np.int64).reshape(n, -1, 4) if asked else None
        self._with: dict[tuple[int, bool], np.ndarray] = {}

    def rows_of(self, label: int, same: bool) -> np.ndarray:
        """Places of the rows of a label, or of all others."""
        if (label, same) not in self._with:
            self._with[label, same] = np.flatnonzero((self.labels == label) == same)
        return self._with[label, same]

    def _score_bounds(self, norm: float, length: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        product = norm * length
        slack = product * SCORE_SLACK + 1
        near = np.cos(np.clip(low - ANGLE_SLACK, 0, np.pi)) * product + slack
        far = np.cos(np.clip(high + ANGLE_SLACK, 0, np.pi)) * product - slack
        return far, near

    def whole_bounds(self, norm: float, angle: np.ndarray) -> tuple[float, float]:
        """Bounds on the scores of all rows with an anchor."""
        low = max(0.0, float(np.maximum(angle - self.most, self.least - angle).max()))
        reach = np.minimum(angle + self.most, 2 * np.pi - angle - self.least)
        ends = np.array([self.norms.min(), self.norms.max()])
        far, near = self._score_bounds(norm, ends, np.full(2, low), np.full(2, min(np.pi, float(reach.min()))))
        return float(far.min()), float(near.max())

    def bounds(self, rows: np.ndarray, norm: float, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds on the score of each row with an anchor, by the triangle inequality of angles."""
        low, high = np.zeros(len(rows)), np.full(len(rows), np.pi)
        for own, a in zip(self.angles, angle.astype(np.float64)):
            t = own[rows].astype(np.float64)
            np.maximum(low, np.abs(t - a), out=low)
            t += a
            np.minimum(high, np.minimum(t, 2 * np.pi - t), out=high)
        return self._score_bounds(norm, self.norms[rows], low, high)

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Integer inner products; by floating point only where that is exact."""
        width = min(self.values.shape[1], len(query))
        query = query[:width]
        if float(np.abs(query).sum()) * self.highest < 2**52:
            return (self.floats[rows, :width] @ query.astype(np.float64)).astype(np.int64)
        return self.values[rows, :width] @ query

    def nearest(self, anchors: Pack, i: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) of the anchor's label, other than rows of its id."""
        rows = self.rows_of(int(anchors.labels[i]), True)
        rows = rows[self.ids[rows] != anchors.ids[i]]
        if len(rows) > k:
            _, near = self.bounds(rows, anchors.norms[i], anchors.angles[:, i])
            first = rows[np.argpartition(-near, k)[:k]]
            kth = self.scores(first, anchors.values[i]).min()  # k rows reach it
            rows = rows[near >= kth]
        found = self.scores(rows, anchors.values[i])
        order = np.lexsort((self.ids[rows], -found))[:k]
        return [(int(found[o]), int(self.ids[rows[o]])) for o in order]

    def in_windows(self, anchors: Pack, i: int, k: int) -> list[tuple[int, int, int]]:
        """For each of the anchor's windows the k best (window, score, id) of other labels."""
        windows = anchors.asked[i]
        open_ = np.flatnonzero(windows[:, 2] <= windows[:, 3])
        if not len(open_):
            return []
        lowest, highest = windows[open_, 2].min(), windows[open_, 3].max()
        norm, angle = anchors.norms[i], anchors.angles[:, i]
        far, near = self.whole_bounds(norm, angle)
        if near < lowest or far > highest:
            return []
        rows = self.rows_of(int(anchors.labels[i]), False)
        far, near = self.bounds(rows, norm, angle)
        # Best bounds first, so that what cannot be among the k best any more ends the search.
        overlap = np.flatnonzero((near >= lowest) & (far <= highest))
        overlap = overlap[np.argsort(-near[overlap], kind="stable")]
        kept = {int(w): np.zeros((0, 2), np.int64) for w in open_}
        for at in range(0, len(overlap), CHUNK):
            if all(len(best) == k and near[overlap[at]] < best[-1, 0] for best in kept.values()):
                break
            some = rows[overlap[at : at + CHUNK]]
            found = np.stack([self.scores(some, anchors.values[i]), self.ids[some]], 1)
            for w, best in kept.items():
                fits = found[(found[:, 0] >= windows[w, 2]) & (found[:, 0] <= windows[w, 3])]
                both = np.concatenate([best, fits])
                kept[w] = both[np.lexsort((both[:, 1], -both[:, 0]))[:k]]
        return [(w, int(s), int(v)) for w, best in kept.items() for s, v in best]


def _met(batches: Iterator[Columns]) -> Iterator[tuple[Pack, Pack]]:
    """Each pack of anchors with the block before it."""
    block = None
    for b in batches:
        names = ("ids", "marks", "keys", "vectors", "width", "angles", "asked")
        for kind, *fields in zip(b["kind"], *(b[n] for n in names)):
            if kind == 0:
                block = Pack(*fields)
            else:
                yield block, Pack(*fields)


def _find_positives(k: int):
    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for block, anchors in _met(batches):
            out: Columns = {"anchor_id": [], "key": [], "id": [], "score": []}
            for i in range(len(anchors.ids)):
                for score, found in block.nearest(anchors, i, k):
                    for name, value in zip(out, (int(anchors.ids[i]), int(anchors.keys[i]), found, score)):
                        out[name].append(value)
            yield out

    return run


def _find_negatives(k: int):
    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for block, anchors in _met(batches):
            out: Columns = {n: [] for n in ("anchor_id", "key", "place", "positive_id", "positive_score", "id", "score")}
            for i in range(len(anchors.ids)):
                for w, score, found in block.in_windows(anchors, i, k):
                    positive, reached = anchors.asked[i][w][:2].tolist()
                    values = (int(anchors.ids[i]), int(anchors.keys[i]), w, positive, reached, found, score)
                    for name, value in zip(out, values):
                        out[name].append(value)
            yield out

    return run


def _asked(places: int):
    """Windows as rows of positive, its score, lowest and highest score; absent ones are empty."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for b in batches:
            asked = []
            for found in b["found"]:
                windows = np.tile(np.array([0, 0, 1, 0], np.int64), (places, 1))
                for f in found:
                    windows[f["place"] - 1] = f["id"], f["score"], f["lowest"], f["highest"]
                asked.append(windows.tobytes())
            yield {"anchor_id": b["anchor_id"], "key": b["key"], "asked": asked}

    return run


def _sent(blocks: DataFrame, packs: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Run each block with the packs sent to it; blocks are dealt evenly and each is sent once."""
    tasks = max(1, blocks.select("part", "at").count())
    both = blocks.withColumn("kind", F.lit(0)).unionByName(packs.withColumn("kind", F.lit(1)))
    dealt = both.repartitionById(tasks, F.pmod(F.col("part") + F.col("at"), F.lit(tasks)).cast("int"))
    return map_columns(dealt.sortWithinPartitions("part", "at", "kind").drop("labels"), work, schema)


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``embedding`` and an integer ``label``; anchors are its rows
    where ``is_anchor`` holds. A row's score is its integer inner product with the anchor. An
    anchor's positives are the ``positives`` best rows of its label with another vec_id;
    negatives of a positive are the ``negatives`` best rows of other labels that score
    ``low`` to ``high`` percent of it. Ties go to the smaller vec_id. A positive of negative
    score has no negatives.

    Rows with a null vec_id, label or vector, or a null or non-finite component, take no
    part. Vectors of different lengths count as ending in zeros; an empty or zero vector
    scores zero. Repeated rows are candidates each; equal anchors count once, and anchors of
    one vec_id but other labels or vectors have lists of their own. An empty table gives
    no rows. Other columns are not read, but by ``is_anchor``.

    All anchors meet all blocks by contract. Each block goes to one task once, whatever its
    labels; packs of anchors are copied to it, for positives only to blocks that hold their
    label. ``positives`` or ``negatives`` rows an anchor, window and block are all that
    leaves a task.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    usable = (
        vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                quantised(F.col("embedding")).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
        .where("v IS NOT NULL")
    )
    n = usable.count()
    directions = _directions(usable, n)
    order = ["label", "near", "angle", "vec_id"]

    def packed(rows: DataFrame, count: int, size: int, by_label: bool) -> DataFrame:
        parts = max(1, -(-count // size))
        ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        return pin(map_columns(ordered, _packs(directions, size, by_label), _PACK), "negatives-packs")[0]

    base = "vec_id long, label long, v binary, near int, angle float"
    placed = map_columns(usable.select("vec_id", "label", "v"), _place_rows(directions), base)
    blocks = packed(placed, n, BLOCK_ROWS, False)
    own = map_columns(usable.where("anchor").select("vec_id", "label", "v"), _place_rows(directions), base)
    anchors, n_anchors = pin(own.distinct().withColumn("key", F.xxhash64("label", "v")), "negatives-anchors")

    targets, _ = pin(blocks.select("part", "at", "labels"), "negatives-targets")
    held = targets.select(F.col("part").alias("to"), F.col("at").alias("to_at"), F.explode("labels").alias("label"))
    alike = packed(anchors, n_anchors, ANCHOR_ROWS, True).withColumn("label", F.col("labels")[0]).join(held, "label")
    alike = alike.drop("label", "part", "at").withColumnsRenamed({"to": "part", "to_at": "at"})
    found = _sent(blocks, alike, _find_positives(positives), "anchor_id long, key long, id long, score long")
    reached = _best(found, ["anchor_id", "key"], positives)
    # low * p <= 100 * n <= high * p, in whole numbers
    windows = reached.withColumns(
        {"lowest": F.expr(f"(score * {low} + 99 - pmod(score * {low} + 99, 100L)) div 100"),
         "highest": F.expr(f"(score * {high} - pmod(score * {high}, 100L)) div 100")}
    ).withColumn("place", F.col("rank"))
    listed = windows.groupBy("anchor_id", "key").agg(F.collect_list(F.struct("place", "id", "score", "lowest", "highest")).alias("found"))
    asked = map_columns(listed, _asked(positives), "anchor_id long, key long, asked binary")
    asking, n_asking = pin(anchors.join(asked.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "key"]), "negatives-asking")

    # Every block, through a salt: packs are copied to the salts, and from there to their blocks.
    salted = targets.select(F.col("part").alias("to"), F.col("at").alias("to_at"), F.pmod(F.col("part") + F.col("at"), F.lit(SALTS)).alias("salt"))
    everywhere = packed(asking, n_asking, ANCHOR_ROWS, False).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    everywhere = everywhere.join(salted, "salt").drop("salt", "part", "at").withColumnsRenamed({"to": "part", "to_at": "at"})
    schema = "anchor_id long, key long, place int, positive_id long, positive_score long, id long, score long"
    hard = _best(_sent(blocks, everywhere, _find_negatives(negatives), schema), ["anchor_id", "key", "place"], negatives)
    return hard.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
