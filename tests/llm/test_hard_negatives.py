"""Hard-negative mining against scoring every pair, and its score bounds."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from stratamart.llm import hard_negatives as hn

COLUMNS = "vec_id long, embedding array<float>, label int, part int, at int, id long, key string, score string, rank int"


def plain(rows, positives=5, negatives=10):
    usable = [(i, [math.floor(256 * x) for x in e], y) for i, e, y in rows
              if i is not None and y is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for anchor in {(i, tuple(e), y) for i, e, y in usable if i % 3 == 0}:
        scored = [(-sum(a * b for a, b in zip(anchor[1], e)), i, y) for i, e, y in usable]
        for p, pid, _ in sorted(s for s in scored if s[2] == anchor[2] and s[1] != anchor[0])[:positives]:
            fits = sorted(s for s in scored if s[2] != anchor[2] and 30 * -p <= 100 * -s[0] <= 90 * -p)[:negatives]
            out += [(anchor[0], pid, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(fits)]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, "k", "s", 4) for r in rows], COLUMNS)
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % 3 == 0).collect())


def made(seed=1, n=150, width=6):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.5) for c in rng.choice(centres)], i % 4) for i in range(n)]
    twin = rows[3][1]
    rows += [(300 + i, twin, i % 3) for i in range(12)]  # ties
    rows += [rows[5], rows[6], (9, rows[7][1], 2)]  # repeated rows, an anchor's id with another label
    rows += [(None, twin, 1), (400, None, 1), (401, [1.0, None], 1), (402, [float("nan")], 1), (403, [float("inf")], 0)]
    return [*rows, (404, twin, None), (405, [], 1), (408, [0.0] * 6, 2), (411, [1.0], 3), (414, [0.5] * 9, 3)]


def test_equal_to_scoring_all_pairs(spark):
    rows = made()
    got = found(spark, rows)
    assert got == plain(rows) and got


def test_many_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 7)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(hn, "CHUNK", 4)
    rows = made(2)
    assert found(spark, rows) == plain(rows)


def test_few_rows_and_an_empty_table(spark):
    assert found(spark, []) == []
    rows = [(0, [1.0, 0.0], 1), (3, [0.9, 0.1], 1), (4, [0.5, 0.2], 2)]
    assert found(spark, rows) == plain(rows) == [(0, 3, 1, 4, 58880, 32768), (3, 0, 1, 4, 58880, 30715)]


@pytest.mark.parametrize("scale", [1, 40, 1 << 20])
def test_bounds_hold_every_score(scale):
    rng = np.random.default_rng(scale)
    values = np.concatenate([rng.normal(0, 90, (300, 16)), rng.normal(60, 5, (100, 16)), np.zeros((1, 16))])
    values = np.floor(values * scale).astype(np.int64)
    values = np.concatenate([values, values[:5], -values[:5], 2 * values[:5]])  # angles of 0 and pi
    directions = hn.choose_directions(values[:40].tolist())
    angles = np.ascontiguousarray(hn.angles(values, directions).T).tobytes()
    ids = np.arange(len(values)).tobytes()
    block = hn.Pack(ids, ids, ids, values.tobytes(), 16, angles, b"")
    every = np.arange(len(values))
    for i in range(0, len(values), 7):
        exact = values @ values[i]
        far, near = block.bounds(every, block.norms[i], block.angles[:, i])
        assert (far <= exact).all() and (exact <= near).all()
        far, near = block.whole_bounds(block.norms[i], block.angles[:, i])
        assert far <= exact.min() and exact.max() <= near
        assert (block.scores(every, values[i]) == exact).all()
