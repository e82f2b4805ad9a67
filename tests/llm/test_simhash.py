"""SimHash near-dedup against comparing every pair."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from stratamart.llm import simhash  # noqa: E402
from stratamart.llm.queries import QUERIES  # noqa: E402

COLUMNS = "doc_id long, text string, fingerprint int, f int, least int, root string, component_id int, rank int"


def plain_fingerprint(text):
    words = brute.words((text or "").translate(brute.LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain(docs):
    """[(doc_id, text)] -> sorted [(doc_id, fingerprint, component_id)], comparing every pair of fingerprints."""
    prints = [plain_fingerprint(t) for _, t in docs]
    codes = np.array(sorted(set(prints)), np.uint64)
    root = {int(c): int(c) for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, c in enumerate(codes):
        for other in codes[:i][np.bitwise_count(codes[:i] ^ c) <= 2]:
            root[find(int(c))] = find(int(other))
    least = {}
    for (doc, _), p in zip(docs, prints):
        if doc is not None:
            least[find(p)] = min(least.get(find(p), doc), doc)
    return sorted(((d, f"{p:016x}", least.get(find(p))) for (d, _), p in zip(docs, prints)), key=str)


def found(spark, docs):
    df = spark.createDataFrame([(*d, 1, 2, 3, "r", 4, 5) for d in docs], COLUMNS)
    return sorted((tuple(r) for r in simhash.near_copies(df).collect()), key=str)


def made(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(50)]
    docs = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 4, 40, 300)))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append((len(docs) * 7 % 1009, rng.choice((" ", "\t", " \x0b")).join(copy)))
    docs += [(3000, None), (3001, ""), (2999, " \n\t"), (None, docs[0][1]), (None, "only here now"), (5, docs[1][1]), (5, docs[1][1])]
    return [*docs, (6, docs[2][1].upper()), (4000, "A b c"), (4001, "x" * 30)]


@pytest.mark.parametrize("leaf", [4096, 512])
def test_equal_to_comparing_all_pairs(spark, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    docs = made()
    assert found(spark, docs) == plain(docs)


def test_many_fingerprints_in_small_leaves(spark, monkeypatch):
    """Levels of the index above the leaves, over several parts."""
    monkeypatch.setattr(simhash, "LEAF", 8)
    monkeypatch.setattr(simhash, "LEAVES_PER_TASK", 5)
    monkeypatch.setattr(simhash, "NODE_SIZES", (8, 2, 1))
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 100)
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2)
    near = codes[rng.integers(0, 60, 900)]
    for _ in range(2):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64))
    every = np.unique(np.r_[codes, near, near ^ np.uint64(1 << 63)])
    root = np.arange(len(every))
    for i in range(len(every)):
        for j in np.flatnonzero(np.bitwise_count(every ^ every[i]) <= 2):
            root[root == max(root[i], root[j])] = min(root[i], root[j])
    want = {}
    for c, r in zip(every.view(np.int64).tolist(), root.tolist()):
        want.setdefault(r, set()).add(c)
    df = spark.createDataFrame([(c,) for c in every.view(np.int64).tolist()], "f long")
    got = {}
    for r in simhash.similar_fingerprints(df).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_gray_rank_inverts_the_gray_code():
    ranks = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


def test_long_text_in_pieces(monkeypatch):
    text = "One  two\nthree " * 900 + "y" * 500 + " last"
    want = simhash.fingerprint(text)
    assert want == plain_fingerprint(text)
    for size in (1, 7, 64, 501):
        monkeypatch.setattr(simhash, "PIECE", size)
        assert simhash.fingerprint(text) == want


def test_empty_table(spark):
    assert found(spark, []) == []


def test_query_on_the_whole_small_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{brute.SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_simhash_dedup"](spark, brute.SF).collect()), key=str)
    assert got == plain(docs)
