"""Jaccard join, components and substring dedup against plain versions."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from stratamart.llm import jaccard_join as jj, substring_dedup as sd  # noqa: E402
from stratamart.llm.common import mix  # noqa: E402
from stratamart.llm.components import connected_components  # noqa: E402

COLUMNS = "doc_id long, text string, n int, root int, keys string, c string, a int, block int"


def near_copies(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    docs, out = [], []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((4, 8, 12, 30, 90)))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 15))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy))
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    docs += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(15)]
    docs += [docs[0], docs[0].upper(), "", None, " \n", "a b", "A  b", "a b c"]
    for i, t in enumerate(docs):
        out.append((i * 3 % 101, t))
    return [*out, (None, docs[0]), (None, "only here"), (5, docs[1]), (5, docs[1])]


def joined(spark, docs):
    df = spark.createDataFrame([(*d, 1, 2, "k", "c", 0, 0) for d in docs], COLUMNS)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.similarity_components(df).collect()), key=str)


def test_components_equal_comparing_all_pairs(spark):
    docs = near_copies()
    assert joined(spark, docs) == sorted(brute.jaccard_components(docs), key=str)


def test_small_blocks_and_cells_give_the_same(spark, monkeypatch):
    docs = near_copies(8)
    monkeypatch.setattr(jj, "BLOCK_SETS", 3)
    monkeypatch.setattr(jj, "FLUSH_KEYS", 50)
    monkeypatch.setattr(jj, "KEYS_PER_PART", 40)
    monkeypatch.setattr(jj, "SETTLE_KEYS", 15)
    monkeypatch.setattr(jj, "COMMON_DOCS", 2)
    assert joined(spark, docs) == sorted(brute.jaccard_components(docs), key=str)


@pytest.mark.parametrize("paired", [1, 2, 100])
def test_pairs_of_buckets_and_links_of_large_ones_give_the_same(spark, monkeypatch, paired):
    docs = near_copies(12)
    for name, value in {"BUCKET_PAIRED": paired, "PAIRS_HELD": 5, "FOREST_NODES": 5, "SETTLE_KEYS": 15, "KEYS_PER_PART": 300, "COMMON_DOCS": 2, "COMMON_TOTAL": 2}.items():
        monkeypatch.setattr(jj, name, value)
    assert joined(spark, docs) == sorted(brute.jaccard_components(docs), key=str)


def test_words_repeated_by_chance_join_no_blocks(spark, monkeypatch):
    """Texts that share eight words with each of some 14 others, elsewhere with each; two are near copies."""
    rng = random.Random(4)
    texts = [[f"own{i}x{j}" for j in range(10)] for i in range(500)]
    for i in range(500):
        for j in rng.sample(range(500), 7):
            passage = [f"both{rng.randrange(10**9)}" for _ in range(8)]
            texts[i] += [*passage, f"a{i}x{j}"]
            texts[j] += [*passage, f"b{j}x{i}"]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs.append((1000, docs[3][1] + " and more"))
    written = {}
    real = jj.pin

    def pin(df, purpose):
        out, rows = real(df, purpose)
        written[purpose] = rows
        return out, rows

    monkeypatch.setattr(jj, "BLOCK_SETS", 10)
    monkeypatch.setattr(jj, "pin", pin)
    found = {d: c for d, _, c in joined(spark, docs)}
    assert found == {d: 3 if d == 1000 else d for d, _ in docs}
    assert written["jaccard-sieve"] < len(docs)
    assert written["jaccard-blocks"] < 10


@pytest.mark.parametrize("common_share", [0, 0.3])
def test_a_set_keeps_no_more_keys_than_it_needs(common_share):
    pool = mix(np.arange(5000).astype(np.uint64))
    common = np.sort(pool[: int(common_share * len(pool))])
    rng = np.random.default_rng(2)
    kept = [len(jj.index_keys(np.sort(rng.choice(pool, 256, replace=False)), common)) for _ in range(50)]
    assert max(kept) <= 256 * 2 // 3 and np.mean(kept) < 100 + 200 * common_share


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jj.similarity_components(df).count() == 0
    assert sd.deduplicate(df).count() == 0


@pytest.mark.parametrize("common_share", [0, 0.1, 0.9])
def test_similar_sets_share_a_key(common_share):
    rng = np.random.default_rng(1)
    pool = mix(np.arange(3000).astype(np.uint64))
    common = np.sort(pool[: int(common_share * len(pool))])
    tried = 0
    for t in range(1500):
        n = int(np.exp(rng.uniform(0, np.log(400))))
        x = rng.choice(pool[: max(2 * n, 40)] if t % 2 else pool, n, replace=False)
        m = int(rng.integers(max(1, int(n * 0.75)), n * 4 // 3 + 1))
        shared = min(int(np.ceil(0.75 * (n + m) / 1.75)), n, m)
        y = np.r_[x[:shared], rng.choice(np.setdiff1d(pool, x), m - shared, replace=False)]
        x, y = np.sort(x), np.sort(y)
        both = len(np.intersect1d(x, y))
        if 4 * both >= 3 * (len(x) + len(y) - both) and not np.array_equal(x, y):
            tried += 1
            assert len(np.intersect1d(jj.index_keys(x, common), jj.index_keys(y, common)))
    assert tried > 500


def test_chain_of_edges(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (7, 7), (2000, 2001)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert found == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000, 2000: 2000, 2001: 2000}


def test_substring_dedup_on_the_small_table(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    want = brute.substring_dedup({r.doc_id: r.text for r in docs.collect()})
    assert {r.doc_id: r.text for r in sd.deduplicate(docs).collect()} == want


def test_substring_dedup_edge_cases(spark):
    passage = " ".join(f"word{i} other{i} third{i} fourth{i} fifth{i} sixth{i}." for i in range(8))
    docs = [
        (3, f"Before it.\n{passage}\nAfter it."), (9, f"Own start here.\n{passage} Own end."), (1, None), (2, ""), (4, "Short. Text."),
        (7, f"{passage} {passage}"), (7, f"{passage} {passage}"), (None, passage), (8, "\n  " + passage.upper() + "\t"),
    ]
    df = spark.createDataFrame([(i, t, "h", 1, 2) for i, t in docs], "doc_id long, text string, h string, b int, _spans int")
    got = sorted(((r.doc_id, r.text) for r in sd.deduplicate(df, keep=("doc_id", "h")).collect()), key=str)
    want = [(3, docs[0][1]), (9, "Own start here.\nOwn end."), (1, None), (2, ""), (4, "Short. Text."), (7, ""), (7, ""), (None, ""), (8, "")]
    assert got == sorted(want, key=str)


def odd_passages(n, lengths=range(50, 81)):
    """Passages without a fixed form, and texts that hold each between different words."""
    rng = random.Random(5)
    word = lambda ends: "".join(rng.choices("abcdefghij", k=5)) + "." * (rng.random() < ends)
    for k in range(n):
        passage = [word(rng.choice([0, 0, 0.05, 0.2])) for _ in range(lengths[k % len(lengths)])]
        around = [[word(rng.choice([0, 0.1, 0.5])) for _ in range(rng.randint(0, 40))] for _ in range(4)]
        yield passage, [around[0] + passage + around[1], around[2] + passage + around[3]], [len(around[0]), len(around[2])]


def test_every_passage_holds_a_run_of_all_its_copies():
    for passage, texts, at in odd_passages(3000):
        inside = []
        for words, start in zip(texts, at):
            _, _, first, hashes = sd.sentences(" ".join(words))
            spans = np.r_[first, len(hashes)][sd.runs(first, len(hashes))] - start
            inside.append({(int(b), int(e)) for b, e in spans if b >= 0 and e <= len(passage)})
        assert inside[0] & inside[1]


def test_passages_between_random_words_are_cut(spark):
    found = list(odd_passages(310))
    docs = [(2 * k + c, " ".join(texts[c])) for k, (_, texts, _) in enumerate(found) for c in (0, 1)]
    got = {r.doc_id: r.text for r in sd.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, (passage, texts, _) in enumerate(found):
        assert got[2 * k] == " ".join(texts[0])
        assert len(brute.words(got[2 * k + 1])) <= len(texts[1]) - sd.WORDS
        kept = set(brute.words(got[2 * k + 1]))
        assert kept >= set(texts[1]) - set(passage)
