"""Mixing, packing, top-k search and the pipeline."""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from stratamart.llm import mixing, packing, topk_search as topk  # noqa: E402


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 40}, {"a": 0, "b": 10}, {"x": 7}, {"a": 0}, {"a": 900, "b": 1, "c": 1, "d": 1, "é": 3, None: 2}],
)
def test_targets_equal_repeated_sharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute.mix_targets(sizes), abs=1e-6)


def test_mix_of_the_small_table(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    taken, target, copies, n = Counter(), {}, Counter(), Counter()
    for r in rows:
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size
        taken[r.source] += r.taken
        copies[r.source] += r.copies
        n[r.source] += 1
        target[r.source] = (r.target, r.source_size, max(r.size, 0))
    biggest = defaultdict(int)
    for r in rows:
        biggest[r.source] = max(biggest[r.source], r.size)
    for s, (t, size, _) in target.items():
        assert abs(taken[s] - t) <= biggest[s]  # all but the landing of two rows is exact
        assert abs(copies[s] - n[s] * t / size) <= 2.01
    again = {(r.doc_id, r.copies) for r in mixing.mix_sources(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    flight, rows = mixing.Flight(), [[int(z), 0.37, float(rng.random())] for z in rng.integers(1, 500, 400)]
    before = sum(r[0] * r[1] for r in rows), sum(r[1] for r in rows)
    done = [d for r in rows for d in flight.add(r)]
    assert len(flight.waiting) <= 2 and all(d[1] in (0.0, 1.0) for d in done)
    after = sum(r[0] * r[1] for r in rows), sum(r[1] for r in rows)
    assert after == pytest.approx(before)


def test_mix_edge_cases(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, "s"), (3, "", None), (None, "x y", None), (4, "", "empty")]
    df = spark.createDataFrame([(*r, 1, 1.0) for r in rows], "doc_id long, text string, source string, size int, target double")
    out = mixing.mix_sources(df).collect()
    assert len(out) == 6 and all(r.taken <= 3 * r.size for r in out)
    assert {r.source: r.source_size for r in out} == {"s": 6, None: 2, "empty": 0}
    assert mixing.mix_sources(df.limit(0)).count() == 0


def check_bins(rows, texts, capacity, per_source):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for members in bins.values():
        members.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in members:
            assert r.bin_offset == at
            at += r.n_words
        assert at <= capacity
        assert max(Counter(texts[r.doc_id][1] for r in members).values()) <= per_source or len(members) == 1
        labels = [" ".join(brute.words(texts[r.doc_id][0].lower())) for r in members]
        assert len(set(labels)) == len(labels)
    for doc, (text, _) in texts.items():
        own = sorted(pieces[doc], key=lambda r: r.piece)
        assert sum(r.n_words for r in own) == len(brute.words(text))
        assert [r.start_word for r in own] == [capacity * k for k in range(len(own))]


def test_packing(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    rows = packing.pack(docs, capacity=500, shard_rows=300).collect()
    check_bins(rows, {r.doc_id: (r.text, r.source) for r in docs.collect()}, 500, packing.PER_SOURCE)


def test_tightest_compatible_bin():
    # Rooms after the first two: 4 and 3. Size 3 goes to the bin with room 3, unless its cluster is there.
    assert packing.best_fit([6, 7, 3], [0, 1, 2], [-1, -1, -1], 10, 1) == [0, 1, 1]
    assert packing.best_fit([6, 7, 3], [0, 1, 2], [-1, 0, 0], 10, 1) == [0, 1, 0]
    assert packing.best_fit([6, 7, 3], [2, 2, 2], [-1, -1, -1], 10, 1) == [0, 1, 2]
    assert packing.best_fit([6, 7, 3], [2, 2, 2], [-1, -1, -1], 10, 2) == [0, 1, 1]


def test_packing_edge_cases(spark):
    df = spark.createDataFrame(
        [(1, None, None, 1), (2, "", "s", 1), (3, "a " * 25, None, 1), (3, "a " * 25, None, 1), (None, "b c", "s", 1)],
        "doc_id long, text string, source string, bin_id int",
    )
    rows = packing.pack(df, capacity=10).collect()
    assert sorted(r.n_words for r in rows) == [0, 0, 2, 5, 5, 10, 10, 10, 10]
    assert all((r.bin_id is None) == (r.n_words == 0) for r in rows)
    assert packing.pack(df.limit(0)).count() == 0


def check_copies(rows, texts, capacity, per_source):
    """Bins of pieces, in which documents (``{doc_id: (text, source)}``) may have copies."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for b, members in bins.items():
        if b is not None:
            assert sum(r.n_words for r in members) <= capacity
            assert max(Counter(" ".join(brute.words(texts[r.doc_id][0].lower())) for r in members).values()) == 1
            assert max(Counter(texts[r.doc_id][1] for r in members).values()) <= per_source


def test_full_pieces_of_copies_have_bins_of_their_own(spark):
    texts = {1: ("a b " * 15, "s"), 2: ("c " * 20, "s"), 3: ("c " * 20, "t"), 4: ("d " * 7, "t")}
    rows = [(i, t, s) for i, (t, s) in texts.items() for _ in range(3)]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        got = packing.pack(df, capacity=10).collect()
        assert Counter((r.doc_id, r.piece) for r in got) == {(1, 0): 3, (1, 1): 3, (1, 2): 3, (2, 0): 3, (2, 1): 3, (3, 0): 3, (3, 1): 3, (4, 0): 3}
        check_copies(got, texts, 10, packing.PER_SOURCE)


def test_bins_of_the_mixed_small_table(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    mixed = corpus_pipeline.mix_to_targets(spark, docs, brute.SF)
    check_copies(corpus_pipeline.pack_bins(spark, mixed, brute.SF).collect(), texts, packing.CAPACITY, packing.PER_SOURCE)


def plain_search(rows, k):
    ok = [(i, np.floor(256 * np.array(v, float)).astype(int).tolist()) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % 5 == 0}):
        found = sorted((-sum(a * b for a, b in zip(v, w)), j) for i, v in ok if i == q for j, w in ok if j != q)[:k]
        out += [(q, r, j, -s) for r, (s, j) in enumerate(found, 1)]
    return out


@pytest.mark.parametrize("block", [4, 1000])
def test_search_equals_all_products(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 6)]) for i in range(60)]
    rows += [(61, rows[3][1]), (62, rows[3][1]), (65, None), (70, [1.0, None]), (75, [float("nan")] * 6), (80, [float("inf")] * 6), (85, []), (90, [0.5])]
    rows += [(None, rows[1][1]), (10, rows[10][1]), (95, [1e7, -1e7])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    got = topk.search(df, F.col("vec_id") % 5 == 0, 5, block_rows=block, query_rows=3).collect()
    assert sorted(map(tuple, got)) == plain_search([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5)
    assert topk.search(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_search_prunes_by_slices():
    rng = np.random.default_rng(0)
    values = np.floor(256 * rng.normal(0, 0.125, (4000, 64))).astype(np.int64)
    index, scored = topk.SlicedIndex(np.arange(4000), values), []
    exact = index.exact
    index.exact = lambda rows, q: (scored.append(len(rows)), exact(rows, q))[1]
    for i in range(10):
        found = index.search(i, values[i], 5)
        products = values @ values[i]
        products[i] = products.min() - 1
        assert [s for s, _ in found] == sorted(products.tolist(), reverse=True)[:5]
    assert np.mean(scored) < 1000


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{brute.SF}/labels.parquet").collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, brute.SF)
        rows = out.collect()
        sizes.append(len(rows))
        if name == "quality_classifier":
            kept = {r.doc_id for r in rows}
            assert np.mean([r.doc_id in kept for r in before if labels.get(r.doc_id) == 1]) > 0.95
            assert np.mean([r.doc_id in kept for r in before if labels.get(r.doc_id) == 0]) < 0.1
        elif name == "ngram_jaccard_join":
            want = brute.jaccard_components([(r.doc_id, r.text) for r in before])
            assert sorted(r.doc_id for r in rows) == sorted(d for d, _, c in want if d == c)
        elif name == "substring_dedup":
            want = brute.substring_dedup({r.doc_id: r.text for r in before})
            assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
        elif name == "source_mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix_sources(docs).collect()}
            assert Counter(r.doc_id for r in rows) == {d: c for d, c in copies.items() if c}
        else:
            assert sum(r.n_words for r in rows) == sum(len(brute.words(r.text)) for r in before)
            placed = Counter((r.bin_id, r.doc_id) for r in rows if r.bin_id is not None and r.bin_id >= 0)
            assert max(placed.values()) == 1
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(rows, out.schema)
    assert corpus_pipeline.run(spark, brute.SF).count() == sizes[-1]


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, "", "en", None, 0), (2, "a b c d e f", None, "s", 11), (2, "a b c d e f", None, "s", 11), (None, "a b c d e f", None, "s", 11)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(2, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (rows, []):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, spark.createDataFrame(table, schema), str(tmp_path))
            assert out.count() <= 3 * len(table)
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, schema), str(tmp_path)).collect()
    assert sorted(map(str, [(r.doc_id, r.text) for r in kept])) == sorted(map(str, [(1, None), (None, ""), (2, "a b c d e f")]))
