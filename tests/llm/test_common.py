from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
from hypothesis import given, settings, strategies as st

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from stratamart.llm import common  # noqa: E402

TEXT = st.text(alphabet="aB \t\n\x0b.é|\x1c 漢!", max_size=60)


@given(TEXT)
@settings(max_examples=400, deadline=None)
def test_words_are_those_of_the_pattern(text):
    data, starts, ends, hashes = common.text_words(text)
    assert [bytes(data[s:e]).decode() for s, e in zip(starts, ends)] == brute.words(text)
    same = {}
    for word, h in zip(brute.words(text.translate(brute.LOWER)), hashes):
        assert same.setdefault(word, h) == h
    assert len(set(same.values())) == len(same)


@given(TEXT, st.integers(1, 6))
@settings(max_examples=300, deadline=None)
def test_shingles_count_as_plain_sets(text, k):
    assert len(common.shingle_set(text, k)) == len(brute.shingles(text, k))


@given(TEXT, st.integers(1, 5), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_sentences(text, longest, window):
    data, starts, ends, hashes = common.text_words(text)
    firsts = common.sentence_starts(data, starts, ends, common.least_in_window(hashes, window), longest)
    plain = brute.sentence_words(text, longest, window)
    assert list(firsts) == list(np.cumsum([0, *map(len, plain)])[:-1])


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = " ".join(f"wörd{i % 977}" for i in range(5000)) + " " + "x" * 300
    whole = common.text_words(text)
    monkeypatch.setattr(common, "_BLOCK", 64)
    for a, b in zip(whole, common.text_words(text)):
        assert np.array_equal(a, b)


def test_jvm_words_equal_python_words(spark):
    texts = ["", None, " a\tb\x0bc\x0c\rd  e\n", "one", "\n \t", "x y z"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(common.words(df.text)).collect()]
    assert got == [brute.words(t) for t in texts]


def test_fold_is_crc32_of_the_id_as_text(spark):
    df = spark.createDataFrame([(i,) for i in [*range(50), -3, None]], "doc_id long")
    got = [r[0] for r in df.select(common.fold("doc_id", 3)).collect()]
    assert got == [common.crc_fold(i, 3) for i in [*range(50), -3, None]]
