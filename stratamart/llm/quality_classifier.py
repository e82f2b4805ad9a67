"""Quality classifier from trusted positives and unlabelled web text.

Positive-unlabelled learning: the risk of a classifier is written with positives and
unlabelled rows alone, given the share of positives (the class prior), and the part
that stands for negatives is kept from going below zero (non-negative unbiased risk).
Labels of bad documents are never used.

The prior is estimated over all training rows: a first classifier tells positives
from unlabelled text, and the share of unlabelled rows above a threshold is at least
the prior times the share of positives above it, so the least ratio over all
thresholds bounds the prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import shingle_set, small_batches, text_words
from stratamart.operators.lookups import pin

# Bounds of the samples the two classifiers are fitted on, rows chosen by hash of the id.
POSITIVE_ROWS = 20_000
UNLABELLED_ROWS = 20_000
STEPS = 400
BINS = 1000

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "beyond_ascii": range(128, 256), "marks": map(ord, "!?"),
    "stops": map(ord, ".,;:"), "symbols": map(ord, "#*$%&@^~+=_\\"), "bars": map(ord, "|<>{}[]"), "space": map(ord, " \t"),
}
_CLASS = np.zeros((len(_CLASSES), 256), np.float64)
for _k, _chars in enumerate(_CLASSES.values()):
    _CLASS[_k, list(_chars)] = 1.0
FEATURES = [*_CLASSES, "words", "word_length", "word_spread", "distinct", "top_word", "distinct_pairs", "distinct_fours", "lines",
            "distinct_lines", "line_words", "closed_lines"]


def features(text: str | None) -> list[float]:
    """Numbers about one whole text, none of them from ids, sources or languages. Null and empty texts: zeros."""
    data, starts, ends, hashes = text_words(text or "")
    n = len(hashes)
    if not n:
        return [0.0] * len(FEATURES)
    shares = _CLASS @ np.bincount(data, minlength=256) / len(data)
    lengths = ends - starts
    counts = np.unique(hashes, return_counts=True)[1]
    lines = [x for x in (text or "").split("\n") if x.strip()]
    closed = sum(x.rstrip()[-1] in ".!?" for x in lines)
    distinct = lambda k: len(shingle_set(text, k)) / max(1, n - k + 1)
    return [
        *shares.tolist(), np.log1p(n), lengths.mean(), lengths.std(), len(counts) / n, counts.max() / n, distinct(2), distinct(4),
        np.log1p(len(lines)), len(set(lines)) / len(lines), np.log1p(n / len(lines)), closed / len(lines),
    ]


@dataclass
class Linear:
    """A linear model over the standardised features and their squares."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # the last one is the offset

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.spread, -5, 5)
        return np.hstack([z, z * z, np.ones((len(z), 1))])

    def column(self, array: Column) -> Column:
        """The same value as a Spark expression over an array column."""
        k = len(self.centre)
        total = F.lit(float(self.weights[-1]))
        for i in range(k):
            z = (F.get(array, F.lit(i)).cast("double") - float(self.centre[i])) / float(self.spread[i])
            z = F.greatest(F.lit(-5.0), F.least(F.lit(5.0), z))
            total = total + z * (float(self.weights[i]) + float(self.weights[k + i]) * z)
        return total


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = STEPS) -> Linear:
    """Minimise the non-negative risk at ``prior``; without one, tell positives from unlabelled rows.

    With loss l(v) = log(1 + e^-v): the risk is prior * mean_P l(v) + max(0, mean_U l(-v) - prior * mean_P l(-v)).
    Where the second part is below zero, a step goes against its gradient instead.
    """
    every = np.vstack([positive, unlabelled])
    m = Linear(every.mean(0), every.std(0) + 1e-6, np.zeros(2 * every.shape[1] + 1))
    p, u = m.inputs(positive), m.inputs(unlabelled)
    mean, power = np.zeros_like(m.weights), np.zeros_like(m.weights)
    for step in range(1, steps + 1):
        sp, su = _sigmoid(p @ m.weights), _sigmoid(u @ m.weights)
        up = lambda x, s: x.T @ (s - 1) / len(x)  # noqa: E731  gradient of mean l(v)
        down = lambda x, s: x.T @ s / len(x)  # noqa: E731  gradient of mean l(-v)
        if prior is None:
            g = up(p, sp) + down(u, su)
        else:
            negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
            rest = down(u, su) - prior * down(p, sp)
            g = prior * up(p, sp) + rest if negative >= 0 else -rest
        g = g + (0.01 + 10 / len(p)) * np.r_[m.weights[:-1], 0]  # few positives are trusted less
        mean += 0.1 * (g - mean)
        power += 0.01 * (g * g - power)
        m.weights -= 0.1 * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-9)
    return m


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The least ratio of tails of two score histograms (lowest score first), with a margin for chance.

    Tails with fewer than a hundredth of the positives are not looked at.
    """
    n_p, n_u = positive.sum(), unlabelled.sum()
    if not n_p or not n_u:
        return 0.5
    tail_p, tail_u = positive[::-1].cumsum() / n_p, unlabelled[::-1].cumsum() / n_u
    seen = tail_p >= 0.01
    slack = np.sqrt(np.log(20) / (2 * n_p)) + np.sqrt(np.log(20) / (2 * n_u))
    ratio = np.where(seen, tail_u / np.maximum(tail_p, 1e-12), 1.0)
    bound = np.where(seen, (tail_u + slack) / np.maximum(tail_p, 1e-12), np.inf)
    return float(np.clip(ratio[bound.argmin()], 0.01, 0.99))


def _sample(measured: DataFrame, rows: int, seed: int) -> np.ndarray:
    """About ``rows`` feature rows, or all if there are fewer: those whose hash is low enough for their number.

    The bound comes from a count, so no more than these rows leave the tasks. Rows are
    hashed with their features, so that those without an id are chosen one by one.
    """
    share = int(min(1.0, rows / max(1, measured.count())) * (1 << 40))
    low = F.pmod(F.xxhash64("_id", "_features", F.lit(seed)), F.lit(1 << 40)) < share
    kept = measured.where(low).select("_features").limit(2 * rows).collect()  # twice, if many rows are equal
    return np.array([r[0] for r in kept], np.float64).reshape(-1, len(FEATURES))


def _feature_batch(texts: pd.Series) -> pd.Series:
    return pd.Series([features(None if t is None or t != t else t) for t in texts], dtype=object)


def feature_column(text: str = "text") -> Column:
    return F.pandas_udf(_feature_batch, "array<float>")(F.col(text))


def learn_quality(
    measured: DataFrame,
    labels: DataFrame,
    learn: Column,
    positive_rows: int = POSITIVE_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
    seed: int = 1,
) -> Linear | None:
    """Fit the classifier on stored features (``_id``, ``_features``); None without positives or unlabelled rows.

    ``labels`` gives the trusted positives (``doc_id``, ``quality`` 1). Rows where
    ``learn`` (over ``doc_id``) is not true are never learnt from.
    """
    training = measured.withColumn("doc_id", F.col("_id")).where(learn).select("_id", "_features")
    trusted = labels.where("quality = 1").select(F.col("doc_id").alias("_id")).distinct()
    positive = training.join(trusted, "_id", "left_semi").select("_id", "_features")
    p, u = _sample(positive, positive_rows, seed), _sample(training, unlabelled_rows, seed + 1)
    if not len(p) or not len(u):
        return None
    first = fit(p, u, None)
    bin_of = F.least(F.lit(BINS - 1), F.floor(BINS * _probability(first))).cast("int")

    def histogram(rows: DataFrame) -> np.ndarray:
        out = np.zeros(BINS)
        for b, n in rows.groupBy(bin_of.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():  # BINS rows at most
            out[b] = n
        return out

    return fit(p, u, class_prior(histogram(positive), histogram(training)))


def _probability(model: Linear | None) -> Column:
    if model is None:
        return F.lit(0.5)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), model.column(F.col("_features"))))))


def measure_quality(docs: DataFrame) -> DataFrame:
    """Features of every whole text, stored: ``_id, _features``."""
    small_batches(docs.sparkSession)
    measured, _ = pin(docs.select(F.col("doc_id").alias("_id"), feature_column().alias("_features")), "quality-features")
    return measured


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, **bounds) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted``, one row per row of ``docs``.

    Null and empty texts are scored as texts without words. Without positives or
    unlabelled rows every score is 0.5. Equal rows get equal scores; an empty table
    gives no rows. Only ``doc_id`` and ``text`` are read; the id only chooses rows to
    learn from. ``bounds`` are those of ``learn_quality``.
    """
    measured = measure_quality(docs)
    score = _probability(learn_quality(measured, labels, learn, **bounds))
    return measured.select(F.col("_id").alias("doc_id"), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """The rows of ``docs`` predicted good, with all their columns. Texts stay where they are
    and their features are worked out a second time, which costs less than moving them."""
    model = learn_quality(measure_quality(docs), labels, learn)
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), feature_column().alias("_features"))
    return judged.where(_probability(model) >= 0.5).select("_row.*")
