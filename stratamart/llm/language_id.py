"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text as overlapping windows of bytes in both directions, labels
every byte of the text once, and a document's probabilities are the mean over its
letters. It is trained here, in numpy, by backpropagation through time on windows
of a bounded sample of documents per language.

Gates use the piecewise linear sigmoid and the candidate state a clipped linear
unit, which cost a few array operations per byte and have simple derivatives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from stratamart.llm.common import Columns, map_columns, small_batches

HIDDEN = 8
TRAIN_DOCS = 300  # per language
TRAIN_WINDOW = 64
STEPS = 400
BATCH = 128
WINDOW = 256
MARGIN = 8  # bytes read on either side of a window, labelled by its neighbours
TOGETHER = 1024  # windows run side by side
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    inputs: np.ndarray  # direction, gate rows, byte
    recurrent: np.ndarray  # direction, gate rows, hidden
    out: np.ndarray  # language, both states
    bias: np.ndarray


def _start(languages: list[str], hidden: int, rng: np.random.Generator) -> Model:
    f = np.float32
    inputs = rng.normal(0, 0.3, (2, 3 * hidden, 257)).astype(f)  # byte 256: padding
    inputs[:, :hidden] += 1.0  # at first, states are mostly carried on
    return Model(
        list(languages),
        inputs,
        rng.normal(0, 0.5 / np.sqrt(hidden), (2, 3 * hidden, hidden)).astype(f),
        rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(f),
        np.zeros((len(languages), 1), f),
    )


def _states(m: Model, data: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States of both directions, ``[length, 2, hidden, windows]``; ``data`` is ``[windows, length]``."""
    n, length = data.shape
    h = m.recurrent.shape[2]
    both = np.ascontiguousarray(np.stack([data, data[:, ::-1]]).transpose(2, 0, 1))  # time, direction, window
    state = np.zeros((2, h, n), np.float32)
    states = np.empty((length, 2, h, n), np.float32)
    # The slope and offset of the gates' sigmoid, worked into its inputs.
    inputs = m.inputs.copy()
    inputs[:, : 2 * h] = 0.25 * inputs[:, : 2 * h] + 0.5
    gates = 0.25 * m.recurrent[:, : 2 * h]
    last = m.recurrent[:, 2 * h :]
    x = np.empty((2, 3 * h, n), np.float32)
    for t in range(length):
        for k in range(2):
            np.take(inputs[k], both[t, k], axis=1, out=x[k], mode="clip")
        zr = gates @ state
        zr += x[:, : 2 * h]
        raw = zr.copy() if trace is not None else None
        np.minimum(np.maximum(zr, 0, out=zr), 1, out=zr)
        z, r = zr[:, :h], zr[:, h:]
        c = last @ (r * state)
        c += x[:, 2 * h :]
        raw_c = c.copy() if trace is not None else None
        np.minimum(np.maximum(c, -1, out=c), 1, out=c)
        if trace is not None:
            trace.append((state, zr, raw, c, raw_c, both[t]))
        state = c + z * (state - c)
        states[t] = state
    states[:, 1] = states[::-1, 1].copy()  # the backward direction, in reading order
    return states


def _scores(m: Model, states: np.ndarray) -> np.ndarray:
    """Label probabilities, ``[length, language, windows]``."""
    length, _, h, n = states.shape
    logits = m.out @ states.reshape(length, 2 * h, n) + m.bias
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _gradients(m: Model, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss per byte and its derivatives, by backpropagation through time."""
    trace: list = []
    states = _states(m, data, trace)
    length, _, h, n = states.shape
    p = _scores(m, states)
    picked = p[:, labels, np.arange(n)]
    loss = float(-np.log(picked + 1e-9).mean())
    d = p
    d[:, labels, np.arange(n)] -= 1
    d /= length * n
    flat = states.reshape(length, 2 * h, n)
    g_out, g_bias = np.einsum("tln,tsn->ls", d, flat), d.sum(axis=(0, 2))[:, None]
    d_states = (m.out.T @ d).reshape(length, 2, h, n)
    d_states[:, 1] = d_states[::-1, 1].copy()
    g_in, g_rec = np.zeros_like(m.inputs), np.zeros_like(m.recurrent)
    carry = np.zeros((2, h, n), np.float32)
    gates, last = m.recurrent[:, : 2 * h], m.recurrent[:, 2 * h :]
    for t in range(length - 1, -1, -1):
        before, zr, raw, c, raw_c, byte = trace[t]
        z, r = zr[:, :h], zr[:, h:]
        ds = carry + d_states[t]
        dc = ds * (1 - z) * (np.abs(raw_c) < 1)
        d_rs = last.transpose(0, 2, 1) @ dc
        dzr = np.concatenate([ds * (before - c), d_rs * before], axis=1) * 0.25 * ((raw > 0) & (raw < 1))
        carry = ds * z + d_rs * r + gates.transpose(0, 2, 1) @ dzr
        g_rec[:, : 2 * h] += dzr @ before.transpose(0, 2, 1)
        g_rec[:, 2 * h :] += dc @ (r * before).transpose(0, 2, 1)
        dx = np.concatenate([dzr, dc], axis=1)
        for k in range(2):
            np.add.at(g_in[k].T, byte[k], dx[k].T)
    return loss, [g_in, g_rec, g_out, g_bias]


def train(texts: list[str], labels: list[str], seed: int = 1, steps: int = STEPS) -> Model:
    """Train on a bounded sample of texts: each step takes random windows, languages evenly.

    Without any text the model has no language and every prediction is ``und``.
    """
    rng = np.random.default_rng(seed)
    by: dict[str, list[np.ndarray]] = {}
    for text, label in sorted(zip(texts, labels)):
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        if len(data):
            by.setdefault(label, []).append(data)
    languages = sorted(by)
    m = _start(languages, HIDDEN, rng)
    if len(languages) < 2:
        return m
    params = [m.inputs, m.recurrent, m.out, m.bias]
    mean = [np.zeros_like(p) for p in params]
    power = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        labels_now = rng.integers(len(languages), size=BATCH)
        data = np.full((BATCH, TRAIN_WINDOW), 256, np.int64)
        for i, k in enumerate(labels_now):
            pool = by[languages[k]]
            text = pool[rng.integers(len(pool))]
            at = rng.integers(max(1, len(text) - TRAIN_WINDOW + 1))
            piece = text[at : at + TRAIN_WINDOW]
            data[i, : len(piece)] = piece
        _, grads = _gradients(m, data, labels_now)
        rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(params, grads, mean, power):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return m


_LETTER_BYTE = np.zeros(257, bool)
_LETTER_BYTE[65:91] = _LETTER_BYTE[97:123] = _LETTER_BYTE[128:256] = True


def label_positions(m: Model, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields, for groups of windows, text number per window, probabilities per byte
    ``[window, language, byte]`` and which bytes count; every byte of every text once."""
    span = WINDOW + 2 * MARGIN
    owners, windows = [], []

    def run():
        data = np.full((len(windows), span), 256, np.int64)
        counts = np.zeros((len(windows), WINDOW), bool)
        for i, (text, at) in enumerate(windows):
            first = max(0, at - MARGIN)
            piece = np.frombuffer(text, np.uint8, min(len(text), at + WINDOW + MARGIN) - first, first)
            data[i, first - at + MARGIN :][: len(piece)] = piece
        counts[:] = _LETTER_BYTE[data[:, MARGIN:-MARGIN]]
        scores = _scores(m, _states(m, data)[MARGIN:-MARGIN])
        return np.array(owners), scores.transpose(2, 1, 0), counts

    for k, text in enumerate(texts):
        for at in range(0, len(text), WINDOW):
            owners.append(k)
            windows.append((text, at))
            if len(windows) == TOGETHER:
                yield run()
                owners, windows = [], []
    if windows:
        yield run()


def predict(m: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    known = len(m.languages)
    usable = [t is not None and any(map(str.isalpha, t)) for t in texts]
    total = np.zeros((len(texts), max(known, 1)))
    if known:
        data = [t.encode("utf-8", "replace") if ok else b"" for t, ok in zip(texts, usable)]
        for owners, scores, counts in label_positions(m, data):
            np.add.at(total, owners, (scores * counts[:, None, :]).sum(axis=2))
    sums = total.sum(axis=1)
    best = total.argmax(axis=1)
    labels, probability = [], []
    for k, ok in enumerate(usable):
        found = ok and known and sums[k] > 0
        labels.append(m.languages[best[k]] if found else UNKNOWN)
        probability.append(float(min(1.0, total[k, best[k]] / sums[k])) if found else 0.0)
    return labels, probability


def training_sample(docs: DataFrame, per_language: int, seed: int) -> list[tuple[str, str]]:
    """At most ``per_language`` different texts of each language, whole, chosen by hash of id and text.

    Ids and hashes of texts are chosen first; their number is bounded by the parameter and
    the languages, so they are broadcast to fetch the texts. Repeated rows count once, and
    rows without an id are learnt from like others.
    """
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.xxhash64("text").alias("_key"), "lang", "text")
    usable = keyed.where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    own = ["_id", "_key", "lang"]
    first = Window.partitionBy("lang").orderBy(F.xxhash64("_id", "_key", F.lit(seed)), "_id", "_key")
    ranked = usable.select(*own).withColumn("_k", F.dense_rank().over(first)).where(F.col("_k") <= per_language)
    chosen = ranked.select(*own).distinct()
    texts = usable.join(F.broadcast(chosen), own, "left_semi").dropDuplicates(own)
    return [tuple(r) for r in texts.select("text", "lang").collect()]


def identify(docs: DataFrame, learn_from: DataFrame, keep: tuple[str, ...] = ("doc_id",), seed: int = 1) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to the columns ``keep``, one row per row of ``docs``.

    Learns from ``text`` and ``lang`` of ``learn_from`` only. A text that is null or
    has no letter gets ``und`` and score 0, as does every text if there is nothing to
    learn from. Texts are read whole, in windows, so their length costs no memory. Equal texts
    get equal results, rows that repeat are rows of the result, an empty table gives none.
    Of two languages with equal sums the first in order is taken.
    """
    small_batches(docs.sparkSession, 256)
    sample = training_sample(learn_from, TRAIN_DOCS, seed)
    model = train([t for t, _ in sample], [lang for _, lang in sample], seed)
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{k}` {fields[k]}" for k in keep) + ", lang_pred string, score double"

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for b in batches:
            labels, scores = predict(model, b["text"])
            yield {k: b[k] for k in keep} | {"lang_pred": labels, "score": scores}

    return map_columns(docs.select(*keep, "text"), run, schema)
