"""Substring dedup over sliding spans of sentences.

Every run of several consecutive sentences is hashed. The first occurrence of a run,
by document id and position over the whole corpus, stays; sentences covered by any
other occurrence are removed. Hashes meet in one shuffle, packed by ranges of hashes.
Where two occurrences meet, in a task that reads texts or in the one of their range, the
later one is settled: it is not the first, whatever else there may be. So a task sends
one occurrence of a hash at most per so many runs, and a range keeps one per hash, however
many documents share a passage. Only texts with something to remove are shuffled.

A run is the shortest that begins (or ends) at a sentence and has at least
``SENTENCES`` sentences and ``WORDS`` words. Runs depend on their own words alone, so
a shared passage has the same runs wherever it stands; runs that end at a sentence as
well as those that begin at one are taken, so both ends of a passage are covered.

Sentences of more than ``LONGEST`` words are cut where their own words say, with at most
``WINDOW`` words between two cuts. What stands around a passage moves the cuts in its
first and last ``WINDOW`` words only, so one of 50 words or more holds a run that all its
copies have, wherever they stand and however they are punctuated around.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Columns, least_in_window, map_columns, maybe_in, mix, range_hashes, sentence_starts, small_batches, text_words
from stratamart.operators.lookups import pin

SENTENCES = 2
WORDS = 20
LONGEST = 10  # words; a longer sentence is cut after the word of least hash of each
WINDOW = 10  # words
FLUSH_RUNS = 1_000_000
RUNS_PER_TASK = 1_000_000
SETTLE_RUNS = 500_000
_TEXT_BYTES = 12  # of text for a run, about; it only sets the number of tasks
_U = np.uint64


def sentences(text: str) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes, first byte of each sentence, first word of each, and hashes of the words."""
    data, starts, ends, hashes = text_words(text)
    first = sentence_starts(data, starts, ends, least_in_window(hashes, WINDOW), LONGEST)
    at = starts[first] if len(first) else np.zeros(0, np.int64)
    if len(at):
        at = at.copy()
        at[0] = 0  # white space before the first word belongs to it
    return data.tobytes(), at, first, hashes


def runs(first: np.ndarray, n_words: int) -> np.ndarray:
    """First and past-the-end sentence of each run, distinct and in order."""
    n = len(first)
    if n < SENTENCES:
        return np.zeros((0, 2), np.int64)
    edge = np.r_[first, n_words]  # edge[i]: first word of sentence i
    start = np.arange(n)
    stop = np.maximum(start + SENTENCES, np.searchsorted(edge, edge[:-1] + WORDS))
    forward = np.stack([start, stop], 1)[stop <= n]
    end = np.arange(1, n + 1)
    begin = np.minimum(end - SENTENCES, np.searchsorted(edge, edge[1:] - WORDS, side="right") - 1)
    backward = np.stack([begin, end], 1)[begin >= 0]
    return np.unique(np.vstack([forward, backward]), axis=0)


class Occurrences:
    """Places of runs as columns: hashes ``h, g``, document (``last``: it has no id), sentences ``b`` to ``b + n``."""

    NAMES = ("h", "g", "last", "doc", "key", "b", "n")
    TYPES = (np.uint64, np.uint16, np.uint8, np.int64, np.int64, np.uint32, np.uint8)

    def __init__(self, columns: list[np.ndarray]) -> None:
        self.columns = columns

    @classmethod
    def joined(cls, parts: list[Occurrences]) -> Occurrences:
        return cls([np.concatenate(c) for c in zip(*(p.columns for p in parts))])

    def __len__(self) -> int:
        return len(self.columns[0])

    def __getitem__(self, at) -> Occurrences:
        return Occurrences([c[at] for c in self.columns])

    def settled(self) -> tuple[Occurrences, Occurrences]:
        """The first occurrence of each hash, in order of the hash, and all others."""
        own = self[np.argsort(self.columns[0], kind="stable")]
        h = own.columns[0]
        same = h[1:] == h[:-1]
        shared = np.r_[same, False] | np.r_[False, same]
        h, g, last, doc, key, b, _ = met = own[shared].columns
        order = np.lexsort((b, key, doc, last, g, h))
        h, g, last, doc, key, b, _ = met = [c[order] for c in met]
        new = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])][: len(h)]
        first = Occurrences(met)[new]
        back = np.cumsum(new) - 1
        # Equal rows of a document are one occurrence.
        other = np.zeros(len(h), bool)
        for c, f in zip(met[2:6], first.columns[2:6]):
            other |= c != f[back]
        kept = Occurrences.joined([own[~shared], first])
        return kept[np.argsort(kept.columns[0], kind="stable")], Occurrences(met)[other]


def _text_spans(text: str) -> list[np.ndarray]:
    """Hashes, first sentence and number of sentences of each run of a text."""
    _, _, first, hashes = sentences(text)
    spans = runs(first, len(hashes))
    edge = np.r_[first, len(hashes)]
    start, end = edge[spans[:, 0]], edge[spans[:, 1]]
    # 16 more bits from another function of the same words
    more = (range_hashes(mix(hashes), start, end) >> _U(48)).astype(np.uint16)
    return [range_hashes(hashes, start, end), more, spans[:, 0].astype(np.uint32), (spans[:, 1] - spans[:, 0]).astype(np.uint8)]


_PACKED = "p int, settled boolean, h binary, g binary, docs binary, number binary, b binary, n binary"


def _packed(found: Occurrences, p: int, settled: bool) -> Columns:
    """One row: documents are numbers into a list that goes along."""
    h, g, last, doc, key, b, n = found.columns
    docs, number = np.unique(np.stack([last.astype(np.int64), doc, key], 1), axis=0, return_inverse=True)
    number = number.ravel().astype(np.uint16 if len(docs) <= 1 << 16 else np.uint32)
    return {
        "p": [p], "settled": [settled], "h": [h.tobytes()], "g": [g.tobytes()], "docs": [docs.tobytes()],
        "number": [number.tobytes()], "b": [b.tobytes()], "n": [n.tobytes()],
    }


def _unpacked(h: bytes, g: bytes, docs: bytes, number: bytes, b: bytes, n: bytes) -> Occurrences:
    own = np.frombuffer(docs, np.int64).reshape(-1, 3)
    count = len(n)
    place = own[np.frombuffer(number, np.uint16 if len(number) == 2 * count else np.uint32)]
    return Occurrences([
        np.frombuffer(h, np.uint64), np.frombuffer(g, np.uint16), place[:, 0].astype(np.uint8), place[:, 1], place[:, 2],
        np.frombuffer(b, np.uint32), np.frombuffer(n, np.uint8),
    ])


def _span_rows(parts: int):
    """First occurrences by range of hashes, and what is settled already as it is."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        held: list[Occurrences] = []
        count = 0

        def out() -> Iterator[Columns]:
            first, others = Occurrences.joined(held).settled()
            if len(others):
                yield _packed(others, int(others.columns[0][0] % _U(parts)), True)  # to any part
            # Sorted by hash, so a range is a stretch.
            part = ((first.columns[0] >> _U(32)) * _U(parts)) >> _U(32)
            cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            for i, j in zip(cut, np.r_[cut[1:], len(part)]):
                yield _packed(first[i:j], int(part[i]), False)

        for b in batches:
            for doc_id, key, text in zip(b["doc_id"], b["key"], b["text"]):
                h, g, begin, n = _text_spans(text or "")
                if not len(h):
                    continue
                same = np.ones(len(h), np.int64)
                held.append(Occurrences([h, g, (same * (doc_id is None)).astype(np.uint8), same * (doc_id or 0), same * key, begin, n]))
                count += len(h)
                if count >= FLUSH_RUNS:
                    yield from out()
                    held, count = [], 0
        if held:
            yield from out()

    return run


def _settle_rows(batches: Iterator[Columns]) -> Iterator[Columns]:
    """All occurrences that are not the first; holds the first one of each hash seen."""
    known: list[Occurrences] = []
    waiting: list[Occurrences] = []
    count = 0

    def out(others: Occurrences) -> Columns:
        _, _, last, doc, key, b, n = others.columns
        ids = [None if x else int(d) for x, d in zip(last, doc)]
        return {"doc_id": ids, "key": key, "b": b.astype(np.int32), "e": b.astype(np.int32) + n}

    for batch in batches:
        for settled, *row in zip(*(batch[c] for c in ("settled", "h", "g", "docs", "number", "b", "n"))):
            found = _unpacked(*row)
            if settled:
                yield out(found)
                continue
            waiting.append(found)
            count += len(found)
            if count >= SETTLE_RUNS:
                first, others = Occurrences.joined(known + waiting).settled()
                known, waiting, count = [first], [], 0
                yield out(others)
    if waiting:
        yield out(Occurrences.joined(known + waiting).settled()[1])


def _remove_rows(keep: dict[str, str]):
    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for b in batches:
            out: Columns = {"text": [], "n_removed": []}
            for text, spans in zip(b["_text"], b["_spans"]):
                data, at, first, _ = sentences(text or "")
                gone = np.zeros(len(first) + 1, np.int64)
                for s in spans or ():
                    gone[s["b"]] += 1
                    gone[s["e"]] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                if gone.any():
                    edge = np.r_[at, len(data)]
                    text = b"".join(data[edge[i] : edge[i + 1]] for i in np.flatnonzero(~gone)).decode("utf-8", "replace")
                out["text"].append(text)
                out["n_removed"].append(int(gone.sum()))
            yield {v: b[v] for v in keep.values()} | out

    return run


def deduplicate(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with the remaining ``text`` and ``n_removed``, the sentences removed.

    One row per row of ``docs``; a text without repeated runs is returned unchanged.
    Null stays null and empty stays empty; a document all of whose sentences are
    repeats is left with an empty text. The first occurrence is the one with the
    smallest doc_id (null last), then the earliest. Rows with equal doc_id and text
    count as one document, so they keep the same text. Within a document the
    same rule holds. An empty table gives no rows. Columns other than ``keep`` and
    ``text`` are not read, whatever their names; columns ``text`` and ``n_removed`` of the
    result are always its own.
    """
    small_batches(docs.sparkSession)
    key = F.xxhash64("text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, -(-size // (_TEXT_BYTES * RUNS_PER_TASK)))
    packed = map_columns(docs.select("doc_id", key.alias("key"), "text"), _span_rows(parts), _PACKED)
    dealt = packed.repartitionById(parts, F.col("p"))
    places = map_columns(dealt.drop("p"), _settle_rows, "doc_id long, key long, b int, e int")
    removed = places.groupBy("doc_id", "key").agg(F.collect_set(F.struct("b", "e")).alias("_spans"))
    removed, _ = pin(removed.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_k"), "_spans"), "substring-removed")

    names = {c: f"_keep{i}" for i, c in enumerate(keep)}
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept_schema = ", ".join(f"`{v}` {fields[c]}" for c, v in names.items())
    chosen = docs.select(
        F.col("doc_id").alias("_id"), F.col("text").alias("_text"), key.alias("_key"), *[F.col(c).alias(v) for c, v in names.items()]
    )
    # Most texts stay as they are and need not be moved to find that out.
    touched = maybe_in(removed, "_k")(F.col("_key"))
    matched = chosen.where(touched).join(removed, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_k")), "left")
    cleaned = map_columns(matched.select("_text", "_spans", *names.values()), _remove_rows(names), f"{kept_schema}, text string, n_removed int")
    whole = chosen.where(~touched).select(*names.values(), F.col("_text").alias("text"), F.lit(0).alias("n_removed"))
    return whole.unionByName(cleaned).select(*[F.col(v).alias(c) for c, v in names.items()], "text", "n_removed")
