"""Plain versions of operators, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict

from stratamart.llm.common import text_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SF = "/root/testdata/sf0.01"


def words(text):
    return WORD.findall(text or "")


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard_components(docs):
    """[(doc_id, text)] -> [(doc_id, n_shingles, component_id)], comparing every pair."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(docs)]


def sentence_words(text, longest, window):
    """Words of each sentence; one of more than ``longest`` is cut after the word of least hash of each ``window`` in a row."""
    found = list(WORD.finditer(text or ""))
    hashes = [int(text_words(m.group())[3][0]) for m in found]
    least = set()
    for i in range(len(found) - window + 1):
        m = min(hashes[i : i + window])
        least.update(j for j in range(i, i + window) if hashes[j] == m)
    sentences, current = [], []
    for k, m in enumerate(found):
        current.append(k)
        newline = k + 1 < len(found) and "\n" in text[m.end() : found[k + 1].start()]
        if m.group()[-1] in ".!?" or newline:
            sentences.append(current)
            current = []
    out = []
    for s in [*sentences, current]:
        piece = []
        for k in s:
            piece.append(found[k])
            if len(s) > longest and k in least:
                out.append(piece)
                piece = []
        out += [piece] if piece else []
    return out


def runs(lengths, sentences, least_words):
    """Shortest runs from each sentence on, and up to each sentence."""
    n, out = len(lengths), set()
    for step, start in ((1, 0), (-1, n - 1)):
        end, held = start, 0  # sentences from i up to but not including end, in this direction
        for i in range(start, n if step > 0 else -1, step):
            while 0 <= end < n and (abs(end - i) < sentences or held < least_words):
                held += lengths[end]
                end += step
            if abs(end - i) >= sentences and held >= least_words:
                out.add((i, end) if step > 0 else (end + 1, i + 1))
            held -= lengths[i]
    return sorted(out)


def substring_dedup(docs, sentences=2, least_words=20, longest=10, window=10):
    """{doc_id: text} with the sentences of repeated runs removed."""
    first, places, cut = {}, [], {}
    for doc, text in sorted(docs.items()):
        cut[doc] = sentence_words(text, longest, window)
        for i, j in runs([len(s) for s in cut[doc]], sentences, least_words):
            key = " ".join(m.group().translate(LOWER) for s in cut[doc][i:j] for m in s)
            places.append((key, (doc, i, j)))
            first[key] = min(first.get(key, (doc, i, j)), (doc, i, j))
    gone = defaultdict(set)
    for key, (doc, i, j) in places:
        if first[key] != (doc, i, j):
            gone[doc].update(range(i, j))
    out = {}
    for doc, text in docs.items():
        s = cut[doc]
        edges = [0, *[x[0].start() for x in s[1:]], len(text or "")]
        out[doc] = "".join(text[edges[k] : edges[k + 1]] for k in range(len(s)) if k not in gone[doc]) if gone[doc] else text
    return out


def mix_targets(sizes, cap=3.0, weights=(1, 2, 3)):
    """{source: size} -> {source: target}, sharing again and again what is above the cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > cap * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= above
    return target
