"""Exact n-gram Jaccard join by partitioning the universe of shingles.

Documents with equal shingle sets form one class; classes are compared. Two sets x, y
can only reach similarity a/b if at most H = (b-a)(|x|+|y|)/(a+b) shingles differ.
Sizes fall into bands. Within a band the universe is hashed into segments, and by the
pigeonhole principle two similar sets agree on some segment if there are more than H:

* Large bands index each segment's content (one unit per non-empty segment). They have
  more segments than need be, and a set leaves out as many keys as it has units to
  spare, those of the fewest shingles first, of which chance makes the most meet. Of two
  similar sets' common keys both keep the last one in that order.
* Small bands, whose sets would leave many segments empty, use fewer segments and
  index each content and all contents with one shingle left out (two units for a
  segment of two shingles or more, since it then also finds one that differs by one).
* Shingles that many documents share have segments of their own, which
  a set indexes only if its other segments do not give more than H units; if all do
  not, it hashes anew twice, and last falls back on a prefix of its shingles in hash
  order. Of two similar sets, the one that needs fewer steps finds the other, which
  has taken those steps too. So the allocation follows cost and loses no pair.

Sets that meet in a small bucket are pairs, if their sizes allow it, and are compared by
parity sketches of about one bit a shingle, which two similar sets can differ in by at
most H bits. Sets that meet in a large bucket are linked to one of its classes, not to
each other; the components of those links are looked at in blocks of bounded size by
the same sketches. A few words that chance repeats thus cost pairs and join no components,
which would grow together as the corpus does. What sketches leave possible is joined
to components, which are verified exactly from the texts. In blocks, pairs already connected
are skipped and only links that connect leave a task. A very large component is cut
into cells by size and hash, and pairs of cells that may hold similar sizes are tasks
of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Columns, distinct, map_columns, map_groups, maybe_in, mix, shingle_set, small_batches
from stratamart.llm.components import FOREST_NODES, Forest, connected_components
from stratamart.operators.lookups import pin

SHINGLE = 5
SIMILAR = (3, 4)  # 0.75, as a fraction
# Common shingles: in so many documents of one stretch of a task's input, and in so many
# of all stretches that have them so often; the most frequent so many. Only costs depend on them.
COMMON_DOCS = 2
COMMON_TOTAL = 16
COMMON_MOST = 262_144
STRETCH_SHINGLES = 2_000_000
SMALL_BAND = 63
FLUSH_KEYS = 500_000
KEYS_PER_PART = 1_500_000
PARTS_PER_TASK = 8
SETTLE_KEYS = 500_000
BUCKET_PAIRED = 16  # classes of a bucket that are paired with each other
PAIRS_HELD = 500_000
BLOCK_SETS = 1024
BLOCK_SHINGLES = 2_000_000
_CELL_RATIO = 1.15
_CODE_RATIO = 1.05
_CODE_REACH = 7  # size codes further apart than this cannot be similar
_KEY_BYTES = 6

_U = np.uint64


def _class_of(shingles: np.ndarray) -> int:
    """56-bit hash of a whole set, and a code of its size in the last byte."""
    content = int(shingles.sum(dtype=_U)) + len(shingles) * 0x9E3779B97F4A7C15
    code = min(255, int(np.log(max(len(shingles), 1)) / np.log(_CODE_RATIO)))
    return int(mix(_U(content % (1 << 64))).view(np.int64)[0]) & ~255 | code


def _least_distance(n: int, m: int) -> int:
    a, b = SIMILAR
    return (b - a) * (n + m) // (a + b)


def _segments(tokens: np.ndarray, m: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the non-empty segments, their content sums and sizes, and of each token its segment and what it adds."""
    mixed = mix(tokens + _U(salt))
    segment = (mixed % _U(m)).astype(np.int64)
    sums = np.zeros(m, _U)
    np.add.at(sums, segment, mixed)
    sizes = np.bincount(segment, minlength=m)
    held = np.flatnonzero(sizes)
    return held, sums[held], sizes[held], segment, mixed


def _label(instance: int, step: int, segment: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return mix(sums + mix(segment.astype(_U) + _U(instance << 40) + _U(step << 32)))


def _keys_of(
    tokens: np.ndarray, m: int, instance: int, step: int, deletions: bool, need: int | None = None
) -> tuple[list[np.ndarray], int]:
    """Index keys of one hashing of some tokens into m segments, and the units they give.

    Of more units than ``need``, if given, the weakest keys are left out. The order is one
    of keys, so that what two sets have in common comes in the same order in both.
    """
    if not len(tokens):
        return [], 0
    held, sums, sizes, segment, added = _segments(tokens, m, 1 + step)
    keys = [_label(instance, step, held, sums)]
    if not deletions:
        if need is not None and len(held) > need:
            order = np.lexsort((keys[0], np.minimum(sizes, 3)))
            return [keys[0][order[len(held) - need :]]], need
        return keys, len(held)
    of = np.searchsorted(held, segment)
    more = sizes[of] > 1  # what is left is not empty
    left = sums[of] - added
    keys.append(_label(instance, step, segment[more], left[more]))
    return keys, int(np.minimum(sizes, 2).sum())


def index_keys(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Keys of a set; two different sets that are similar share one, whatever ``common`` holds."""
    n = len(shingles)
    a, b = SIMILAR
    largest = n * b // a
    if not n or not _least_distance(n, largest):
        return np.zeros(0, _U)
    band = n.bit_length() - 1
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        usual = common[at] == shingles
        rare, usual = shingles[~usual], shingles[usual]
    else:
        rare, usual = shingles, shingles[:0]
    found: list[np.ndarray] = []
    for instance in (band, band + 1) if largest >> (band + 1) else (band,):
        top = (1 << instance + 1) - 1
        need = _least_distance(n, min(top, largest)) + 1
        units_wanted = _least_distance(top, top) + 1
        small = top <= SMALL_BAND
        m = -(-units_wanted * 3 // 5) if small else -(-units_wanted * 29 // 20)
        # Only a set that needs no further step leaves out keys; one that does is found by all of them.
        keys, units = _keys_of(rare, m, instance, 0, small, need)
        found += keys
        if units < need:
            keys, more = _keys_of(usual, max(1, m // 4), instance, 1, small)
            found += keys
            units += more
        for step in (2, 3):
            if units < need:
                keys, units = _keys_of(shingles, m, instance, step, small)
                found += keys
        if units < need:
            prefix = np.sort(mix(shingles))[: n - -(-n * a // b) + 1]
            found.append(_label(instance, 4, np.zeros(len(prefix), np.int64), prefix))
    return distinct(np.concatenate(found))


def _class_rows(batches: Iterator[Columns]) -> Iterator[Columns]:
    """A row for each text, and rows of shingles that several sets of a stretch share, with their counts."""
    sets: dict[int, np.ndarray] = {}
    held = 0

    def blank(rows: int) -> list[None]:
        return [None] * rows

    def counted() -> Columns:
        values, counts = np.unique(np.concatenate([*sets.values(), np.zeros(0, _U)]), return_counts=True)
        often = counts >= COMMON_DOCS
        rows = int(often.sum())
        own = {"s": values[often].view(np.int64), "often": counts[often]}
        return {**{name: blank(rows) for name in ("doc_id", "text_key", "n", "c", "sketch")}, **own}

    for b in batches:
        rows = len(b["text"])
        out: Columns = {"doc_id": b["doc_id"], "text_key": b["text_key"], "n": [], "c": [], "sketch": [], "s": blank(rows), "often": blank(rows)}
        for text in b["text"]:
            s = shingle_set(text, SHINGLE)
            c = _class_of(s) if len(s) else None
            out["n"].append(len(s))
            out["c"].append(c)
            out["sketch"].append(_sketch(s).tobytes() if len(s) else None)
            if c is not None and c not in sets:
                sets[c] = s
                held += len(s)
            if held >= STRETCH_SHINGLES:
                yield counted()
                sets, held = {}, 0
        yield out
    yield counted()


def _key_rows(common: np.ndarray, parts: int):
    """Index keys with their classes, packed for each of ``parts`` ranges of keys.

    A key is cut to 6 bytes, which with its range tells keys apart well enough: keys that
    coincide only add a candidate. Classes are numbers into a list that goes along, or
    stand beside their keys where that is shorter.
    """

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        keys: list[np.ndarray] = []
        classes: list[np.ndarray] = []
        seen: set[int] = set()
        held = 0

        def out() -> Columns:
            k, c = np.concatenate(keys), np.concatenate(classes)
            part = (k >> _U(32)) % _U(parts)
            order = np.lexsort((k, part))
            k, c, part = k[order], c[order], part[order]
            cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            ends = np.r_[cut[1:], len(k)]
            rows: Columns = {"p": part[cut].astype(np.int64), "keys": [], "numbers": [], "classes": []}
            for i, j in zip(cut, ends):
                own, numbers = np.unique(c[i:j], return_inverse=True)
                numbers = numbers.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32)
                shorter = own.nbytes + numbers.nbytes < 8 * (j - i)  # than the class of each key
                rows["keys"].append(k[i:j].view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].tobytes())
                rows["numbers"].append(numbers.tobytes() if shorter else None)
                rows["classes"].append((own if shorter else c[i:j]).tobytes())
            return rows

        for b in batches:
            for text in b["text"]:
                s = shingle_set(text, SHINGLE)
                if len(s) and (c := _class_of(s)) not in seen:
                    seen.add(c)
                    k = index_keys(s, common)
                    keys.append(k)
                    classes.append(np.full(len(k), c, np.int64))
                    held += len(k)
                if held >= FLUSH_KEYS:
                    yield out()
                    keys, classes, seen, held = [], [], set(), 0
        if held:
            yield out()

    return run


def _pairs_of(keys: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Pairs of different classes that stand under the same key, both sorted, and whose sizes may be similar."""
    found = [np.zeros((0, 2), np.int64)]
    code = classes & 255
    for step in range(1, len(keys)):
        same = keys[step:] == keys[:-step]
        if not same.any():
            break
        near = np.flatnonzero(same & (np.abs(code[step:] - code[:-step]) <= _CODE_REACH))
        found.append(np.stack([classes[near + step], classes[near]], 1))
    return np.unique(np.concatenate(found), axis=0)


def _candidates(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Pairs of the classes of small buckets, and links (``large``) of those of large ones that connect.

    Goes through part after part. Keys are settled some at a time: a large bucket's classes are linked
    to its least, and a few are kept to tell that it is large.
    """
    keys, classes = np.zeros(0, _U), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    pairs: list[np.ndarray] = []
    forest = Forest()
    held, part = 0, None

    def settle() -> None:
        nonlocal keys, classes, waiting, held
        k, c = (np.concatenate(w) for w in zip((keys, classes), *waiting))
        order = np.lexsort((c, k))
        k, c = k[order], c[order]
        once = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]
        k, c = k[once], c[once]
        start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        sizes = np.diff(np.r_[start, len(k)])
        to = np.repeat(c[start], sizes)
        links = np.stack([c, to], 1)[np.repeat(sizes > BUCKET_PAIRED, sizes) & (c != to)]
        forest.add(*np.unique(links, axis=0).T.tolist())
        kept = np.arange(len(k)) - np.repeat(start, sizes) <= BUCKET_PAIRED
        keys, classes = k[kept], c[kept]
        waiting, held = [], 0

    def close() -> None:
        """Pair what is left in small buckets of the part that ends."""
        nonlocal keys, classes
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        sizes = np.diff(np.r_[start, len(keys)])
        few = np.repeat((sizes > 1) & (sizes <= BUCKET_PAIRED), sizes)
        pairs.append(_pairs_of(keys[few], classes[few]))
        keys, classes = keys[:0], classes[:0]

    def out(least_pairs: int = 1, least_nodes: int = 1) -> Iterator[Columns]:
        nonlocal pairs, forest
        if sum(map(len, pairs)) >= least_pairs:
            found = np.unique(np.concatenate(pairs), axis=0)
            yield {"a": found[:, 0], "b": found[:, 1], "large": np.zeros(len(found), bool)}
            pairs = []
        if len(forest) >= least_nodes:
            links = forest.links()
            yield {**links, "large": np.ones(len(links["a"]), bool)}
            forest = Forest()

    for b in batches:
        for p, packed, numbers, own in zip(b["p"], b["keys"], b["numbers"], b["classes"]):
            if p != part:
                if waiting:
                    settle()
                close()
                part = p
                yield from out(PAIRS_HELD, FOREST_NODES)
            n = len(packed) // _KEY_BYTES
            k = np.zeros((n, 8), np.uint8)
            k[:, :_KEY_BYTES] = np.frombuffer(packed, np.uint8).reshape(n, _KEY_BYTES)
            c = np.frombuffer(own, np.int64)
            if numbers is not None:
                c = c[np.frombuffer(numbers, np.uint16 if len(numbers) == 2 * n else np.uint32)]
            waiting.append((k.view(_U)[:, 0], c))
            held += n
            if held >= SETTLE_KEYS:
                settle()
                yield from out(PAIRS_HELD, FOREST_NODES)
    if waiting:
        settle()
    close()
    yield from out()


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each bit, with at least as many bits as shingles."""
    bits = 1 << max(6, len(shingles).bit_length())
    parity = (np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(parity).view(_U)


def _folded(sketches: list[np.ndarray], words: int) -> np.ndarray:
    """Sketches of this length or longer, folded to it; a fold keeps parities."""
    return np.stack([np.bitwise_xor.reduce(s.reshape(-1, words), axis=0) for s in sketches])


def _connect(order: list[int], size: np.ndarray, side: np.ndarray, sketches: list[np.ndarray], similar) -> list[tuple[int, int]]:
    """Links that connect a block's sets (in order of size): of side 0 with each other, or
    of side 0 with side 1. ``similar(i, j)`` decides on pairs the sketches leave."""
    a, b = SIMILAR
    cross = bool(side.any())
    group = np.arange(len(order))
    folded: dict[int, tuple[int, np.ndarray]] = {}
    links = []
    for i in range(len(order)):
        # Larger sets only, up to the largest that can be similar.
        end = int(np.searchsorted(size, size[i] * b // a, side="right"))
        open_ = group[i + 1 : end] != group[i]
        if cross:
            open_ &= side[i + 1 : end] != side[i]
        at = np.flatnonzero(open_)
        if not len(at):
            continue
        at += i + 1
        words = len(sketches[i])
        if words not in folded:  # sketches are as long or longer from here on
            folded[words] = i, _folded(sketches[i:], words)
        base, matrix = folded[words]
        differ = np.bitwise_count(matrix[at - base] ^ matrix[i - base]).sum(axis=1, dtype=np.int64)
        for j in at[differ <= (b - a) * (size[at] + size[i]) // (a + b)]:
            if group[j] != group[i] and similar(i, j):
                group[group == group[j]] = group[i]
                links.append((max(order[i], order[j]), min(order[i], order[j])))
    return links


def verify_block(classes: list[int], texts: list[str], sides: list[int]) -> list[tuple[int, int]]:
    """Links between the sets of a block that are similar, verified exactly."""
    a, b = SIMILAR
    sets: dict[int, np.ndarray] = {}
    side: dict[int, int] = {}
    for c, text, s in zip(classes, texts, sides):
        if c not in sets:
            shingles = shingle_set(text, SHINGLE)
            if len(shingles) and _class_of(shingles) == c:  # else another text under the same doc_id
                sets[c], side[c] = shingles, s
    order = sorted(sets, key=lambda c: (len(sets[c]), c))
    values = [sets[c] for c in order]

    def similar(i: int, j: int) -> bool:
        x, y = values[i], values[j]
        shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
        return b * shared >= a * (len(x) + len(y) - shared)

    size, sides_ = np.array([len(v) for v in values], np.int64), np.array([side[c] for c in order], np.int64)
    return _connect(order, size, sides_, [_sketch(v) for v in values], similar)


def _sieve(c: Columns) -> Columns:
    """Links between sets that their sketches leave possible."""
    rows = sorted({k: (n, k, s, sketch) for k, n, s, sketch in zip(c["c"], c["n"], c["side"], c["sketch"])}.values())
    sketches = [np.frombuffer(r[3], _U) for r in rows]
    size, side = np.array([r[0] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
    links = _connect([r[1] for r in rows], size, side, sketches, lambda i, j: True)
    return {"a": [x for x, _ in links], "b": [y for _, y in links]}


def _differing(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, folded to the shorter one."""
    if len(x) < len(y):
        x, y = y, x
    size, folded = len(x), int.from_bytes(x, "little")
    while size > len(y):
        size //= 2
        folded = (folded >> 8 * size) ^ (folded & (1 << 8 * size) - 1)
    return (folded ^ int.from_bytes(y, "little")).bit_count()


def _near_pairs(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Pairs that their sketches leave possible."""
    for b in batches:
        rows = zip(b["a"], b["b"], b["n1"], b["n2"], b["sketch1"], b["sketch2"])
        near = [(x, y) for x, y, n, m, one, two in rows if _differing(one, two) <= _least_distance(n, m)]
        yield {"a": [x for x, _ in near], "b": [y for _, y in near]}


def _verify(c: Columns) -> Columns:
    links = verify_block(c["c"], c["text"], c["side"])
    return {"a": [x for x, _ in links], "b": [y for _, y in links]}


def _blocks(members: DataFrame) -> DataFrame:
    """Deal the members of candidate components (``root, n, c`` and more) to blocks: adds ``block`` and ``side``."""
    whole = members.groupBy("root").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    large = whole.where(f"sets > {BLOCK_SETS} OR shingles > {BLOCK_SHINGLES}").select("root")
    own = [c for c in members.columns if c != "root"]
    alone = members.join(large, "root", "left_anti").select(
        *own, F.struct("root", F.lit(0).alias("g1"), F.lit(0).cast("long").alias("s1"), F.lit(0).alias("g2"), F.lit(0).cast("long").alias("s2")).alias("block"), F.lit(0).alias("side"),
    )
    g = F.floor(F.log("n") / F.log(F.lit(_CELL_RATIO))).cast("int")
    split = members.join(large, "root").withColumn("g", g)
    cut = split.groupBy("root", "g").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("cells")
    )
    cells = cut.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1))).drop("cells")
    # Sizes in cells further apart than this cannot be similar.
    reach = int(np.ceil(np.log(SIMILAR[1] / SIMILAR[0]) / np.log(_CELL_RATIO))) + 1
    one = cells.select("root", F.col("g").alias("g1"), F.col("s").alias("s1"), F.explode(F.sequence(F.col("g"), F.col("g") + reach)).alias("g2"))
    two = cells.select("root", F.col("g").alias("g2"), F.col("s").alias("s2"))
    pairs = one.join(two, ["root", "g2"]).where("g2 > g1 OR s2 >= s1").select("root", F.struct("root", "g1", "s1", "g2", "s2").alias("block"))
    ends = pairs.select("root", "block", F.col("block.g1").alias("g"), F.col("block.s1").alias("s"), F.lit(0).alias("side")).unionByName(
        pairs.where("block.g1 != block.g2 OR block.s1 != block.s2").select(
            "root", "block", F.col("block.g2").alias("g"), F.col("block.s2").alias("s"), F.lit(1).alias("side")
        )
    )
    placed = split.join(cut, ["root", "g"]).withColumn("s", F.pmod(F.xxhash64("c"), F.col("cells")))
    return alone.unionByName(placed.join(ends, ["root", "g", "s"]).select(*own, "block", "side"))


def _id(name: str):
    """A join key that nulls have as well."""
    return F.coalesce(F.col(name), F.lit(-(1 << 63)).cast("long"))


def _common_shingles(found: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent shingles, at most ``COMMON_MOST``, of the counts of all stretches.

    A histogram of their sums, of some hundred rows, gives the sum from which on they
    are few enough, so no more than are wanted reach the driver.
    """
    counts = found.groupBy("s").agg(F.sum("often").alias("n")).where(F.col("n") >= COMMON_TOTAL)
    counts, _ = pin(counts.withColumn("size", F.floor(8 * F.log2("n")).cast("int")), "jaccard-common")
    total, least, share = 0, 0, 1.0
    for size, n in sorted(counts.groupBy("size").count().collect(), reverse=True):
        if total + n > COMMON_MOST:
            share = (COMMON_MOST - total) / n  # of this size, by hash
            least = size
            break
        total += n
    by_hash = F.pmod(F.xxhash64("s"), F.lit(1 << 30)) < int(share * (1 << 30))
    usual = counts.where((F.col("size") > least) | ((F.col("size") == least) & by_hash)).select("s").collect()
    return np.sort(np.array([r["s"] for r in usual], np.int64).view(_U))


def similarity_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``, and ``text_key, first``.

    ``text_key`` is ``xxhash64`` of the text. ``first`` is true for one doc_id and text of
    each component, those of the smallest doc_id.

    ``component_id`` is the smallest doc_id reachable by links. Null, empty and
    word-free texts have no shingles, link with nothing and are their own component.
    A null doc_id takes part; a component of null ids alone has a null id. Rows that
    repeat a doc_id are rows of their own. An empty table gives no rows. Columns other
    than ``doc_id`` and ``text`` are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    told, _ = pin(map_columns(keyed, _class_rows, "doc_id long, text_key long, n long, c long, sketch binary, s long, often long"), "jaccard-classes")
    members = told.where("n IS NOT NULL").drop("s", "often")
    common = _common_shingles(told.where("s IS NOT NULL"))

    shingles = members.agg(F.sum("n")).first()[0] or 0
    parts = max(8, -(-shingles // KEYS_PER_PART))  # a set has about as many keys as shingles
    tasks = max(8, -(-parts // PARTS_PER_TASK))
    keys = map_columns(docs, _key_rows(common, parts), "p long, keys binary, numbers binary, classes binary")
    # By the number itself, so tasks are even. Sets that share many keys meet in many parts; a task keeps
    # a link that connects, and drops those that repeat it.
    dealt = keys.repartitionById(tasks, (F.col("p") % tasks).cast("int")).sortWithinPartitions("p")
    candidates, _ = pin(map_columns(dealt, _candidates, "a long, b long, large boolean"), "jaccard-candidates")
    pairs, _ = pin(candidates.where("NOT large").select("a", "b").distinct(), "jaccard-pairs")
    held = connected_components(candidates.where("large")).select(F.col("node").alias("c"), "root")
    held = held.unionByName(pairs.select(F.explode(F.array("a", "b")).alias("c"), F.lit(None).cast("long").alias("root")))
    # The least (id, text) of a class; null ids last.
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    classes = members.where("n > 0").groupBy("c").agg(F.min(place).alias("place"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sketched, _ = pin(held.groupBy("c").agg(F.max("root").alias("root")).join(classes, "c"), "jaccard-sketches")
    dealt, _ = pin(_blocks(sketched.where("root IS NOT NULL").drop("place")), "jaccard-sieve")
    sieved = map_groups(dealt.groupBy("block"), _sieve, "a long, b long")
    one, two = (sketched.select(F.col("c").alias(end), F.col("n").alias(f"n{i}"), F.col("sketch").alias(f"sketch{i}")) for i, end in ((1, "a"), (2, "b")))
    least, most = F.least("n1", "n2"), F.greatest("n1", "n2")
    compared = pairs.join(one, "a").join(two, "b").where(SIMILAR[1] * least >= SIMILAR[0] * most)
    sieved = sieved.unionByName(map_columns(compared, _near_pairs, "a long, b long"))
    clusters = connected_components(sieved).select(F.col("node").alias("c"), "root")

    blocks = _blocks(clusters.join(sketched.drop("root", "sketch"), "c"))
    row = [_id("doc_id").alias("_doc"), "text_key"]
    blocks, _ = pin(blocks.select("c", "block", "side", "place.*").select("c", "block", "side", *row), "jaccard-blocks")
    # Most documents are in no component; their texts need not be moved to find that out.
    wanted = maybe_in(blocks, "text_key")(F.col("text_key"))
    texts = keyed.where(wanted).select(*row, "text").dropDuplicates(["_doc", "text_key"]).join(blocks, ["_doc", "text_key"])
    links = map_groups(texts.select("block", "c", "side", "text").groupBy("block"), _verify, "a long, b long")
    joined = connected_components(links)

    # The least place of a class, then of its component.
    own = members.where("n > 0").groupBy("c").agg(F.min(place).alias("place"))
    linked = own.join(joined.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = linked.groupBy("root").agg(F.min("place").alias("first"))
    named, _ = pin(linked.join(least, "root").select("c", "first"), "jaccard-components")
    out = members.join(named, "c", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        "text_key",
        (F.col("n") == 0) | place.eqNullSafe(F.col("first")),
    ).toDF("doc_id", "n_shingles", "component_id", "text_key", "first")
