"""Conversation repair against trying all edits, and its damage."""

from __future__ import annotations

import hashlib
import heapq
import random
import re

import numpy as np
import pytest

from stratamart.llm import conversation_repair as cr
from stratamart.llm.common import crc_fold

COLUMNS = "conv_id long, turn long, role string, text string, part int, at long, i int, code int, audit string, first string"
SHAPE = re.compile(r"(s?(ua)+)?\Z")


def plain(rows):
    """[(turn, role, text)] of one conversation -> report and digest, by best-first search over edits."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(cr.SPACES)
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    report = [max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in "bdt")]
    report.append(sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, written, lines = heapq.heappop(heap)
        if (i, written) in done:
            continue
        done.add((i, written))
        if i == len(rows) and SHAPE.match(written):
            return (*report, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[written[-1:]]
        for role in ("user", "assistant"):
            if role[0] in follow and len(written) < len(rows) + 3:
                heapq.heappush(heap, (cost + 3, audit + "I", i, written + role[0], (*lines, role + ":")))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, written, lines))
        if faults[i] in ("b", "d"):
            continue
        more = 3 * (faults[i] == "t")
        _, own, text = rows[i]
        for letter, role, price in (("K", own, 0), ("R", "user", 3), ("R", "assistant", 3)):
            if role and role[0] in follow:
                heapq.heappush(heap, (cost + price + more, audit + letter, i + 1, written + role[0], (*lines, f"{role}:{text}")))


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "x", "y") for r in rows], COLUMNS)
    report, repaired = cr.repair(df)
    digest = {r.conv_id: r.repaired_sha256 for r in cr.digests(repaired).collect()}
    empty = hashlib.sha256().hexdigest()
    return {r.conv_id: (*tuple(r)[1:], digest.get(r.conv_id, empty)) for r in report.collect()}


def made(seed, conversations=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            turn = rng.choice((t, t, t, t + 1, None))
            text = rng.choice(("Yes.", "No!", "Why?", "cut", "open \n", "end. \t", "", " ", None, f"long {t}."))
            rows.append((None if c == 0 else c, turn, rng.choice(("user", "assistant", "system", "user", "assistant", "tool", "", None)), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("stretch", [4096, 3, 1])
def test_equal_to_trying_all_edits(spark, monkeypatch, stretch):
    monkeypatch.setattr(cr, "STRETCH", stretch)
    rows = made(stretch)
    got = found(spark, rows)
    want = {c: plain([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def test_paths_of_long_stretches_follow_the_least_letters():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 500):
        codes = 4 * rng.integers(0, 4, n) + rng.integers(0, 3, n)
        costs, audits, _ = cr.solve(codes, cr._END)
        table = cr.costs_to_end(codes, cr._END)
        assert (costs == (cr.stretch_matrix(codes) + cr._END).min(axis=-1)).all()
        for q in range(4):
            state, row, paid, audit = q, 0, 0, ""
            while row < n:  # letter by letter, the least one that still allows the least cost
                own = cr._COSTS[codes[row] >> 2, codes[row] & 3, :, state]
                to = [(row + 1, state), (row, cr._EXPECTED[state]), (row + 1, cr._KEPT[state, codes[row] >> 2]), (row + 1, cr._EXPECTED[state])]
                e = next(e for e in range(4) if own[e] < cr._NEVER and own[e] + table[to[e]] == table[row, state])
                audit, paid, (row, state) = audit + cr.LETTERS[e], paid + own[e], to[e]
            assert audits[q] == audit and paid + cr._END[state] == costs[q]


def test_ranks_choose_between_arcs_of_one_letter():
    """Two arcs with the same letter: what follows decides. Nodes 0 to 3, then four ends."""
    optimal = np.zeros((4, 4), bool)
    to = np.zeros((4, 4), np.int64)
    optimal[2, 1], to[2, 1] = True, 4  # K to an end
    optimal[0, 2], to[0, 2] = True, 4  # D to an end
    optimal[1, 0], to[1, 0] = True, 1
    optimal[1, 3], to[1, 3] = True, 2
    edits, _ = cr.rank_paths(optimal, to)
    assert edits.tolist() == [1, 2, 0, 1]


def test_long_conversation_and_texts(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t} {'x' * (200_000 if t == 5 else 3)}.") for t in range(9000)]
    got = found(spark, [*rows, (2, 0, "user", "Hi.")])
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "K" * 9000)
    assert got[1][7] == hashlib.sha256("\n".join(f"{r[2]}:{r[3]}" for r in rows).encode()).hexdigest()
    assert got[2][5:7] == (3, "KI")


def test_empty_table(spark):
    assert found(spark, []) == {}
    nothing = spark.createDataFrame([], COLUMNS)
    assert cr.damaged_and_repaired(nothing).collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", f"Is it {c}? Yes. No!") for c in (None, *range(40)) for t in (None, 0, 1)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "x", "y") for r in rows], COLUMNS)
    got = sorted((tuple(r) for r in cr.damage(df).collect()), key=str)
    want = []
    for c, t, role, text in rows:
        hit = crc_fold(f"{' ' if c is None else c}:{' ' if t is None else t}", 20)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        want += [(c, t, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    assert got == sorted(want, key=str) and len(want) != len(rows)
    every = cr.damaged_and_repaired(df)
    assert sorted(r.conv_id for r in every.collect() if r.conv_id is not None) == list(range(40))


def test_all_rows_dropped(spark):
    gone = next(c for c in range(1000) if crc_fold(f"{c}:0", 20) == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.", 1, 2, 3, 4, "x", "y")], COLUMNS)
    assert [tuple(r) for r in cr.damaged_and_repaired(df).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
