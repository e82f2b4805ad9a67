"""Cheapest repair of the turn structure of conversations, by prefix-doubling path ranking.

A repaired conversation is empty, or an optional system turn and then pairs of user and
assistant turns. Rows are kept, given another role or deleted, and empty turns inserted,
each at a cost. What has been written so far is one of four states, and a node is a row
and a state. Costs to the end come from a dynamic program; arcs that lose nothing
against them are the optimal ones. Among their paths the one of least audit (the letters
of its edits) is wanted. Nodes are ranked by their least audit of one letter, then of
two, four and so on: a rank of twice the length is a pair of ranks, the node's own and
that of the node its pointer leads to, and pointers double along. With ranks of whole
audits each node takes the arc of least letter and least rank behind it, and following
doubled pointers writes the path.

The work of a row on costs is a 4 x 4 matrix under minimum and addition, and so is that of
any stretch of rows. Conversations are cut into stretches of bounded size: a conversation
of a third of all rows is many of them, made and solved side by side. Only matrices
run backward through a conversation, and only states forward, one stretch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import Columns, map_columns, small_batches
from stratamart.operators.lookups import pin

STRETCH = 4096  # rows
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = "DIKR"  # in ASCII order, so codes compare as letters do
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
UNFINISHED = 3  # more, for a truncated row that stays
SPACES = " \t\n\x0b\x0c\r"

# States: nothing written yet, after the system turn, after a user turn, after an assistant turn.
_EXPECTED = np.array([2, 2, 3, 2])  # state after the turn that a state waits for
_ROLE = ("user", "user", "assistant", "user")  # that turn
# State after keeping a row whose role begins with s, u, a or anything else; -1 if it can't be kept.
_KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
_NEVER = 1 << 50
_GOOD, _BAD, _TRUNCATED = range(3)
_LEGAL = {(0, 1), (1, 2), (2, 1)}  # adjacent initials: su, ua, au


def _row_costs(initial: int, fault: int) -> np.ndarray:
    """Least cost of each edit of a row by state before it, and the state it leads to: [edit, state]."""
    cost = np.full((4, 4), _NEVER)
    cost[DELETE] = COST[DELETE]
    cost[INSERT] = COST[INSERT]
    if fault != _BAD:
        more = UNFINISHED if fault == _TRUNCATED else 0
        cost[REROLE] = COST[REROLE] + more
        cost[KEEP] = np.where(_KEPT[:, initial] >= 0, COST[KEEP] + more, _NEVER)
    return cost


def _inserted(costs: np.ndarray) -> np.ndarray:
    """Least costs when turns may be inserted before; ``costs`` has states last."""
    out = costs.copy()
    for _ in range(3):  # three turns bring back a state passed before
        out = np.minimum(out, COST[INSERT] + out[..., _EXPECTED])
    return out


def _matrix(initial: int, fault: int) -> np.ndarray:
    """[before, after]: least cost of a row, with turns inserted before it."""
    cost = _row_costs(initial, fault)
    m = np.full((4, 4), _NEVER)
    for q in range(4):
        for edit, to in ((DELETE, q), (REROLE, _EXPECTED[q]), (KEEP, _KEPT[q, initial])):
            if to >= 0:
                m[q, to] = min(m[q, to], cost[edit, q])
    return np.minimum(_inserted(m.T).T, _NEVER)


_COSTS = np.array([[_row_costs(i, f) for f in range(3)] for i in range(4)])
_MATRICES = np.array([[_matrix(i, f) for f in range(3)] for i in range(4)])
_END = _inserted(np.array([0, _NEVER, _NEVER, 0]))  # empty, or after an assistant turn


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), _NEVER)


def stretch_matrix(codes: np.ndarray) -> np.ndarray:
    """The product of the matrices of all rows; neighbours are multiplied until one is left."""
    m = _MATRICES[codes >> 2, codes & 3]
    while len(m) > 1:
        even = len(m) // 2 * 2
        m = np.concatenate([_times(m[0:even:2], m[1:even:2]), m[even:]])
    return m[0]


def costs_to_end(codes: np.ndarray, end: np.ndarray) -> np.ndarray:
    """[row, state]: least cost from before each row, and after the last, to the end."""
    m = _MATRICES[codes >> 2, codes & 3]
    step = 1
    while step < len(m):  # products of twice as many rows from each one on
        m = np.concatenate([_times(m[:-step], m[step:]), m[-step:]])
        step *= 2
    return np.concatenate([(m + end).min(axis=-1), end[None]])


def _optimal_arcs(codes: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[edit, node]: whether the arc is optimal, and where it leads. A node is 4 * row + state."""
    n = len(codes)
    row, state = np.repeat(np.arange(n), 4), np.tile(np.arange(4), n)
    initial = codes[row] >> 2
    own = _COSTS[initial, codes[row] & 3, :, state].T
    kept = _KEPT[state, initial]
    after = 4 * (row + 1)
    to = np.stack([after + state, 4 * row + _EXPECTED[state], after + kept, after + _EXPECTED[state]])
    possible = own < _NEVER
    to = np.where(possible, to, 0)
    flat = costs.ravel()
    return possible & (own + flat[to] == flat[: 4 * n]), to


def rank_paths(optimal: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Edit that begins the least audit of each node, and pointers along it by powers of two.

    The last four nodes are ends: they rank first and lead to themselves.
    """
    nodes = optimal.shape[1]
    ends = np.arange(nodes, nodes + 4)
    edit = np.argmax(optimal, axis=0)  # the least letter among the optimal arcs
    pointer = np.r_[to[edit, np.arange(nodes)], ends]
    rank = np.r_[edit + 1, np.zeros(4, np.int64)]
    pointers = [pointer]
    while (pointer < nodes).any():  # some audit is longer than what has been ranked
        pair = rank * (len(rank) + 5) + rank[pointer]
        rank = np.unique(pair, return_inverse=True)[1]
        pointer = pointer[pointer]
        pointers.append(pointer)
    # Least letter, then least rank of what follows. Optimal arcs of a node differ in letter here.
    following = np.where(optimal, np.arange(4)[:, None] * (len(rank) + 5) + rank[to], np.iinfo(np.int64).max)
    return np.argmin(following, axis=0), pointers


def _path(pointers: list[np.ndarray], start: int, nodes: int) -> np.ndarray:
    """Nodes from ``start`` up to an end, by pointers of growing length."""
    path = np.array([start])
    for pointer in pointers:
        path = np.concatenate([path, pointer[path]])
    return path[: int(np.argmax(path >= nodes)) + 1] if (path >= nodes).any() else path


def solve(codes: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[str], list[int]]:
    """Costs by state before the first row; the least audit and the last state of each."""
    costs = costs_to_end(codes, end)
    edits, pointers = rank_paths(*_optimal_arcs(codes, costs))
    audits, last = [], []
    for q in range(4):
        path = _path(pointers, q, len(edits))
        audits.append("".join(LETTERS[e] for e in edits[path[:-1]]))
        last.append(int(path[-1] - len(edits)))
    return costs[0], audits, last


def replay(audit: str, state: int, codes: list[int]) -> Iterator[tuple[int, str, str | None]]:
    """Row, letter and new role (None: its own) of each edit."""
    row = 0
    for letter in audit:
        yield row, letter, _ROLE[state] if letter in "IR" else None
        if letter in "IR":
            state = int(_EXPECTED[state])
        elif letter == "K":
            state = int(_KEPT[state, codes[row] >> 2])
        row += letter != "I"


def _numbered(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Sorted rows with their stretch (``part, at``) and their place in it."""
    context = TaskContext.get()
    part, at, i, before = context.partitionId() if context else 0, 0, 0, ()
    for b in batches:
        ats, places = [], []
        for conv in b["conv_id"]:
            if before == (conv,) and i < STRETCH:
                i += 1
            else:
                at += 1
                i = 1
            before = (conv,)
            ats.append(at)
            places.append(i - 1)
        yield b | {"part": [part] * len(ats), "at": ats, "i": places}


def _with_matrices(batches: Iterator[Columns]) -> Iterator[Columns]:
    for b in batches:
        yield b | {"matrix": [stretch_matrix(np.array(c, np.int64)).tobytes() for c in b["codes"]]}


def _with_ends(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Costs after each stretch, from the last stretch of a conversation to its first."""
    before, costs = (), _END
    for b in batches:
        out: Columns = {n: b[n] for n in ("conv_id", "part", "at", "codes")} | {"costs": [], "last": []}
        for conv, m in zip(b["conv_id"], b["matrix"]):
            last = before != (conv,)
            if last:
                before, costs = (conv,), _END
            out["costs"].append(costs.tobytes())
            out["last"].append(last)
            costs = (np.frombuffer(m, np.int64).reshape(4, 4) + costs).min(axis=-1)
        yield out


def _solved(batches: Iterator[Columns]) -> Iterator[Columns]:
    for b in batches:
        out: Columns = {n: b[n] for n in ("conv_id", "part", "at", "codes", "last")} | {"cost": [], "audits": [], "exits": []}
        for codes, end in zip(b["codes"], b["costs"]):
            cost, audits, exits = solve(np.array(codes, np.int64), np.frombuffer(end, np.int64))
            out["cost"].append(int(cost[0]))
            out["audits"].append(audits)
            out["exits"].append(exits)
        yield out


def _chosen(batches: Iterator[Columns]) -> Iterator[Columns]:
    """The audit of each stretch from the state its predecessor left, from first to last."""
    before, state, initial = (), 0, None
    for b in batches:
        out: Columns = {n: b[n] for n in ("conv_id", "part", "at", "codes")}
        out |= {n: [] for n in ("state", "audit", "cost", "illegal")}
        for conv, codes, last, cost, audits, exits in zip(b["conv_id"], b["codes"], b["last"], b["cost"], b["audits"], b["exits"]):
            first = before != (conv,)
            if first:
                before, state, initial = (conv,), 0, None
            initials = ([] if initial is None else [initial]) + [c >> 2 for c in codes]
            out["illegal"].append(sum(pair not in _LEGAL for pair in zip(initials, initials[1:])))
            initial = initials[-1]
            out["state"].append(state)
            out["cost"].append(cost if first else 0)
            state, audit = exits[state], audits[state]
            if last:  # turns that are lacking after the last row
                audit += {1: "II", 2: "I"}.get(state, "")
            out["audit"].append(audit)
        yield out


def _edits(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Every edit as a row: ``i`` is the row it applies to, or stands before; ``step`` orders edits."""
    for b in batches:
        for conv, part, at, state, audit, codes in zip(b["conv_id"], b["part"], b["at"], b["state"], b["audit"], b["codes"]):
            done = list(replay(audit, state, codes))
            yield {
                "conv_id": [conv] * len(done), "part": [part] * len(done), "at": [at] * len(done),
                "i": [d[0] for d in done], "step": list(range(len(done))),
                "edit": [d[1] for d in done], "new_role": [d[2] for d in done],
            }


def _fields(df: DataFrame, *names: str) -> str:
    return ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A report per conversation, and the repaired rows.

    ``conversations`` has ``conv_id`` (long), ``turn`` (long), ``role`` and ``text``. Rows stand by
    turn, nulls first; rows of one turn by role and then by the text's SHA-256. A null
    role or text counts as one space, and rows with a null conv_id are a conversation.
    Faults, of which a row's first counts: blank (no character but white space),
    duplicate (role and text seen earlier), truncated (does not end in ``.!?`` and white
    space). Blank rows and duplicates are deleted. A role counts by its first letter; one
    that is empty, or neither s, u nor a, cannot be kept. Texts are never cut, however long.

    The report has ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``, the
    repaired rows ``conv_id, part, at, step, role, text, edit``: ordered by ``part, at, step``
    within a conversation. A conversation that is repaired to nothing has a report and no
    rows; an empty table gives neither. Further columns are not read.
    """
    small_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.sha2("text", 256))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = _fields(rows, "conv_id", "turn", "role", "text", "digest") + ", part int, at long, i int"
    messages, _ = pin(map_columns(ordered, _numbered, schema), "repair-messages")

    ended = F.rtrim("text", F.lit(SPACES))
    place = F.struct("part", "at", "i")
    slim = messages.select(
        "conv_id", "role", "digest", "part", "at", "i", (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    first = slim.where("NOT blank").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    again, _ = pin(first.where("n > 1").select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first"), "repair-repeats")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    initial = F.substring("role", 1, 1)
    fault = F.when(F.col("blank"), "b").when(place > F.col("first"), "d").when(F.col("open"), "t").otherwise("")
    code = 4 * F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) + F.when(
        F.col("fault").isin("b", "d"), _BAD
    ).when(F.col("fault") == "t", _TRUNCATED).otherwise(_GOOD)
    judged = slim.join(again, same, "left").withColumn("fault", fault).select("conv_id", "part", "at", "i", "fault", code.alias("code"))

    def faults(kind: str) -> Column:
        return F.count_if(F.col("fault") == kind)

    in_order = F.array_sort(F.collect_list(F.struct("i", "code")))
    stretches, _ = pin(
        judged.groupBy("part", "at").agg(
            F.first("conv_id").alias("conv_id"), F.transform(in_order, lambda s: s["code"]).alias("codes"),
            faults("b").alias("blank"), faults("d").alias("duplicate"), faults("t").alias("truncated"),
        ),
        "repair-stretches",
    )
    base = "conv_id long, part int, at long, codes array<int>"
    made = map_columns(stretches.select("conv_id", "part", "at", "codes"), _with_matrices, f"{base}, matrix binary")
    backward = made.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("at"))
    ended_rows = map_columns(backward, _with_ends, f"{base}, costs binary, last boolean")
    solved = map_columns(ended_rows.repartition("part", "at"), _solved, f"{base}, last boolean, cost long, audits array<string>, exits array<int>")
    forward = solved.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    chosen, _ = pin(map_columns(forward, _chosen, f"{base}, state int, audit string, cost long, illegal long"), "repair-chosen")

    turns = messages.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    counted = stretches.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    written = F.array_sort(F.collect_list(F.struct("part", "at", "audit")))
    edited = chosen.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(written, lambda s: s["audit"]), "").alias("audit"),
    )
    report = turns
    for other in (counted, edited):
        o = other.withColumnRenamed("conv_id", "_conv")
        report = report.join(o, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    edits, _ = pin(
        map_columns(chosen, _edits, "conv_id long, part int, at long, i int, step int, edit string, new_role string").where("edit != 'D'"), "repair-edits"
    )
    stays = edits.where("edit != 'I'").drop("conv_id").join(messages.select("conv_id", "part", "at", "i", "role", "text"), ["part", "at", "i"])
    names = ["conv_id", "part", "at", "step"]
    repaired = stays.select(*names, F.coalesce("new_role", "role").alias("role"), "text", "edit").unionByName(
        edits.where("edit = 'I'").select(*names, F.col("new_role").alias("role"), F.lit("").alias("text"), "edit")
    )
    return report, repaired


def _hashed(batches: Iterator[Columns]) -> Iterator[Columns]:
    """SHA-256 of each conversation's ``role:text`` lines, read as a stream."""
    before, digest = (), None
    for b in batches:
        out: Columns = {"conv_id": [], "repaired_sha256": []}
        for conv, role, text in zip(b["conv_id"], b["role"], b["text"]):
            if before != (conv,):
                if digest is not None:
                    out["conv_id"].append(before[0])
                    out["repaired_sha256"].append(digest.hexdigest())
                before, digest = (conv,), hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield out
    if digest is not None:
        yield {"conv_id": [before[0]], "repaired_sha256": [digest.hexdigest()]}


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the repaired rows. A digest reads a conversation in order, so each is one stream."""
    lines = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at", "step")
    return map_columns(lines.select("conv_id", "role", "text"), _hashed, "conv_id long, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults of known places, by ``crc32("conv_id:turn") % 20``; nulls count as one space.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    def one_space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        "conv_id", "turn", one_space("role").alias("role"), one_space("text").alias("text"),
        (F.crc32(F.concat(one_space("conv_id"), F.lit(":"), one_space("turn"))) % 20).alias("hit"),
    ).where("hit != 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1))
    damaged = rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies))
    return damaged.drop("col")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """Every ``conv_id`` with the report on its damaged rows and the digest of their repair.

    A conversation of which no row is left has zeros, an empty audit and the digest of nothing.
    """
    report, repaired = repair(damage(conversations))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (report, digests(repaired)):
        p = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(p, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def oracle() -> str:
    """The same in SQL: damage by CRC-32 in bit arithmetic, and a forward program of four states."""
    spaces = " || ".join(f"chr({ord(c)})" for c in SPACES)

    def step(state: str, letter: str, cost: str, role: str | None) -> str:
        added = f"{state}.o" if role is None else f"CASE WHEN {state}.o IS NULL THEN {role} ELSE {state}.o || chr(10) || {role} END"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {added}}} END"

    def least(*options: str) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"

    def kept(state: str, initial: str, role: str) -> list[str]:
        stay = f"CASE WHEN x = '{initial}' AND NOT gone THEN {step(state, 'K', 'more', 'line')} END"
        other = f"CASE WHEN NOT gone THEN {step(state, 'R', '3 + more', repr(role + ':') + ' || text')} END"
        return [stay, other] if initial != "s" else [stay]

    def inserted(state: str, role: str) -> str:
        return step(state, "I", "3", repr(role + ":"))

    user = [o for s in ("s0", "s1", "s3") for o in kept(s, "u", "user")]
    return f"""
WITH RECURSIVE crc AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT),
      lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))) % 20 AS hit
  FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copy FROM crc WHERE hit <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    left(role, 1) AS x, rtrim(text, {spaces}) AS ended FROM damaged),
judged AS (SELECT *, role || ':' || text AS line, lag(x) OVER w AS before, CASE WHEN ended = '' THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
      WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
turns AS (SELECT conv_id, i, x, text, line, fault IN ('b', 'd') AS gone, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS more FROM judged),
start AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'o': NULL::VARCHAR}} AS s0 FROM conversations),
raw AS (SELECT conv_id, i, s0, NULL::STRUCT(c INTEGER, a VARCHAR, o VARCHAR) AS s1, {inserted("s0", "user")} AS s2 FROM start),
walk AS (
  SELECT conv_id, i, s0, s1, s2, {inserted("s2", "assistant")} AS s3 FROM raw
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {least("s3", inserted("s2", "assistant"))} FROM (
    SELECT conv_id, i, s0, s1, {least("s2", inserted("s0", "user"), inserted("s1", "user"), inserted("s3", "user"))} AS s2, s3 FROM (
      SELECT w.conv_id, t.i, {step("s0", "D", "4", None)} AS s0,
        {least(step("s1", "D", "4", None), *kept("s0", "s", ""))} AS s1,
        {least(step("s2", "D", "4", None), *user)} AS s2,
        {least(step("s3", "D", "4", None), *kept("s2", "a", "assistant"))} AS s3
      FROM walk w JOIN turns t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = w.i + 1))),
ended AS (SELECT conv_id, {least("s0", "s3")} AS best FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (i > 1 AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
  sha256(coalesce(best.o, '')) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
