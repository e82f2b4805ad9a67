"""Chat formatting with shared beginnings: a prefix tree, written depth first.

Conversations are sorted by the hashes of their turns, so that those with the same
first turns stand together, and dealt to tasks by range of that order. A task reads
its conversations in order: the turns shared with the one before are already written,
so only the rest is. That is a depth-first walk of the prefix tree, with one path of
it in memory. The walk is cut into packs of bounded length; a pack repeats the shared
turns of its first conversation, so each pack can be read alone.

A pack is a text and its tree: each node is one turn with its place in the text, the
position of its first character in its conversation, and the intervals of the text it
may attend to before itself (its ancestors). Positions and intervals count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Columns, map_columns, small_batches

PACK_CHARS = 16_384
PACK_CONVERSATIONS = 1024
LOSS_ROLE = "assistant"

# Control strings of the template here and of other common templates.
# Each is an opening character and what must follow it.
_CONTROL = re.compile(r"([<\[])(\\*)(?=\||/s>|s>|INST\]|/INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=\||/s>|s>|INST\]|/INST\])")
_TURN = re.compile(r"<\|(.*?)\|>\n(.*?)<\|end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """One more backslash inside every control string, so none is left; reversible for every text."""
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("|", "%7C")


def _unescape_role(role: str) -> str:
    return unescape(role.replace("%7C", "|").replace("%25", "%"))


class _Pack:
    """The pack being written: its text, nodes, members and the current path."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.nodes: list[dict] = []
        self.members: list[dict] = []
        self.path: list[tuple[tuple[str, str], int]] = []

    def shared(self, turns: list[tuple[str, str]]) -> int:
        k = 0
        while k < len(turns) and k < len(self.path) and self.path[k][0] == turns[k]:
            k += 1
        return k

    def add(self, conv_id, turns: list[tuple[str, str]], rendered: list[tuple[str, int, int]], shared: int) -> None:
        del self.path[shared:]
        for turn, (text, content_start, content_end) in zip(turns[shared:], rendered):
            parent = self.path[-1][1] if self.path else -1
            start, end = self.length, self.length + len(text)
            above = self.nodes[parent] if self.path else None
            node = {
                "parent": parent, "role": turn[0], "start": start, "end": end,
                "position": above["position"] + above["end"] - above["start"] if above else 0,
                "loss_start": start + content_start if turn[0] == LOSS_ROLE else start,
                "loss_end": start + content_end if turn[0] == LOSS_ROLE else start,
                "ancestors": _joined(above["ancestors"], above["start"], above["end"]) if above else [],
            }
            self.path.append((turn, len(self.nodes)))
            self.nodes.append(node)
            self.parts.append(text)
            self.length = end
        self.members.append({"conv_id": conv_id, "leaf": self.path[-1][1]})


def _joined(intervals: list[dict], start: int, end: int) -> list[dict]:
    """Intervals with one more at the end, joined to the last where they touch."""
    if intervals and intervals[-1]["end"] == start:
        return [*intervals[:-1], {"start": intervals[-1]["start"], "end": end}]
    return [*intervals, {"start": start, "end": end}]


def render(role: str, text: str) -> tuple[str, int, int]:
    """Template of one turn, and where its (escaped) content starts and ends."""
    head, content = f"<|{_escape_role(role)}|>\n", escape(text)
    return f"{head}{content}<|end|>\n", len(head), len(head) + len(content)


_INTERVALS = "array<struct<start:int,end:int>>"
_NODE = f"struct<parent:int,role:string,start:int,end:int,position:int,loss_start:int,loss_end:int,ancestors:{_INTERVALS}>"
PACK_SCHEMA = f"text string, nodes array<{_NODE}>, members array<struct<conv_id:long,leaf:int>>"


def _write_packs(pack_chars: int, pack_conversations: int):
    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        pack = _Pack()

        def out(p: _Pack) -> Columns:
            return {"text": ["".join(p.parts)], "nodes": [p.nodes], "members": [p.members]}

        for b in batches:
            for conv_id, turns in zip(b["conv_id"], b["turns"]):
                turns = [(t["role"] or "", t["text"] or "") for t in turns]
                shared = pack.shared(turns)
                rendered = [render(*t) for t in turns[shared:]]
                if pack.members and (
                    pack.length + sum(len(r[0]) for r in rendered) > pack_chars or len(pack.members) >= pack_conversations
                ):
                    yield out(pack)
                    pack, shared = _Pack(), 0
                    rendered = [render(*t) for t in turns]
                pack.add(conv_id, turns, rendered, shared)
        if pack.members:
            yield out(pack)

    return run


def format_conversations(
    rows: DataFrame, pack_chars: int = PACK_CHARS, pack_conversations: int = PACK_CONVERSATIONS
) -> DataFrame:
    """Packs of all conversations of ``rows`` (``conv_id, turn, role, text``).

    A conversation is its rows by turn, ties by role and text, nulls first; rows that
    repeat are turns that repeat. Null roles and texts are empty; rows without a
    conv_id belong to no other row, so each is a conversation of one turn with a null id,
    however many there are. A pack has at most ``pack_chars``
    characters, except where one conversation alone is longer. Equal conversations
    are written once per pack and are all members. Other columns are not read. An
    empty table gives no rows.
    """
    small_batches(rows.sparkSession)
    turn = F.struct("turn", "role", "text")
    whole = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = whole.unionByName(rows.where("conv_id IS NULL").select("conv_id", F.array(turn).alias("turns")))
    hashes = F.transform("turns", lambda t: F.xxhash64(F.coalesce(t["role"], F.lit("")), F.coalesce(t["text"], F.lit(""))))
    ordered = whole.withColumn("_path", hashes)
    dealt = ordered.repartitionByRange("_path", "conv_id").sortWithinPartitions("_path", "conv_id")
    return map_columns(dealt.select("conv_id", "turns"), _write_packs(pack_chars, pack_conversations), PACK_SCHEMA)


def read_back(text: str, nodes: list[dict], leaf: int) -> tuple[str, list[tuple[str, str]], str]:
    """One conversation from its pack: formatted text, turns, and all text under the loss mask.

    The formatted text is what the last turn attends to, and itself.
    """
    node = nodes[leaf]
    spans = [*node["ancestors"], {"start": node["start"], "end": node["end"]}]
    formatted = "".join(text[s["start"] : s["end"]] for s in spans)
    masked = []
    while leaf >= 0:
        n = nodes[leaf]
        masked.append(unescape(text[n["loss_start"] : n["loss_end"]]))
        leaf = n["parent"]
    turns = [(_unescape_role(role), unescape(content)) for role, content in _TURN.findall(formatted)]
    return formatted, turns, "".join(reversed(masked))


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode("utf-8", "replace")).hexdigest()


def digests(packs: DataFrame) -> DataFrame:
    """One row per conversation, read back from its pack."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for b in batches:
            out: Columns = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, nodes, members in zip(b["text"], b["nodes"], b["members"]):
                seen: dict[int, tuple] = {}
                for m in members:
                    if m["leaf"] not in seen:
                        formatted, turns, loss = read_back(text, nodes, m["leaf"])
                        seen[m["leaf"]] = (
                            len(turns), _digest([x for role, t in turns for x in (role, "\n", t, "\n")]), len(loss),
                            _digest([loss]), len(formatted),
                        )
                    for key, value in zip(out, (m["conv_id"], *seen[m["leaf"]])):
                        out[key].append(value)
            yield out

    return map_columns(
        packs, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
