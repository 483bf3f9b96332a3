"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in alternation, ending with
the assistant. Over this automaton dynamic programming chooses, turn by turn, the cheapest of:
keeping the turn, merging it into the turn before (same role), giving it another role, and inserting
empty turns before it. What a turn does to the automaton depends on its role only, so a block of turns
is a small min-plus matrix: long conversations are split into blocks, the blocks' matrices are
chained per conversation, and each block is then repaired and rendered on its own.

Markers can't be forged: "<|" in a text is written as "<||", which plain() turns back.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm._common import cut

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
KEEP, MERGE, RELABEL, INSERT = 0, 1, 3, 2
UNKNOWN_ROLE = 1  # to give a role to a turn without a known one
BLOCK = 512


def _paths() -> dict[tuple[int, int], list[int]]:
    """Fewest empty turns that lead from one state to another."""
    found: dict[tuple[int, int], list[int]] = {(s, s): [] for s in range(4)}
    for _ in range(4):
        for (a, b), way in list(found.items()):
            for c in NEXT[b]:
                if (a, c) not in found or len(way) + 1 < len(found[a, c]):
                    found[a, c] = [*way, c]
    return found


PATHS = _paths()


def _moves(role: str | None) -> dict[tuple[int, int], tuple[int, str, list[int]]]:
    """(state before, state after) -> (cost, action, empty turns before), for a turn of this role."""
    own = ROLES.index(role) + 1 if role in ROLES else None
    best: dict[tuple[int, int], tuple[int, str, list[int]]] = {}

    def offer(a: int, b: int, cost: int, action: str, way: list[int]) -> None:
        if (a, b) not in best or cost < best[a, b][0]:
            best[a, b] = (cost, action, way)

    for a in range(4):
        if own is not None and a == own:
            offer(a, a, MERGE, "merge", [])
        for (x, mid), way in PATHS.items():
            if x == a:
                for b in NEXT[mid]:
                    change = UNKNOWN_ROLE if own is None else KEEP if b == own else RELABEL
                    offer(a, b, INSERT * len(way) + change, "keep" if b == own else "relabel", way)
    return best


MOVES = {role: _moves(role) for role in (*ROLES, None)}
FINISH = {s: (INSERT * len(way), way) for s in range(4) for way in [PATHS[s, ASSISTANT] if s else []]}


def _known(role: str | None) -> str | None:
    return role if role in ROLES else None


_MATRICES = {role: np.array([[moves[a, b][0] if (a, b) in moves else np.inf for b in range(4)] for a in range(4)]) for role, moves in MOVES.items()}


def chain(roles: list[str | None]) -> np.ndarray:
    """Least cost from each state before the turns to each state after them."""
    total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for role in roles:
        total = (total[:, :, None] + _MATRICES[_known(role)][None]).min(1)
    return total


def route(matrices: list[np.ndarray], start: int, end: int | None) -> list[int]:
    """States between the matrices on a cheapest way from start; to end, or to the cheapest finish."""
    costs = [np.where(np.arange(4) == start, 0.0, np.inf)]
    for m in matrices:
        costs.append((costs[-1][:, None] + m).min(0))
    last = costs[-1] + [FINISH[s][0] for s in range(4)]
    states = [int(last.argmin()) if end is None else end]
    for m, before in zip(reversed(matrices), reversed(costs[:-1]), strict=True):
        states.append(int((before + m[:, states[-1]]).argmin()))
    return states[::-1]


def repair(roles: list[str | None], start: int = START, end: int | None = None) -> list[tuple[int, str, int, int]]:
    """(turn or -1, action, state after, cost) in order; with end None it is brought to a legal finish."""
    states = route([_MATRICES[_known(r)] for r in roles], start, end)
    out: list[tuple[int, str, int, int]] = []
    for i, (a, b) in enumerate(pairwise(states)):
        cost, action, way = MOVES[_known(roles[i])][a, b]
        out += [(-1, "insert", s, INSERT) for s in way]
        out.append((i, action, b, cost - INSERT * len(way)))
    if end is None:
        out += [(-1, "insert", s, INSERT) for s in FINISH[states[-1]][1]]
    return out


def escaped(text: str) -> str:
    return text.replace("<|", "<||")


def plain(text: str) -> str:
    return text.replace("<||", "<|")


_NAMES = ["conv_id", "block", "place", "turn", "role_in", "role_out", "action", "cost", "rendered"]
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]
_SCHEMA = "conv_id long, block long, place int, turn long, role_in string, role_out string, action string, cost int, rendered string"


def _rendered(conv: int | None, block: int, turns: list[dict], enter: int, leave: int | None, first: bool, last: bool) -> Iterator[tuple]:
    """The pieces of a block, repaired; turns are dicts with turn, role and text."""
    steps = repair([x["role"] for x in turns], enter, None if last else leave)
    for place, (i, action, state, cost) in enumerate(steps):
        text, role = (escaped(turns[i]["text"]) if i >= 0 else ""), ROLES[state - 1]
        piece = f"\n\n{text}" if action == "merge" else f"{'' if first and not place else '<|end|>\n'}<|{role}|>\n{text}"
        piece += "<|end|>\n" if last and place == len(steps) - 1 else ""
        yield conv, block, place, turns[i]["turn"] if i >= 0 else None, turns[i]["role"] if i >= 0 else None, role, action, cost, piece


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 9, _KINDS, strict=True)], _NAMES)


def format_chats(turns: DataFrame, block: int = BLOCK, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Columns: conv_id, block, place, turn, role_in, role_out, action, cost, rendered.

    One row for each turn and each inserted turn; rendered pieces in the order (block, place) make the
    conversation's text. Turns are ordered by turn, then role and text's hash (so equal rows in either
    order); null turns come first, in the order of a hash of role and text. A null text is empty, a null or
    unknown role takes any legal one. Each row with a null conv_id is a conversation of its own, with null as
    its conv_id. An empty table gives no rows.
    """
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.lower(F.trim(F.col(role_col).cast("string"))).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The block follows from the turn's number, so no task has to order a whole conversation.
    # Turns without a number are many at times: their blocks are ranges of the hash that orders them.
    rows = rows.withColumn("tie", F.when(F.col("turn").isNull(), F.xxhash64("role", "text")).otherwise(F.xxhash64("text")))
    unnumbered = F.shiftright("tie", 52) - (1 << 60)
    orphans = rows.where("conv_id is null")
    rows = rows.where("conv_id is not null").withColumn("block", F.when(F.col("turn").isNull(), unnumbered).otherwise(F.floor(F.col("turn") / block).cast("long")))
    nth = F.when(F.col("turn").isNull(), F.col("tie")).otherwise(0).alias("nth")
    grouped = rows.groupBy("conv_id", "block")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chain([x["role"] for x in turns]).ravel().tolist() for turns in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["conv_id", "block", "costs"])

    ordered = grouped.agg(F.array_sort(F.collect_list(F.struct("turn", nth, "role", "tie"))).alias("turns"))
    costs = ordered.mapInArrow(measure, "conv_id long, block long, costs array<double>")

    def pass_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                states = route([np.array(x["costs"]).reshape(4, 4) for x in blocks], START, None)
                out += [(conv, x["block"], a, b, i == 0, i == len(blocks) - 1) for i, (x, a, b) in enumerate(zip(blocks, states, states[1:], strict=False))]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * 6, kinds, strict=True)], ["conv_id", "block", "enter", "leave", "first", "last"])

    chained = costs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "costs"))).alias("blocks"))
    ways = cut(chained.mapInArrow(pass_through, "conv_id long, block long, enter int, leave int, first boolean, last boolean"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _pieces([piece for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) for piece in _rendered(*row)])

    def render_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _pieces([piece for turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for piece in _rendered(None, 0, [{"turn": turn, "role": role, "text": text}], START, None, True, True)])

    texts = grouped.agg(F.array_sort(F.collect_list(F.struct("turn", nth, "role", "tie", "text"))).alias("turns"))
    both = texts.join(ways, ["conv_id", "block"])
    pieces = both.select("conv_id", "block", "turns", "enter", "leave", "first", "last").mapInArrow(render, _SCHEMA)
    return pieces.union(orphans.select("turn", "role", "text").mapInArrow(render_alone, _SCHEMA))
