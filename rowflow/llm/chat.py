"""Minimum-cost role repair of conversations.

A legal conversation is a path of an automaton whose state is the role of the last turn: an optional system
turn comes first, then user and assistant alternate, and an assistant turn ends it.  Every given turn is kept,
relabelled, or merged into the turn before it; empty turns may be inserted.  Dynamic programming finds
the cheapest way, and the repaired sequence is rendered.

The turns are sorted once over all tasks, by conversation and order of turns, and stored with their places; what
is equal in that order is dealt to tasks by a salt.  A chunk is a run of at most ``CHUNK`` places of one
conversation, whatever its turn numbers.  A chunk is summarised by the cheapest cost from
each state before it to each state after it; these small matrices, one row per chunk, are chained along the conversation to
find the states between the chunks, and then every chunk finds its own way between them.  So one long
conversation is the work of many tasks, and the result is the same as in one piece.  The rendered text stays one fragment per turn;
the fragments of a conversation in order are its rendering.

Ways are compared by cost, then turns put out, then their choices from the last turn on, so ties have one result.

Defined results: turns are ordered by turn number, null last, then role, then text, nulls last.  Rows with
the same turn number are separate turns; repeated rows follow each other and so are usually merged.  A null or unknown role can be given any
role at the cost ``UNKNOWN``.  A null text is empty.  Null conversation ids form one conversation.  An empty
table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
#: States: the role of the last turn, or that there is none yet.
STATES = ("", SYSTEM, USER, ASSISTANT)
ROLES = STATES[1:]

# Costs in whole units.
RELABEL, MERGE, INSERT, UNKNOWN = 4, 2, 3, 1

#: Turns per chunk.
CHUNK = 512
#: Characters of a text that say which task sorts it; a sample of them goes to the driver.
PREFIX = 512

_NEXT = {"": (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_FAR = 1 << 60

#: (cost, turns put out); compared in this order.
Cost = tuple[int, int]
NEVER: Cost = (_FAR, 0)


def _label_cost(given: str | None, role: str) -> int:
    return 0 if given == role else RELABEL if given in ROLES else UNKNOWN


def moves(given: str | None) -> list[tuple[int, int, int, int, str, str]]:
    """Ways to place a turn: (from state, to state, cost, turns put out, action, role inserted before)."""
    out = []
    for a, before in enumerate(STATES):
        for b, role in enumerate(STATES):
            if not role:
                continue
            label = _label_cost(given, role)
            act = "keep" if given == role else "relabel"
            if role in _NEXT[before]:
                out.append((a, b, label, 1, act, ""))
            if role == before:
                out.append((a, b, label + MERGE, 0, "merge", ""))
            out += [(a, b, label + INSERT, 2, act, x) for x in _NEXT[before] if role in _NEXT[x]]
    return out


_MOVES = {given: moves(given) for given in (*ROLES, None)}


def _moves_of(given: str | None) -> list[tuple[int, int, int, int, str, str]]:
    return _MOVES[given if given in ROLES else None]


def ending(state: int) -> tuple[int, int, str]:
    """Cost, turns and role of what is inserted after the last turn."""
    if STATES[state] in ("", ASSISTANT):
        return 0, 0, ""
    if STATES[state] == USER:
        return INSERT, 1, ASSISTANT
    return 2 * INSERT, 2, f"{USER},{ASSISTANT}"


def forward(given: Iterable[str | None], start: list[Cost]) -> tuple[list[Cost], list[list[tuple]]]:
    """Cheapest cost of each state after the turns, and the move that reaches each state after each turn."""
    cost, back = start, []
    for role in given:
        best: list[tuple] = [(NEVER, -1, -1)] * len(STATES)
        for number, (a, b, c, n, _, _) in enumerate(_moves_of(role)):
            if cost[a][0] < _FAR:
                best[b] = min(best[b], ((cost[a][0] + c, cost[a][1] + n), a, number)) if best[b][1] >= 0 else ((cost[a][0] + c, cost[a][1] + n), a, number)
        cost = [b[0] for b in best]
        back.append(best)
    return cost, back


def _from(state: int) -> list[Cost]:
    return [(0, 0) if s == state else NEVER for s in range(len(STATES))]


def _traced(back: list[list[tuple]], state: int) -> list[tuple[int, int]]:
    """The choices that lead to a state, (state before, move), last turn first."""
    way = []
    for best in reversed(back):
        _, before, number = best[state]
        way.append((before, number))
        state = before
    return way


def summary(given: list[str | None]) -> list[int]:
    """Cost, count and rank of a chunk's best way from every state to every state, flat.

    The rank orders the ways that end alike as one run over everything would: by the last choice, then the one before.
    """
    n = len(STATES)
    ways = [forward(given, _from(a)) for a in range(n)]
    flat = [x for cost, _ in ways for c in cost for x in (*c, 0)]
    for b in range(n):
        there = [a for a in range(n) if ways[a][0][b][0] < _FAR]
        for rank, a in enumerate(sorted(there, key=lambda a: _traced(ways[a][1], b))):
            flat[3 * (a * n + b) + 2] = rank
    return flat


def through(summaries: list[list[int]]) -> list[tuple[int, int, int, bool]]:
    """Per chunk: state before, state after, turns put out before, and whether it is the last."""
    n = len(STATES)
    cost: list[Cost] = [(0, 0)] + [NEVER] * (n - 1)
    back: list[list[int]] = []
    for flat in summaries:
        new, via, ways = [NEVER] * n, [-1] * n, [[] for _ in range(n)]
        for b in range(n):
            for a in range(n):
                c, put, rank = flat[3 * (a * n + b) : 3 * (a * n + b) + 3]
                if cost[a][0] < _FAR and c < _FAR:
                    ways[b].append((cost[a][0] + c, cost[a][1] + put, rank, a))
            if ways[b]:
                *whole, _, via[b] = min(ways[b])
                new[b] = tuple(whole)
        cost = new
        back.append(via)
    ends = [(cost[s][0] + ending(s)[0], cost[s][1] + ending(s)[1], s) for s in range(n) if cost[s][0] < _FAR]
    state = min(ends)[2]
    states = [state]
    for via in reversed(back):
        states.append(via[states[-1]])
    states.reverse()
    out, put = [], 0
    for k, flat in enumerate(summaries):
        a, b = states[k], states[k + 1]
        out.append((a, b, put, k + 1 == len(summaries)))
        put += flat[3 * (a * n + b) + 1]
    return out


def header(role: str) -> str:
    return f"<|{role}|>\n"


CLOSE = "<|end|>\n"


def place(turns: list[tuple[str | None, str | None]], before: int, after: int, put: int, last: bool) -> list[tuple]:
    """Per turn of a chunk: role, action, inserted roles, number of its turn, and its rendered fragment."""
    _, back = forward([r for r, _ in turns], _from(before))
    chosen = []
    for (given, _), (a, number) in zip(turns, reversed(_traced(back, after)), strict=True):
        move = _moves_of(given)[number]
        chosen.append((a, move[1], move))
    out = []
    for (_, text), (a, b, (_, _, _, count, action, inserted)) in zip(turns, chosen, strict=True):
        put += count
        role = STATES[b]
        if action == "merge":
            fragment = "\n" + (text or "")
        else:
            close = CLOSE if a else ""
            empty = header(inserted) + CLOSE if inserted else ""
            fragment = close + empty + header(role) + (text or "")
        out.append([role, action, inserted, put, fragment, ""])
    if last and out:
        _, _, roles = ending(after)
        out[-1][4] += CLOSE + "".join(header(r) + CLOSE for r in roles.split(",") if r)
        out[-1][5] = roles
    return [tuple(o) for o in out]


# -- the operator --------------------------------------------------------------------

_ORDER = ("__turn_last", "turn", "__role_last", "role", "__text_last", "text")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows that agree in the first columns, across batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _batches(rows: Iterator[tuple], schema: T.StructType, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

    for row in rows:
        held.append(row)
        if len(held) == 2048:
            yield batch()
            held = []
    if held:
        yield batch()


_SUMMARY = T.StructType().add("conv", "string").add("chunk", "long").add("flat", T.ArrayType(T.LongType()))
_PATH = T.StructType().add("conv", "string").add("chunk", "long").add("before", "integer").add("after", "integer").add("put", "long").add("last", "boolean")
REPAIRED = (
    T.StructType().add("conv", "string").add("turn", "long").add("given_role", "string").add("role", "string").add("action", "string")
    .add("inserted_before", "string").add("turn_out", "long").add("fragment", "string").add("inserted_after", "string")
)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((*key, summary([r[0] for r in group])) for key, group in _groups(batches, 2))
    return _batches(rows, _SUMMARY, [pa.string(), pa.int64(), pa.list_(pa.int64())])


def _thread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for (conv,), group in _groups(batches, 1):
            for (chunk, _), way in zip(group, through([flat for _, flat in group]), strict=True):
                yield (conv, chunk, *way)

    return _batches(rows(), _PATH, [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()])


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for (conv, _), group in _groups(batches, 2):
            before, after, put, last = group[0][3:]
            placed = place([(r[1], r[2]) for r in group], before, after, put, last)
            for (turn, given, *_), (role, action, inserted, out, fragment, end) in zip(group, placed, strict=True):
                yield conv, turn, given, role, action, inserted, out, fragment, end

    return _batches(rows(), REPAIRED, [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string()])


def _placed(turns: DataFrame, conv: str, turn: str, role: str, text: str, chunk: int) -> DataFrame:
    """The turns with their ``place`` in the order of all, and their chunk.

    Rows that agree in all of the order are alike, so a salt may part them.  Of texts longer than ``PREFIX`` that
    begin alike, all go to the one task that sorts them, on disk where need be.
    """
    rows = turns.select(
        F.coalesce(F.col(conv).cast("string"), F.lit("\0")).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.lower(F.col(role)).alias("role"),
        F.col(text).alias("text"),
    )
    ordered = rows.withColumns({f"__{c}_last": F.col(c).isNull() for c in ("turn", "role", "text")})
    salted = ordered.withColumns(
        {"__prefix": F.substring("text", 1, PREFIX), "__salt": F.when(F.coalesce(F.length("text"), F.lit(0)) <= PREFIX, F.rand(7)).otherwise(0.0)}
    )
    dealt = salted.repartitionByRange("conv", *_ORDER[:-1], "__prefix", "__salt").sortWithinPartitions("conv", *_ORDER)
    # Partition and row in it: the order of all rows, with jumps.
    numbered = stored(dealt.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("place")), "turns")
    return numbered.withColumn("chunk", F.call_function("div", F.col("place"), F.lit(chunk).cast("bigint")))


def repair_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """One row per given turn: its conversation (null as null), what became of it, and its fragment of the rendering."""
    ordered = _placed(turns, conv, turn, role, text, chunk)
    roles = ordered.select("conv", "chunk", "place", "role").repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place")
    summaries = stored(roles.select("conv", "chunk", "role").mapInArrow(_summarise, _SUMMARY), "summaries")
    path = summaries.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(_thread, _PATH)
    path = stored(path, "path")
    placed = ordered.join(path, ["conv", "chunk"]).repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place")
    repaired = placed.select("conv", "chunk", "turn", "role", "text", "before", "after", "put", "last").mapInArrow(_repair, REPAIRED)
    return repaired.select(F.when(F.col("conv") != "\0", F.col("conv")).cast(turns.schema[conv].dataType).alias(conv), *REPAIRED.names[1:])
