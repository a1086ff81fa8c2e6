"""Minimum-cost repair of chat roles, and rendering of the repaired turns.

A legal conversation is an optional system message, then user and assistant messages in turn, from a user's to an
assistant's. Each turn may be kept, relabelled, merged into the message before, or preceded by an empty message; a
dynamic programme over the automaton of legal turns finds the cheapest repair.

Turns are range-sorted, so a conversation may lie in several partitions: each partition's part of it is then summed up
as a matrix of least costs from state to state. The matrices (two at most for each partition) are multiplied up on the
driver, which fixes the states at the partition borders; the turns between are repaired on the executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import materialize, partitions

ROLES = ("system", "user", "assistant")
SYSTEM, USER, ASSISTANT = range(3)
START = 3
#: Other names of the roles.
ALIASES = {"human": USER, "prompter": USER, "customer": USER, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT, "chatbot": ASSISTANT, "developer": SYSTEM} | {r: k for k, r in enumerate(ROLES)}
UNKNOWN = 3
#: Costs of a relabelled turn, of one whose role was no role, of a merge, and of an empty message.
RELABEL, NAME, MERGE, INSERT = 3, 1, 2, 4
#: Messages that may follow each state at once, and the empty messages that make others legal.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FILL = {(START, ASSISTANT): (USER,), (SYSTEM, ASSISTANT): (USER,), (USER, USER): (ASSISTANT,), (ASSISTANT, ASSISTANT): (USER,)}
#: Empty messages that end a conversation in each state.
CLOSE = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
SEPARATOR, FAR = "\n\n", 1 << 40


def role_number(role: str | None) -> int:
    return ALIASES.get((role or "").strip().lower(), UNKNOWN)


def _moves(role: int) -> list[tuple[int, int, int, bool, tuple[int, ...]]]:
    """(from, to, cost, merged, empty messages before) of a turn of this role; at equal cost the first is taken."""
    out = []
    for to in sorted(range(3), key=lambda r: (r != role, r)):
        label = 0 if to == role else NAME if role == UNKNOWN else RELABEL
        for at in range(4):
            if to in LEGAL[at]:
                out.append((at, to, label, False, ()))
            if at == to:
                out.append((at, to, label + MERGE, True, ()))
            if (at, to) in FILL:
                out.append((at, to, label + INSERT * len(FILL[at, to]), False, FILL[at, to]))
    return sorted(out, key=lambda m: m[2])


MOVES = [_moves(r) for r in range(4)]
STEP = np.full((4, 4, 4), FAR, dtype=np.int64)
for _r in range(4):
    for _m in reversed(MOVES[_r]):
        STEP[_r, _m[0], _m[1]] = _m[2]
END = np.array([INSERT * len(CLOSE[s]) for s in range(4)], dtype=np.int64)


def matrix(roles: np.ndarray) -> np.ndarray:
    """Least cost from each state to each over the turns."""
    out = np.where(np.eye(4, dtype=bool), 0, FAR)
    for r in roles.tolist():
        out = np.minimum(FAR, (out[:, :, None] + STEP[r][None]).min(axis=1))
    return out


def best_moves(roles: list[int], first: int = START, last: int | None = None) -> list[tuple[int, int, int, bool, tuple[int, ...]]]:
    """The moves of the cheapest repair from state ``first``, to state ``last`` (or to any, and its closing)."""
    cost, back = [FAR] * 4, []
    cost[first] = 0
    for r in roles:
        new, via = [FAR] * 4, [None] * 4
        for m in MOVES[r]:
            if (c := cost[m[0]] + m[2]) < new[m[1]]:
                new[m[1]], via[m[1]] = c, m
        cost = new
        back.append(via)
    at = last if last is not None else min(range(4), key=lambda s: cost[s] + END[s])
    out = []
    for via in reversed(back):
        out.append(via[at])
        at = via[at][0]
    return out[::-1]


def fix_borders(parts: list[dict]) -> dict[int, dict]:
    """From each partition's first and last conversation and their matrices, the states at the borders.

    For each partition: ``first`` (state in which its first turns begin), ``first_end`` and ``last_end`` (states that
    the parts which go on in the next partition must reach, else None).
    """
    parts = sorted(parts, key=lambda p: p["part"])
    out = {p["part"]: {"first": START, "first_end": None, "last_end": None} for p in parts}
    k = 0
    while k < len(parts):
        chain = [(parts[k], "last")]
        j = k
        while j + 1 < len(parts) and parts[j + 1]["first_key"] == parts[j]["last_key"]:
            j += 1
            chain.append((parts[j], "first"))
            if not parts[j]["single"]:
                break
        if len(chain) > 1:
            costs = [np.where(np.arange(4) == START, 0, FAR)]
            for p, which in chain:
                m = np.array(p["single_m"] if p["single"] else p[f"{which}_m"]).reshape(4, 4)
                costs.append(np.minimum(FAR, (costs[-1][:, None] + m).min(axis=0)))
            at = int((costs[-1] + END).argmin())
            for i in range(len(chain) - 1, 0, -1):
                p, which = chain[i]
                m = np.array(p["single_m"] if p["single"] else p[f"{which}_m"]).reshape(4, 4)
                at = int((costs[i] + m[:, at]).argmin())
                out[p["part"]]["first"] = at
                before = chain[i - 1][0]
                out[before["part"]]["last_end"] = at
                if before["single"]:
                    out[before["part"]]["first_end"] = at
        k = max(j, k + 1)
    return out


SORTED = "conv_id long, turn long, role string, text string, part int, pos long"
SUMMARY = "part int, first_key string, last_key string, single boolean, first_m array<long>, last_m array<long>, single_m array<long>"
REPAIRED = "conv_id long, turn long, action string, role string, cost int, piece string"


def _key(c) -> str:
    return "null" if c is None else str(c)


def _parts(batches):
    """(part, columns as lists) of the rows of each sorted partition, which come together; one at a time is held."""
    held, part = [], None
    for b in batches:
        nr = b.column(b.num_columns - 1).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(nr)) + 1).tolist(), len(nr)] if len(nr) else [0]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and nr[lo] != part:
                yield part, [sum((x.column(k).to_pylist() for x in held), []) for k in range(b.num_columns)]
                held = []
            part = int(nr[lo])
            held.append(b.slice(lo, hi - lo))
    if held:
        yield part, [sum((x.column(k).to_pylist() for x in held), []) for k in range(held[0].num_columns)]


def _stretches(keys: list[str]) -> list[tuple[int, int]]:
    """[from, to) of each conversation's turns."""
    out, at = [], 0
    for k in range(1, len(keys) + 1):
        if k == len(keys) or keys[k] != keys[at]:
            out.append((at, k))
            at = k
    return out


def _sum_up(batches):
    out = []
    for part, columns in _parts(batches):
        keys, roles = [_key(c) for c in columns[0]], np.array([role_number(r) for r in columns[1]], dtype=np.int64)
        found = _stretches(keys)
        first, last = (matrix(roles[a:b]).ravel().tolist() for a, b in (found[0], found[-1]))
        out.append({"part": part, "first_key": keys[0], "last_key": keys[-1], "single": len(found) == 1, "first_m": first, "last_m": last, "single_m": first})
    yield pa.RecordBatch.from_pylist(out, schema=SUMMARY_ARROW)


SUMMARY_ARROW = pa.schema([("part", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()), ("single", pa.bool_()), *((f"{n}_m", pa.list_(pa.int64())) for n in ("first", "last", "single"))])


def head(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


TAIL = "<|end|>\n"


def rendered(moves, texts: list[str], first: int, ends: bool) -> list[str]:
    """What each turn adds to the rendered sequence; a message is closed by what follows it."""
    out, at = [], first
    for (_, to, _, merged, fill), text in zip(moves, texts):
        piece = SEPARATOR + text if merged else ("" if at == START else TAIL) + "".join(head(r) + TAIL for r in fill) + head(to) + text
        out.append(piece)
        at = to
    if ends and out:
        out[-1] += TAIL + "".join(head(r) + TAIL for r in CLOSE[at])
    return out


def action(role: int, move) -> str:
    _, to, _, merged, fill = move
    steps = [f"insert {ROLES[r]}" for r in fill] + (["relabel"] if to != role else []) + (["merge"] if merged else [])
    return ", ".join(steps) or "keep"


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, action, role, cost, piece`` for each turn, with its repaired role and what it adds to the sequence.

    A conversation's pieces in order of turn make its rendered sequence; the closing of the last message, and empty
    messages after it, are in the last turn's piece. Turns that repeat a number are ordered by role and a hash of the text, null turns
    come first, null texts are empty, null and unknown roles are relabelled at a lower cost, and turns without conv_id
    are one conversation. An empty table gives an empty result; other columns are ignored.
    """
    spark = conversations.sparkSession
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    hashed = F.xxhash64("text")

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(at, at + b.num_rows))], names=[*b.schema.names, "part", "pos"])
            at += b.num_rows

    n = max(partitions(spark), 4 * conversations.rdd.getNumPartitions())
    ranged = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, *order[:3], hashed, "__tie").drop("__tie")
    placed = materialize(ranged.sortWithinPartitions(*order[:3], hashed).mapInArrow(number, SORTED), "sorted")
    again = lambda *c: placed.select(*c, "pos", "part").repartition(n, "part").sortWithinPartitions("part", "pos")
    parts = [r.asDict() for r in again("conv_id", "role").mapInArrow(_sum_up, SUMMARY).collect()]
    # At most one entry for each partition.
    borders = spark.sparkContext.broadcast(fix_borders(parts))

    def run(batches):
        for part, (ids, turns, roles, texts, *_) in _parts(batches):
            numbers = [role_number(r) for r in roles]
            border, found = borders.value[part], _stretches([_key(c) for c in ids])
            for k, (a, b) in enumerate(found):
                first = border["first"] if k == 0 else START
                last = border["last_end"] if k == len(found) - 1 else None
                moves = best_moves(numbers[a:b], first, last)
                cost = [m[2] for m in moves]
                acts = [action(r, m) for r, m in zip(numbers[a:b], moves)]
                if last is None:
                    cost[-1] += int(END[moves[-1][1]])
                    acts[-1] += "".join(f", append {ROLES[r]}" for r in CLOSE[moves[-1][1]])
                pieces = rendered(moves, texts[a:b], first, last is None)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((ids[a:b], pa.int64()), (turns[a:b], pa.int64()), (acts, pa.string()), ([ROLES[m[1]] for m in moves], pa.string()), (cost, pa.int32()), (pieces, pa.string()))], ["conv_id", "turn", "action", "role", "cost", "piece"])

    return again(*order).mapInArrow(run, REPAIRED)
