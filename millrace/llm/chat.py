"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation,
ending with the assistant. An automaton has the states start, system, user and assistant. For
every given turn, arcs lead from state to state: keep the turn, merge it into the turn before
(same role), relabel it, relabel and merge it, or first insert an empty turn and then keep or
relabel it. Dynamic programming finds the cheapest way through all turns; the end may insert an
empty assistant turn. No text is ever dropped or reordered.

The result has one row for each given turn: what was done and the text to append. The pieces of
a conversation, in the order of their position in it (from 0), are its rendering. ``render`` joins them, in parts where
conversations are long.

Turns are sorted by (conversation, turn) into ranges, so a conversation of any length spreads
over partitions. Of each range, only the first and the last conversation can go on elsewhere. For
these a 4 x 4 cost matrix (entry state to exit state) and the number of turns are taken; the driver chains the matrices, at
most two a partition, backwards to costs-to-go; a second pass finds where each entry state then
leads, and the driver chains these forwards to the entry states. Going forwards with exact
costs-to-go and a fixed order among equals makes the result independent of the partitions.

Null and odd cases: a null conversation id is a conversation; a null turn comes first; equal
turns are ordered by role, then the text's first 64 characters, its checksum and the whole text; repeated rows are turns of their own; a null text is empty;
roles are read without case and spaces, with usual synonyms, and any other role (or null) must be
relabelled; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import shared_dir

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: Names under which the three roles occur.
SYNONYMS = {"system": 1, "developer": 1, "user": 2, "human": 2, "prompter": 2, "assistant": 3, "model": 3, "gpt": 3, "bot": 3, "ai": 3}
#: What an edit costs. Relabelling an unknown role is cheaper than relabelling a known one.
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 2, 7, 1, 4
FAR = 1 << 60
#: Characters of a text that stand in the order before its checksum.
HEAD = 64
#: Which role may follow a state.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
SCHEMA = T.StructType(
    [
        T.StructField("turn", T.LongType()),
        T.StructField("role_in", T.StringType()),
        T.StructField("role_out", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("cost", T.IntegerType()),
        T.StructField("piece", T.StringType()),
        T.StructField("position", T.LongType()),
    ]
)


def _arcs() -> dict[int, list[list[tuple]]]:
    """For each given role (0: unknown) and state: [(cost, action, inserted role or 0, state after)], best first."""
    out: dict[int, list[list[tuple]]] = {}
    for given in range(4):
        out[given] = []
        for state in range(4):
            found: dict[int, tuple] = {}
            relabel = RELABEL if given else RELABEL_UNKNOWN
            options = []
            for role in (SYSTEM, USER, ASSISTANT):
                change, verb = (0, "keep") if role == given else (relabel, "relabel")
                if role in NEXT[state]:
                    options.append((change, verb, 0, role))
                if role == state:
                    options.append((MERGE + change, "merge" if not change else "relabel+merge", 0, role))
                for between in NEXT[state]:
                    if role in NEXT[between]:
                        options.append((INSERT + change, f"insert+{verb}", between, role))
            for o in sorted(options, key=lambda o: (o[0], o[2], o[3], o[1])):
                found.setdefault(o[3], o)
            out[given].append(sorted(found.values(), key=lambda o: (o[0], o[2], o[3])))
    return out


ARCS = _arcs()
#: What it costs to end in a state; after a system turn a user and an assistant turn are missing.
END = (0, 2 * INSERT, INSERT, 0)


def role_code(role: str | None) -> int:
    return SYNONYMS.get((role or "").strip().lower(), 0)


def costs_to_go(codes: list[int], after: tuple[int, ...] = END) -> list[tuple[int, ...]]:
    """Least cost from each state before each turn; the last entry is ``after``."""
    out = [after]
    for given in reversed(codes):
        nxt = out[-1]
        out.append(tuple(min(cost + nxt[to] for cost, _, _, to in arcs) for arcs in ARCS[given]))
    return out[::-1]


def walk(codes: list[int], state: int, to_go: list[tuple[int, ...]]) -> Iterator[tuple]:
    """The cheapest arcs from ``state`` on, the first among equals."""
    for i, given in enumerate(codes):
        arc = min(ARCS[given][state], key=lambda a: a[0] + to_go[i + 1][a[3]])
        yield arc
        state = arc[3]


def exits(codes: list[int], after: tuple[int, ...]) -> list[int]:
    """Where each entry state leads, given what follows."""
    to_go = costs_to_go(codes, after)
    out = []
    for state in range(4):
        for arc in walk(codes, state, to_go):
            state = arc[3]
        out.append(state)
    return out


def matrix(codes: list[int]) -> list[list[int]]:
    """Least cost from entry state to exit state."""
    columns = [costs_to_go(codes, tuple(0 if s == end else FAR for s in range(4)))[0] for end in range(4)]
    return [[min(columns[end][state], FAR) for end in range(4)] for state in range(4)]


def _open(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


CLOSE = "<|end|>\n"


def pieces(arcs: list[tuple], texts: list[str], state: int, last: bool) -> Iterator[str]:
    """The text that each turn adds; the last closes the conversation."""
    for i, ((_, action, inserted, to), text) in enumerate(zip(arcs, texts, strict=True)):
        out = ""
        if "merge" in action:
            out += "\n\n"
        else:
            if state != START:
                out += CLOSE
            if inserted:
                out += _open(inserted) + CLOSE
            out += _open(to)
        out += text
        state = to
        if last and i == len(texts) - 1:
            out += CLOSE + ("".join(_open(r) + CLOSE for r in {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(to, ())))
        yield out


def _runs(batches: Iterator[pa.RecordBatch], text: bool) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conversation, its rows in this partition) in order."""
    cols = ("conv", "turn", "role", "text") if text else ("conv", "role")
    rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in cols), strict=True))
    return itertools.groupby(rows, key=lambda r: r[0])


def _edges(batches: Iterator[pa.RecordBatch], after: dict | None) -> Iterator[pa.RecordBatch]:
    """One row for the first and for the last conversation of this partition: its cost matrix and length, or,
    once ``after`` has the costs that follow each of them, its exits."""
    part = TaskContext.get().partitionId()
    found: list[tuple] = []
    for i, (conv, rows) in enumerate(_runs(batches, False)):
        codes = bytes(role_code(r[1]) for r in rows)
        found = [*found[:1], (i, conv, codes)] if i else [(i, conv, codes)]
    out = []
    for j, (i, conv, codes) in enumerate(found):
        if after is None:
            out.append((part, j, "" if conv is None else f"={conv}", [*(c for row in matrix(list(codes)) for c in row), len(codes)]))
        elif (part, j) in after:
            out.append((part, j, "" if conv is None else f"={conv}", exits(list(codes), after[part, j])))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) if k < 3 else pa.array(c, pa.list_(pa.int64())) for k, c in enumerate(zip(*out, strict=True))], names=["part", "j", "conv", "v"])


def _repair(batches: Iterator[pa.RecordBatch], entry: dict, after: dict, ahead: dict) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    first = next(batches, None)
    if first is None:
        return
    types = (first.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64())

    def packed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["conv", *SCHEMA.names])
        out.clear()
        return batch

    groups = _runs(itertools.chain([first], batches), True)
    held = next(groups, None)
    i = 0
    while held is not None:
        conv, rows = held[0], list(held[1])
        held = next(groups, None)
        j = 0 if i == 0 else 1 if held is None else None  # the last of several has the second place
        codes = [role_code(r[2]) for r in rows]
        state = entry.get((part, j), START)
        follows = after.get((part, j), END)
        to_go = costs_to_go(codes, follows)
        arcs = list(walk(codes, state, to_go))
        position = ahead.get((part, j), 0)
        goes_on = (part, j, "on") in after
        costs = [arc[0] for arc in arcs]
        if not goes_on:
            costs[-1] += END[arcs[-1][3]]
        for r, arc, cost, piece in zip(rows, arcs, costs, pieces(arcs, [r[3] or "" for r in rows], state, not goes_on), strict=True):
            out.append((conv, r[1], r[2], ROLES[arc[3]], arc[1], cost, piece, position))
            position += 1
            if len(out) >= 4096:
                yield packed()
        i += 1
    if out:
        yield packed()


def _chain(spans: list[tuple]) -> list[list[tuple]]:
    """Runs of neighbouring stretches of one conversation. spans: (part, j, conv, v), in order."""
    runs: list[list[tuple]] = []
    for s in spans:
        if runs and runs[-1][-1][2] == s[2] and runs[-1][-1][0] != s[0]:
            runs[-1].append(s)
        else:
            runs.append([s])
    return [r for r in runs if len(r) > 1]


def _ordered(conversations: DataFrame, per_part: int) -> DataFrame:
    """Rows in conversation order, in ranges, kept in the shared folder so that every pass sees the same ranges."""
    shared_dir(conversations.sparkSession)
    spark = conversations.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    rows = conversations.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // per_part + 1)
    # of a text only its start and checksum stand in the order of ranges: sampling long texts would be dear
    head, check = F.substring("text", 1, HEAD), F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    order: list[Column] = [c.asc_nulls_first() for c in (F.col("conv"), F.col("turn"), F.col("role"), head, check)]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, F.col("text").asc_nulls_first()).checkpoint()


def repair(conversations: DataFrame, per_part: int = 200_000) -> DataFrame:
    """conv_id, turn, role_in, role_out, action, cost, piece, position of every given turn. The position in the
    conversation, from 0, depends on the data alone."""
    rows = _ordered(conversations, per_part)
    kind = rows.schema["conv"].dataType
    edge = "part long, j long, conv string, v array<long>"

    def edges(after: dict | None) -> list[tuple]:
        got = rows.select("conv", "role").mapInArrow(lambda it: _edges(it, after), edge).collect()  # at most two a partition
        return sorted(tuple(r) for r in got)

    after: dict = {}
    entry: dict = {}
    ahead: dict = {}
    chains = _chain(edges(None))
    for chain in chains:
        follows: tuple[int, ...] = END
        for (part, j, *_), n in zip(chain, itertools.accumulate((v[16] for *_, v in chain), initial=0), strict=False):
            ahead[part, j] = n
        for part, j, _, v in reversed(chain):
            after[part, j] = follows
            if (part, j) != chain[-1][:2]:
                after[part, j, "on"] = True
            follows = tuple(min(v[4 * s + e] + follows[e] for e in range(4)) for s in range(4))
    if chains:
        leads = {(p, j): v for p, j, _, v in edges({k: v for k, v in after.items() if len(k) == 2})}
        for chain in chains:
            state = START
            for part, j, *_ in chain:
                entry[part, j] = state
                state = leads[part, j][state]
    schema = T.StructType([T.StructField("conv", kind), *SCHEMA.fields])
    out = rows.mapInArrow(lambda it: _repair(it, entry, after, ahead), schema)
    return out.withColumnRenamed("conv", "conv_id")


def render(repaired: DataFrame, most_turns: int = 10_000) -> DataFrame:
    """conv_id, part, rendered, cost. A conversation of up to ``most_turns`` turns is one row, part 0.
    Since one text can't hold a conversation of any length, a longer one has several rows of up to
    ``most_turns`` turns: in the order of part they are its rendering, and their costs add up to its cost."""
    long = repaired.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")).where(F.col("turns") > most_turns).select(F.col("conv_id").alias("long"), F.lit(True).alias("cut"))
    rows = repaired.join(long, F.col("conv_id").eqNullSafe(F.col("long")), "left")
    part = F.when(F.col("cut"), F.expr(f"position div {int(most_turns)}")).otherwise(F.lit(0)).cast("long")
    pieces = F.array_sort(F.collect_list(F.struct("position", "piece")))
    joined = F.array_join(F.transform(pieces, lambda p: p["piece"]), "")
    return rows.groupBy("conv_id", part.alias("part")).agg(joined.alias("rendered"), F.sum("cost").alias("cost"))
