"""Conversation structure repair by a tight-arc graph over edits.

The rows of a conversation, by turn, are edited until the initials of their roles read ``(s?(ua)+)?``: Keep
costs 0, Rerole to user or assistant 1, Delete 2, Insert of an empty user or assistant turn 5. Blank and repeated
rows must be deleted; a truncated row that stays adds 5. Nodes of the graph are (rows done, state), with the states
nothing, system, user and assistant; arcs are edits. Forward minimum costs from the start and backward ones from the end
tell which arcs are tight, that is on some cheapest path. A frontier of nodes then goes from start to end: at each step it
takes the least letter among its tight arcs (D, I, K, R) and moves along all arcs with that letter. Letters and
rows decide the state in this automaton, so a frontier that starts as one node stays one.

Rows equal in conversation, turn, role and text fold with a count; all but the first are repeats. A row is a repeat if
the least turn of its conversation, role and text is less than its own, found by an aggregate of
which only repeated texts are joined back; hot ones go by broadcast.

Rows are dealt by range of (conversation, turn, role, start and checksum of the text), so that a conversation of any length spreads over tasks.
Only the first and the last conversation of a range can go on elsewhere. For these a 4 x 4 matrix of least costs is taken;
the driver chains the matrices, at most two a range, to the costs before and after each stretch; a second pass finds where
each state leads, which gives the stretch's first node. ``repair`` has one row a folded row and insertion. ``digests`` has one
row a conversation; a conversation that lies in one range ends there, and the stretches of others
are streamed in order into their audit and hash, which are one value each by definition; their texts are never held together.

Null and odd cases: a null conversation id is a conversation; a null turn comes first and takes no part in gaps; equal
turns stand by role, then by the text's first 64 characters, its checksum and the whole text; a null role or text is one space, so a row without text is blank; roles
count by their first character as it is, and any but s, u and a must be reroled or deleted; repeated rows are rows whose text
was seen earlier; very long texts are read whole; turns that are no integers count as null; a conversation without rows has
zeros, an empty audit and the hash of nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import joined_by_share, shared_dir, written

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
#: What an edit costs, and what a truncated row that stays adds.
DELETE, KEEP, REROLE, INSERT, TRUNCATED = 2, 0, 1, 5, 5
FAR = 1 << 50
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: Faults of a row.
FINE, BLANK, REPEAT, CUT = range(4)
WHITE = " \t\n\x0b\x0c\r"
#: Bytes of text in a range, as a rule, and of a piece that is handed on.
RANGE_BYTES, PIECE = 32 << 20, 1 << 20
#: Characters of a text that stand in the order before its checksum: the cuts of ranges are a sample, which long texts would make dear.
HEAD = 64
STATS = ("blank", "duplicate", "truncated", "illegal")
EDIT = "place long, turn long, edits string, role string, text string"
SPAN = "place long, edits string, repaired binary, blank long, duplicate long, truncated long, illegal long, first int, last int, low long, high long, turns long, first_turn long, last_turn long, cost long"


def _arcs() -> list[list[tuple[int, str, int, int]]]:
    """For each code (4 * fault + role): (state, letter, cost, state after)."""
    out = []
    for fault, role in itertools.product(range(4), range(4)):
        arcs = [(s, "D", DELETE, s) for s in range(4)]
        extra = TRUNCATED if fault == CUT else 0
        for s in range(4) if fault in (FINE, CUT) else ():
            arcs += [(s, "K", KEEP + extra, role)] if role in FOLLOWS[s] else []
            arcs += [(s, "R", REROLE + extra, t) for t in (USER, ASSISTANT) if t in FOLLOWS[s] and t != role]
        out.append(arcs)
    return out


ARCS = _arcs()
INSERTS = [(s, t) for s in range(4) for t in (USER, ASSISTANT) if t in FOLLOWS[s]]


def _inserted(costs: list[int], back: bool = False) -> tuple[int, ...]:
    """Costs once any number of insertions may come next (or, ``back``, came before). Two rounds over the arcs do."""
    out = list(costs)
    for _ in range(2):
        for s, t in INSERTS:
            a, b = (t, s) if back else (s, t)
            out[b] = min(out[b], out[a] + INSERT)
    return tuple(out)


BEGIN = _inserted([0, FAR, FAR, FAR])
END = _inserted([0, FAR, FAR, 0], back=True)


def _forward(costs: tuple[int, ...], rows: list[tuple[int, int]]) -> list[tuple[int, ...]]:
    """Least cost to each state before each of the rows (code, count), and after the last."""
    out = [costs]
    for code, n in rows:
        new = [FAR] * 4
        for s, _, c, t in ARCS[code]:
            new[t] = min(new[t], out[-1][s] + c)
        out.append(tuple(min(FAR, x + DELETE * (n - 1)) for x in _inserted(new)))
    return out


def _backward(costs: tuple[int, ...], rows: list[tuple[int, int]]) -> list[tuple[int, ...]]:
    """Least cost from each state before each of the rows to the end, given the costs that follow them."""
    out = [costs]
    for code, n in reversed(rows):
        new = [FAR] * 4
        for s, _, c, t in ARCS[code]:
            new[s] = min(new[s], out[-1][t] + c)
        out.append(tuple(min(FAR, x + DELETE * (n - 1)) for x in _inserted(new, back=True)))
    return out[::-1]


def matrix(rows: list[tuple[int, int]]) -> list[list[int]]:
    """Least cost from state to state through the rows."""
    return [list(_forward(_inserted([0 if s == start else FAR for s in range(4)]), rows)[-1]) for start in range(4)]


def traverse(rows: list[tuple[int, int]], before: tuple[int, ...], after: tuple[int, ...], frontier: set[int], last: bool) -> Iterator[tuple[int, str, set[int]]]:
    """(row, letters, frontier after) along the least of the cheapest edits. Insertions have the row that they
    come before. The ``last`` stretch goes on to the end of the conversation."""
    ahead, behind = _forward(before, rows), _backward(after, rows)
    best = min(ahead[0][s] + behind[0][s] for s in range(4))
    i = 0
    while True:
        if i == len(rows) and (not last or any(s in (START, ASSISTANT) and ahead[i][s] == best for s in frontier)):
            return
        found: dict[str, set[int]] = {}
        if i < len(rows):
            code, n = rows[i]
            for s, letter, c, t in ARCS[code]:
                if s in frontier and ahead[i][s] + c + DELETE * (n - 1) + behind[i + 1][t] == best:
                    found.setdefault(letter, set()).add(t)
        for s, t in INSERTS:
            if s in frontier and ahead[i][s] + INSERT + behind[i][t] == best:
                found.setdefault("I", set()).add(t)
        letter = min(found)
        frontier = found[letter]
        if letter == "I":
            yield i, "I", frontier
        else:
            yield i, letter + "D" * (rows[i][1] - 1), frontier
            i += 1


def prepared(conversations: DataFrame, copies: Column | None = None) -> tuple[DataFrame, int, int]:
    """conv, turn, role, text, n, code: folded rows with their fault and role; how many, and their bytes of text. ``copies``
    says how often a row stands there; a row with 0 only makes its conversation known."""
    rows = conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").try_cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("n"),
    )
    folded = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    part = lambda c: F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    keyed = written(folded.withColumn("key", F.sha2(F.concat(part(conv), part(F.col("role")), F.col("text")).cast("binary"), 256)), "structure-rows")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    repeats = keyed.where("n > 0").groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.min(turn).alias("earliest")).where("times > 1")
    total, size = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    joined = joined_by_share(keyed, F.when(F.col("n") > 0, F.col("key")), written(repeats, "structure-repeats"), "key", "times", total)
    end = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    fault = F.when(end == "", BLANK).when(turn > F.col("earliest"), REPEAT).when(end.isin(".", "!", "?"), FINE).otherwise(CUT)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    return joined.select("conv", "turn", "role", "text", "n", (fault * 4 + role).cast("int").alias("code")), total, size


def _ordered(rows: DataFrame, total: int, size: int, per_part: int) -> DataFrame:
    """Rows in order, in ranges, kept in the shared folder so that every pass sees the same ranges."""
    spark = rows.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / per_part), math.ceil(size / RANGE_BYTES))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.substring("text", 1, HEAD).asc(), F.crc32(F.col("text").cast("binary")).asc()]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, F.col("text").asc())
    return dealt.select("conv", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "n", "code").checkpoint()


def _stretches(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[int | None, object, list[tuple]]]:
    """(0 for a range's first conversation, 1 for its last if another, None within; the conversation; its rows)."""
    rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("conv", *names)), strict=True))
    groups = itertools.groupby(rows, key=lambda r: r[0])
    held, i = next(((k, list(g)) for k, g in groups), None), 0
    while held is not None:
        (conv, own), held = held, next(((k, list(g)) for k, g in groups), None)
        yield 0 if i == 0 else 1 if held is None else None, conv, [r[1:] for r in own]
        i += 1


def _known(conv: object) -> str:
    return "" if conv is None else f"={conv}"


def _edges(batches: Iterator[pa.RecordBatch], around: dict | None) -> Iterator[pa.RecordBatch]:
    """A row for the first and the last conversation of this range: its matrix, or, once the costs ``around`` are known,
    the state that each entry state leads to (-1: on no cheapest path)."""
    part, out = TaskContext.get().partitionId(), []
    for j, conv, own in _stretches(batches, ("code", "n")):
        rows = [r for r in own if r[1]]
        if j is None:
            continue
        if around is None:
            out.append((part, j, _known(conv), [c for line in matrix(rows) for c in line]))
        elif (part, j) in around:
            before, after = around[part, j]
            whole = [b + a for b, a in zip(before, _backward(after, rows)[0], strict=True)]
            out.append((part, j, _known(conv), [_exit(rows, before, after, s) if whole[s] == min(whole) else -1 for s in range(4)]))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64())) if k == 3 else pa.array(c) for k, c in enumerate(zip(*out, strict=True))], names=["part", "j", "conv", "v"])


def _exit(rows: list[tuple[int, int]], before: tuple[int, ...], after: tuple[int, ...], state: int) -> int:
    """The state after a stretch that is entered in a state."""
    return [state, *(reached for _, _, (reached,) in traverse(rows, before, after, {state}, False))][-1]


def _chained(rows: DataFrame) -> dict[tuple[int, int], tuple]:
    """For each stretch of a conversation that lies in several ranges: costs before and after, entry state, whether it is
    the last one, the whole cost."""

    def edges(around: dict | None) -> list[tuple]:
        got = rows.select("conv", "code", "n").mapInArrow(lambda it: _edges(it, around), "part long, j long, conv string, v array<long>")
        return sorted(tuple(r) for r in got.collect())  # at most two a range

    runs: list[list[tuple]] = []
    for s in edges(None):
        if runs and runs[-1][-1][2] == s[2] and runs[-1][-1][0] != s[0]:
            runs[-1].append(s)
        else:
            runs.append([s])
    runs = [r for r in runs if len(r) > 1]
    around: dict[tuple[int, int], tuple] = {}
    for run in runs:
        ahead, behind = [BEGIN], [END]
        for *_, m in run[:-1]:
            ahead.append(tuple(min(FAR, *(ahead[-1][s] + m[4 * s + t] for s in range(4))) for t in range(4)))
        for *_, m in reversed(run[1:]):
            behind.append(tuple(min(FAR, *(m[4 * s + t] + behind[-1][t] for t in range(4))) for s in range(4)))
        for (part, j, *_), before, after in zip(run, ahead, behind[::-1], strict=True):
            around[part, j] = (before, after)
    if not runs:
        return {}
    leads = {(part, j): v for part, j, _, v in edges(around)}
    out = {}
    for run in runs:
        state = START
        m, after = run[0][3], around[run[0][:2]][1]
        cost = min(m[4 * START + t] + after[t] for t in range(4))
        for part, j, *_ in run:
            out[part, j] = (*around[part, j], state, (part, j) == run[-1][:2], cost)
            state = leads[part, j][state]
    return out


def _edited(own: list[tuple], plan: tuple | None) -> Iterator[tuple[int | None, str, int | None]]:
    """(row or None for an insertion, letters, role of what stays or None) of the rows (code, n, ...) of a stretch."""
    before, after, state, last = plan[:4] if plan else (BEGIN, END, START, True)
    real = [i for i, r in enumerate(own) if r[1]]
    for i, letters, (state,) in traverse([own[k][:2] for k in real], before, after, {state}, last):
        yield (None if letters == "I" else real[i]), letters, (None if letters[0] == "D" else state)


def _kept(own: list[tuple], k: int | None, letters: str, state: int) -> tuple[bytes, bytes]:
    """Role and text of what stays; rows are (code, n, turn, role, text)."""
    if k is None:
        return NAMES[state].encode(), b""
    return (own[k][3] if letters[0] == "K" else NAMES[state].encode()), own[k][4]


def _pack(rows: list[tuple], kind: pa.DataType, spec: str) -> pa.RecordBatch:
    made = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [("conv", kind), *((x.split()[0], made[x.split()[1]]) for x in spec.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


def _batched(rows: Iterator[tuple], kind: pa.DataType, spec: str) -> Iterator[pa.RecordBatch]:
    """Batches of up to 1,024 rows and about eight pieces of text."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(out) == 1024 or size >= 8 * PIECE:
            yield _pack(out, kind, spec)
            out, size = [], 0
    if out:
        yield _pack(out, kind, spec)


COLUMNS = ("code", "n", "turn", "role", "text")


def _edit_rows(batches: Iterator[pa.RecordBatch], chained: dict) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is None:
        return
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        place = part << 40
        for j, conv, own in _stretches(itertools.chain([first], batches), COLUMNS):
            for k, letters, state in _edited(own, chained.get((part, j))):
                role, text = _kept(own, k, letters, state) if state is not None else (None, None)
                yield conv, place, None if k is None else own[k][2], letters, role and role.decode("utf-8", "replace"), None if text is None else text.decode("utf-8", "replace")
                place += 1

    yield from _batched(rows(), first.schema.field("conv").type, EDIT)


def _stats(own: list[tuple]) -> tuple:
    """blank, duplicate, truncated, illegal, first and last role, least and greatest turn, distinct turns, first and last turn."""
    counts, illegal, roles, turns = [0, 0, 0, 0], 0, [], []
    for code, n, turn, *_ in own:
        if not n:
            continue
        fault, role = divmod(code, 4)
        counts[fault] += 1
        counts[BLANK if fault == BLANK else REPEAT] += n - 1
        illegal += n - 1 + (bool(roles) and (roles[-1], role) not in LEGAL)
        roles = [*roles[:1], role]
        if turn is not None and (not turns or turns[-1] != turn):
            turns.append(turn)
    edge = lambda x, i: x[i] if x else None
    return (*counts[1:], illegal, edge(roles, 0), edge(roles, -1), edge(turns, 0), edge(turns, -1), len(turns), edge(turns, 0), edge(turns, -1))


def _spans(batches: Iterator[pa.RecordBatch], chained: dict) -> Iterator[pa.RecordBatch]:
    """Conversations that lie in this range as one row with their hash; stretches of others as pieces of their repaired text."""
    first = next(batches, None)
    if first is None:
        return
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        place = part << 40
        for j, conv, own in _stretches(itertools.chain([first], batches), COLUMNS):
            plan, sha, audit, held, size, begun = chained.get((part, j)), hashlib.sha256(), [], [], 0, False
            stats = _stats(own)
            for k, letters, state in _edited(own, plan):
                audit.append(letters)
                if state is not None:
                    piece = b":".join(_kept(own, k, letters, state))
                    if plan is None:
                        sha.update((b"\n" if begun else b"") + piece)
                        begun = True
                    else:
                        held.append(piece)
                        size += len(piece)
                if plan is not None and size >= PIECE:
                    yield conv, place, "".join(audit), b"\n".join(held), *stats, plan[4]
                    place, audit, held, size, stats = place + 1, [], [], 0, (0,) * 4 + (None,) * 4 + (0, None, None)
            if plan is None:
                cost = _forward(BEGIN, [r[:2] for r in own if r[1]])[-1]
                yield conv, None, "".join(audit), sha.digest(), *stats, min(cost[START], cost[ASSISTANT])
            else:
                yield conv, place, "".join(audit), b"\n".join(held) if held else None, *stats, plan[4]
            place += 1

    yield from _batched(rows(), first.schema.field("conv").type, SPAN)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its pieces in order. Only letters are held."""
    names = [x.split()[0] for x in SPAN.split(", ")]
    first = next(batches, None)
    if first is None:
        return
    pieces = (r for b in itertools.chain([first], batches) for r in zip(*(b[c].to_pylist() for c in ("conv", *names)), strict=True))

    def rows() -> Iterator[tuple]:
        for conv, own in itertools.groupby(pieces, key=lambda r: r[0]):
            sha, begun, audit, sums, turns, low, high, role, turn, cost = hashlib.sha256(), False, [], [0] * 4, 0, None, None, None, None, 0
            for _, _, letters, text, *stats in own:
                audit.append(letters)
                if text is not None:
                    sha.update((b"\n" if begun else b"") + text)
                    begun = True
                sums = [a + b for a, b in zip(sums, stats[:4], strict=True)]
                first_role, last_role, lo, hi, distinct, first_turn, last_turn, cost = stats[4:]
                if first_role is not None:
                    sums[3] += role is not None and (role, first_role) not in LEGAL
                    role = last_role
                if first_turn is not None:
                    turns += distinct - (turn == first_turn)
                    low, high, turn = lo if low is None else low, hi, last_turn
            yield conv, None, "".join(audit), sha.digest(), *sums, None, None, low, high, turns, None, None, cost

    yield from _batched(rows(), first.schema.field("conv").type, SPAN)


def repair(conversations: DataFrame, copies: Column | None = None, per_part: int = 200_000) -> DataFrame:
    """conv_id, place, turn, edits, role, text: every row (equal ones as one, with several letters) and insertion in
    the order of place; what is deleted has no role and text. The number itself depends on the ranges."""
    rows = _ordered(*prepared(conversations, copies), per_part)
    chained = _chained(rows)
    schema = T.StructType([rows.schema["conv"], *T.StructType.fromDDL(EDIT).fields])
    return rows.mapInArrow(lambda it: _edit_rows(it, chained), schema).withColumnRenamed("conv", "conv_id")


def digests(conversations: DataFrame, copies: Column | None = None, per_part: int = 200_000) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation."""
    rows = _ordered(*prepared(conversations, copies), per_part)
    chained = _chained(rows)
    schema = T.StructType([rows.schema["conv"], *T.StructType.fromDDL(SPAN).fields])
    spans = rows.mapInArrow(lambda it: _spans(it, chained), schema)
    if chained:  # few conversations reach beyond a range
        spans = written(spans, "structure-spans")
        parts = spans.where("place is not null").repartition("conv").sortWithinPartitions("conv", "place")
        spans = spans.where("place is null").unionByName(parts.mapInArrow(_merged, schema))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return spans.select(F.col("conv").alias("conv_id"), gaps.alias("gaps"), *STATS, "cost", F.col("edits").alias("audit"), F.lower(F.hex("repaired")).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with faults by a checksum of conversation and turn, and how often each row stands there: of twenty rows one
    goes, one loses its text, one its sentence ends, one stands twice, and one is the user's."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return rows, F.col("copies")
