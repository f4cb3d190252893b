import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, structure

WHITE = " \t\n\x0b\x0c\r"
KIND = "conv_id long, turn long, role string, text string, n string, code string, part int, conv array<int>"
GOOD = re.compile(r"(s?(ua)+)?")


def known(x):
    return (x is not None, x or 0)


def edits(rows):
    """The (cost, audit, repaired rows) of every edit of a short conversation's rows (role, text, fault), at bounded cost."""
    best = None
    bound = 2 * len(rows)  # deleting everything

    def go(i, cost, audit, out):
        nonlocal best
        if cost > bound:
            return
        if i == len(rows):
            if GOOD.fullmatch("".join(r[:1] or "?" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, list(out))
        else:
            role, text, fault = rows[i]
            go(i + 1, cost + 2, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                go(i + 1, cost + extra, audit + "K", [*out, (role, text)])
                for to in ("user", "assistant"):
                    go(i + 1, cost + 1 + extra, audit + "R", [*out, (to, text)])
        for to in ("user", "assistant"):
            go(i, cost + 5, audit + "I", [*out, (to, "")])

    go(0, 0, "", [])
    return best


def shortest(rows):
    """The same for any length: least (cost, audit) of each state, row by row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def put(to, state, made):
        if state not in to or made[:2] < to[state][:2]:
            to[state] = made

    def inserted(at):
        for _ in range(3):
            for state, (cost, audit, out) in list(at.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in step:
                        put(at, role[0], (cost + 5, audit + "I", [*out, (role, "")]))
        return at

    at = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        new = {}
        for state, (cost, audit, out) in at.items():
            put(new, state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            for to, letter, price in ((role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                if (state, to[:1]) in step:
                    put(new, to[:1], (cost + price + extra, audit + letter, [*out, (to, text)]))
        at = inserted(new)
    return min((at[s] for s in ("", "a") if s in at), key=lambda x: x[:2])


def faults(rows):
    """rows (turn, role, text) in order -> [(role, text, fault or None)]"""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def ordered(rows):
    return sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (known(r[0]), r[1].encode(), r[2][:64].encode(), zlib.crc32(r[2].encode()), r[2].encode()))


def brute(table, damage=False, search=shortest):
    """table [(conv_id, turn, role, text)] -> sorted digest rows"""
    by_conv = {}
    for conv, turn, role, text in table:
        own = by_conv.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, own in by_conv.items():
        rows = ordered(own)
        marked = faults(rows)
        turns = {t for t, *_ in rows if t is not None}
        counts = [sum(f == k for *_, f in marked) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, repaired = search(marked)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def conversations(n, longest, seed):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "User", "u"]
    texts = ["Yes.", "No!", "Why?", "cut", "cut ,", "", " \n", None, "Ja. \t", "é", "."]
    return [(None if c == 3 else c, rnd.choice([None, *range(6)] * 2 + [k] * 8), rnd.choice(roles), rnd.choice(texts)) for c in range(n) for k in range(rnd.randrange(1, longest))]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", 1, [2]) for r in rows], KIND).repartition(parts)


def test_both_searches_agree():
    rnd = random.Random(1)
    for _ in range(150):
        rows = [(rnd.choice(["user", "assistant", "system", "tool"]), "t", rnd.choice([None, None, "truncated", "blank", "duplicate"])) for _ in range(rnd.randrange(5))]
        assert edits(rows)[:2] == shortest(rows)[:2], rows


def test_equals_brute_force(spark):
    rows = conversations(250, 9, 5)
    assert got(structure.digests(frame(spark, rows))) == brute(rows)
    assert got(structure.digests(*structure.damaged(frame(spark, rows)))) == brute(rows, damage=True)


def test_exhaustive_search_of_short_ones(spark):
    rows = conversations(60, 5, 11)
    assert got(structure.digests(frame(spark, rows))) == brute(rows, search=edits)


@pytest.mark.parametrize("per_part", [7, 60])
def test_a_conversation_over_many_ranges(spark, per_part):
    """One conversation holds most rows, another most of the rest, and one is a single row many times."""
    rnd = random.Random(7)
    rows = conversations(20, 6, 3)
    for conv, n in ((100, 400), (None, 150)):
        rows += [(conv, rnd.choice([i, i, i - 3, None]), rnd.choice(["user", "assistant", "user", "assistant", "system"]), f"{rnd.randrange(300)}{rnd.choice(['.', '?', ' ', 'x', ''])}") for i in range(n)]
    rows += [(101, 4, "user", "again and again.")] * 300 + [(101, 5, "assistant", "Well."), (101, 5, "assistant", "Well.")]
    assert got(structure.digests(frame(spark, rows), per_part=per_part)) == brute(rows)
    table = structure.repair(frame(spark, rows), per_part=per_part).collect()
    for conv in (100, None, 101):
        own = sorted((r for r in table if r["conv_id"] == conv), key=lambda r: r["place"])
        text = "\n".join(f"{r['role']}:{r['text']}" for r in own if r["role"] is not None)
        line = next(r for r in brute(rows) if r[0] == conv)
        assert ("".join(r["edits"] for r in own), hashlib.sha256(text.encode()).hexdigest()) == (line[7], line[8])


def test_pieces_of_long_texts(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i} " + "word " * 30_000 + ".") for i in range(30)] + [(2, 0, "user", "Hm."), (2, 1, "assistant", "x" * 400_000 + ".")]
    assert got(structure.digests(frame(spark, rows), per_part=4)) == brute(rows)


def test_rows_that_all_go(spark):
    rows = [(c, 0, "user", "Hi.") for c in range(200)] + [(c, 1, "assistant", "Hi.") for c in range(0, 200, 2)]
    out = brute(rows, damage=True)
    assert any(r[7] == "" and r[6] == 0 and r[8] == hashlib.sha256(b"").hexdigest() for r in out)
    assert got(structure.digests(*structure.damaged(frame(spark, rows)))) == out


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert structure.digests(none).count() == 0 and structure.repair(none).count() == 0
    text_ids = spark.createDataFrame([("a", "0", "user", "Hi."), ("a", "1", "assistant", "Ho."), ("b", "x", "tool", "Hm.")], "conv_id string, turn string, role string, text string")
    assert {(r["conv_id"], r["audit"]) for r in structure.digests(text_ids).collect()} == {("a", "KK"), ("b", "D")}


def test_query(spark):
    out = queries.op12_structure(spark, "/root/testdata/sf0.001")
    assert out.schema["cost"].dataType.simpleString() == out.schema["gaps"].dataType.simpleString() == "bigint"
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(out) == brute(rows, damage=True)
    assert out.select(F.count_distinct("conv_id")).first()[0] == len({r[0] for r in rows})
