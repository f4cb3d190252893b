import itertools
import random
import zlib

from millrace.llm import chat

LEGAL = {"start": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}


def cheapest(codes):
    """Least cost by trying, for each turn, every relabelling, merge and single insertion."""
    best = {("start",): 0}
    for given in codes:
        nxt = {}
        for (state,), cost in best.items():
            for role in ("system", "user", "assistant"):
                same = chat.ROLES[given] == role
                change = 0 if same else (chat.RELABEL if given else chat.RELABEL_UNKNOWN)
                options = []
                if role in LEGAL[state]:
                    options.append(change)
                if role == state:
                    options.append(change + chat.MERGE)
                options += [change + chat.INSERT for between in LEGAL[state] if role in LEGAL[between]]
                for o in options:
                    nxt[(role,)] = min(nxt.get((role,), 1 << 40), cost + o)
        best = nxt
    end = {"start": 0, "assistant": 0, "user": chat.INSERT, "system": 2 * chat.INSERT}
    return min(c + end[s] for (s,), c in best.items())


def legal(text):
    roles = [x.split("|>")[0] for x in text.split("<|")[1:]]
    turns = [r for r in roles if r != "end"]
    if roles != [x for t in turns for x in (t, "end")]:
        return False
    body = turns[1:] if turns and turns[0] == "system" else turns
    return bool(body) and body == ["user", "assistant"] * (len(body) // 2)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, extra string")


def conversations(seed, n, longest):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", None, " Human "]
    return [(c, t, rnd.choice(roles), rnd.choice(["", "a", "b\nc", None]), "x") for c in range(n) for t in range(rnd.randint(1, longest))]


def test_cheapest_legal_and_independent_of_ranges(spark):
    rows = conversations(3, 40, 7) + [(99, t, "user" if t % 3 else "assistant", f"t{t}", "x") for t in range(60)]
    given = table(spark, rows)
    one = chat.repair(given, per_part=10**6)
    many = chat.repair(given, per_part=7)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(one) == key(many)
    rendered = {r.conv_id: r for r in chat.render(many).collect()}
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: (r[0], r[1])), key=lambda r: r[0]):
        own = list(own)
        assert rendered[conv].cost == cheapest([chat.role_code(r[2]) for r in own])
        assert legal(rendered[conv].rendered)
        texts = [r[3] for r in own if r[3]]
        at = 0
        for t in texts:  # every text is there, in order
            at = rendered[conv].rendered.index(t, at) + len(t)


def test_legal_conversation_is_untouched(spark):
    rows = [(1, 0, "system", "s", ""), (1, 1, "user", "u", ""), (1, 2, "assistant", "a", "")]
    out = chat.repair(table(spark, rows))
    assert [r.action for r in out.orderBy("turn").collect()] == ["keep"] * 3
    assert chat.render(out).first().rendered == "<|system|>\ns<|end|>\n<|user|>\nu<|end|>\n<|assistant|>\na<|end|>\n"


def test_odd_rows(spark):
    assert chat.repair(table(spark, [])).count() == 0
    rows = [(None, None, None, None, None), (None, 1, "user", "u" * 100_000, None), (2, 0, "user", "x", "e"), (2, 0, "user", "x", "e")]
    got = chat.render(chat.repair(table(spark, rows))).collect()
    by = {r.conv_id: r.rendered for r in got}
    assert legal(by[None]) and legal(by[2]) and by[2] == "<|user|>\nx\n\nx<|end|>\n<|assistant|>\n<|end|>\n"


def test_long_conversations_are_rendered_in_parts(spark):
    rows = [(c, i, "user", f"c{c} t{i};", "") for c, n in ((1, 95), (2, 10), (None, 31)) for i in range(n)]
    out = chat.repair(table(spark, rows), per_part=20)
    whole = {r.conv_id: r for r in chat.render(out).collect()}
    got = sorted(chat.render(out, most_turns=10).collect(), key=lambda r: r.part)
    assert [r.part for r in got if r.conv_id == 2] == [0]
    for conv, want in whole.items():
        own = [r for r in got if r.conv_id == conv]
        assert "".join(r.rendered for r in own) == want.rendered and sum(r.cost for r in own) == want.cost
        assert all(r.rendered.count(";") <= 10 for r in own)


def rendered(roles_and_texts):
    """The rendering of a conversation by trying all arcs forwards, cheapest first, then as the operator orders equals."""
    codes = [chat.role_code(r) for r, _ in roles_and_texts]
    arcs = list(chat.walk(codes, chat.START, chat.costs_to_go(codes)))
    return "".join(chat.pieces(arcs, [t or "" for _, t in roles_and_texts], chat.START, True))


def test_positions_follow_from_the_data(spark):
    """Turns that tie, repeat or are null, and columns whose names clash, over ranges of any size: the pieces by position are the rendering."""
    rnd = random.Random(12)
    long = "x" * 70
    rows = [(c, rnd.choice([None, 1, 1, 2]), rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", long + "1", long + "2", None]), "s", 1, "p") for c in (1, None, 3) for _ in range(40)]
    frames = [spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string, position int, piece string").repartition(n) for n in (2, 5)]
    got = [sorted(map(tuple, chat.repair(f, per_part=n).collect()), key=str) for f in frames for n in (3, 11, 10**6)]
    assert all(g == got[0] for g in got)
    order = lambda r: [(r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""), (r[3] is not None, (r[3] or "")[:64]), zlib.crc32((r[3] or "").encode()), r[3] or ""]
    for conv in (1, None, 3):
        own = sorted((r for r in got[0] if r[0] == conv), key=lambda r: r[7])
        assert [r[7] for r in own] == list(range(40))
        assert "".join(r[6] for r in own) == rendered([(r[2], r[3]) for r in sorted((r for r in rows if r[0] == conv), key=order)])
