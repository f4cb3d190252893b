import random

import brute
import numpy as np
import pytest

from millrace.llm import neardup as N

SCHEMA = "doc_id long, text string, n string, bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def corpus(seed, families=12, singles=30):
    """Families of near copies around a base, some in chains, from far to equal."""
    rnd = random.Random(seed)
    word = lambda: f"{rnd.choice('abcdefgh')}{rnd.randrange(400)}"
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rnd.choice([4, 8, 60, 150]))]
        for _ in range(rnd.choice([2, 3, 12])):
            copy = list(base)
            for _ in range(rnd.randrange(5)):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(" ".join(copy) if rnd.random() < 0.7 else "\t".join(copy).upper())
            if rnd.random() < 0.4:
                base = copy
    texts += [" ".join(word() for _ in range(rnd.randrange(1, 40))) for _ in range(singles)]
    texts += ["", None, " \n", "one", "ONE", "one two", "É one two three"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "size"), [(0, 4), (1, 5), (2, 4)])
def test_equals_brute_force(spark, seed, size):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.groups(frame(spark, rows), size, 80).collect()}
    assert got == brute.components(rows, size, 80)


def test_large_bucket_in_chunks(spark, monkeypatch):
    """Many near copies in the same buckets, some just too far; buckets are cut into chunks."""
    monkeypatch.setattr(N, "FIRST", 8)
    monkeypatch.setattr(N, "CHUNK", 16)
    monkeypatch.setattr(N, "BLOCK", 5)
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rnd.choice([1, 2, 3, 4, 5, 6])):
            copy[rnd.randrange(120)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.groups(frame(spark, rows), 4, 80).collect()}
    assert got == brute.components(rows, 4, 80)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (3, text + " end"), (None, text), (9, None), (9, ""), (8, "a b"), (8, text)]
    got = sorted((tuple(r) for r in N.groups(frame(spark, rows), 4, 80).collect()), key=str)
    assert got == sorted([(5, 47, 3, False), (5, 47, 3, False), (3, 48, 3, True), (None, 47, None, None), (9, 0, 9, True), (9, 0, 9, True), (8, 1, 3, False), (8, 47, 3, False)], key=str)
    kept = N.near_duplicates(frame(spark, rows), 4, 80)
    assert kept.columns == ["doc_id", "text", "n", "bucket"] and sorted((r.doc_id for r in kept.collect()), key=str) == [3, 9, 9, None]
    assert N.groups(frame(spark, []), 4).count() == 0 and N.near_duplicates(frame(spark, [])).count() == 0


def test_copies_of_a_third_of_all_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, text if i % 3 else f"alone {i} " * 5) for i in range(600)]
    got = N.groups(frame(spark, rows), 4, 80).collect()
    assert {r.component_id for r in got if r.doc_id % 3} == {1} and all(r.kept for r in got if not r.doc_id % 3)


def test_estimates():
    rnd = np.random.default_rng(1)
    for bits, factor, shift in ((4, N.FACTOR, N.SHIFT), (1, N.LONG_FACTOR, N.LONG_SHIFT)):
        for share in (0.3, 0.8):
            off = []
            for _ in range(40):
                n = 400
                both = rnd.integers(0, 2**64, int(n * share), dtype=np.uint64)
                one, two = (np.concatenate([both, rnd.integers(0, 2**64, (n - len(both)) // 2, dtype=np.uint64)]) for _ in range(2))
                a, b = (np.frombuffer(N.packed(N.minima(np.unique(x), factor, shift), bits), np.uint64) for x in (one, two))
                true = len(both) / (len(both) + 2 * ((n - len(both)) // 2))
                off.append(float(N.similarity(N.matches(a, b[None], bits), len(factor), bits)[0]) - true)
            assert abs(np.mean(off)) < 0.015 and np.std(off) < (0.05 if bits == 4 else 0.02)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, rnd.randrange(101, 140)) for _ in range(30)] + [(200, 200)]
    parent = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.node: r.component for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in parent.items() if k != 200}


def say(rnd, n):
    return [f"{rnd.choice('abcdefgh')}{rnd.randrange(10**6)}" for _ in range(n)]


def test_recall_at_the_threshold(spark):
    """Pairs of exactly 80 % and a little more, of many lengths: every link is found; pairs just below aren't linked."""
    rnd = random.Random(11)
    rows, linked, apart = [], 0, 0
    for _ in range(700):
        n = rnd.choice([4, 8, 40, 200, 400])
        base = say(rnd, n + 4)
        for extra, link in ((n // 4, True), (n // 5, True), (n // 4 + 1, False)):
            i = len(rows)
            rows += [(i, " ".join(base)), (i + 1, " ".join(base + say(rnd, extra)))]
            linked, apart = linked + link, apart + (not link)
            base = say(rnd, n + 4)
    got = {r.doc_id: r.component_id for r in N.groups(frame(spark, rows), 5, 80).collect()}
    found = sum(got[i] == got[i + 1] for i in range(0, len(rows), 2))
    wrong = sum(got[i] == got[i + 1] for i in range(4, len(rows), 6))
    assert linked == 1400 and apart == 700 and (found, wrong) == (1400, 0)


@pytest.mark.parametrize("seed", [5, 6])
def test_exact_way_equals_brute_force(spark, seed):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.groups(frame(spark, rows), 4, 80, exact=True).collect()}
    assert got == brute.components(rows, 4, 80)


def test_wide_buckets_meet_by_rare_shingles(spark, monkeypatch):
    """Buckets of members of many components are replaced by buckets of rare shingles; no link is lost."""
    for name, value in (("FIRST", 8), ("CHUNK", 4), ("BLOCK", 5), ("WIDE", 9)):
        monkeypatch.setattr(N, name, value)
    narrowed = []
    kept = N._narrowed
    monkeypatch.setattr(N, "_narrowed", lambda u, *a: narrowed.append((u.count(), kept(u, *a))) or narrowed[-1][1])
    rnd = random.Random(21)
    base = say(rnd, 100)
    rows = []
    for family in range(30):  # families share 88 of about 112 words with each other, too few
        own = base[:88] + say(rnd, 20)
        rows += [(len(rows) + i, " ".join(own + say(rnd, 3))) for i in range(4)]
    want = brute.components(rows, 5, 80)
    for exact in (False, True):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in N.groups(frame(spark, rows), 5, 80, exact).collect()} == want
    assert any(kept.count() != before for before, kept in narrowed)


def test_exact_way_with_an_id_of_several_texts(spark):
    """An id's second text of rarer words doesn't hide the first one's prefix."""
    rnd = random.Random(22)
    common = say(rnd, 60)
    rows = [(1, " ".join(common)), (1, " ".join(say(rnd, 400))), (2, " ".join(common + say(rnd, 10)))]
    rows += [(10 + i, " ".join(common[:30] + say(rnd, 60))) for i in range(3)] + [(20 + i, " ".join(common[30:] + say(rnd, 60))) for i in range(3)]
    got = {(r.doc_id, r.component_id) for r in N.groups(frame(spark, rows), 5, 80, exact=True).collect()}
    assert {(1, 1), (2, 1)} <= got and all(a == b for a, b in got if a > 2)


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(N, "HELD", 500)
    rows = corpus(9)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.groups(frame(spark, rows), 4, 80).collect()}
    assert got == brute.components(rows, 4, 80)


def test_large_group_at_real_sizes(spark):
    """Over a thousand near copies in several chunks, two of its parts just too far from each other, and one bridge."""
    rnd = random.Random(12)
    base = say(rnd, 104)
    far = base[:92] + say(rnd, 12)  # 88 of 112 shingles of both
    rows = [(i, " ".join((base if i % 3 else far) + say(rnd, 2))) for i in range(1100)]
    want = brute.components(rows, 5, 80)
    assert len({c for _, c in want.values()}) == 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in N.groups(frame(spark, rows), 5, 80).collect()} == want
    rows.append((5000, " ".join(base[:92] + far[92:98])))
    assert {r.component_id for r in N.groups(frame(spark, rows), 5, 80).collect()} == {0}


def test_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = [(1, long), (2, long + " end"), (3, long[:1_000_000]), (4, "short")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.groups(frame(spark, rows), 5, 80).collect()}
    assert got[1] == (299_996, 1) and got[2] == (299_997, 1) and got[3][1] == 3 and got[4] == (1, 4)


def test_ids_that_are_no_integers(spark):
    rows = spark.createDataFrame([("7", "a b c d e f", "x"), ("x", "a b c d e f", "x"), ("5", "a b c d e f", "y")], "doc_id string, text string, cid string")
    assert sorted((tuple(r) for r in N.groups(rows, 4).collect()), key=str) == [(5, 3, 5, True), (7, 3, 5, False), (None, 3, None, None)]
    assert sorted(r.doc_id for r in N.near_duplicates(rows, 4).collect()) == ["5", "x"]
