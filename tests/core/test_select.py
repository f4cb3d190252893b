import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.rank import ranked, until_quota
from millrace.operators.select import Part, order_key, priority_select
from millrace.plans.recipe import ALL_ONCE, Recipe, RecipeError, Source


def sequential(rows, order, claimed=()):
    """rows: (source, row_id, hash, tokens, key). The walk, one row after the other."""
    claimed = set(claimed)
    picked, stats = set(), {}
    for source, quota in order:
        n = tokens = skipped = 0
        for _, row_id, h, t, key in sorted((r for r in rows if r[0] == source), key=lambda r: (r[4], r[1])):
            if h in claimed:
                skipped += 1
                continue
            claimed.add(h)
            picked.add((source, row_id))
            n, tokens = n + 1, tokens + t
            if quota is not None and tokens >= quota:
                break
        stats[source] = (n, tokens, skipped)
    return picked, stats


@pytest.mark.parametrize("seed", range(6))
def test_walk_equals_sequential(spark, seed):
    rnd = random.Random(seed)
    sources = [f"s{i}" for i in range(4)]
    rows = []
    for i in range(rnd.choice([0, 30, 300])):
        rows.append((rnd.choice(sources[:3] if seed % 2 else sources), i, f"h{rnd.randrange(60)}", rnd.randrange(1, 50), hashlib.md5(f"{seed}:{i}".encode()).hexdigest()))
    order = [(s, rnd.choice([None, 0, 1, 120, 700, 10**6])) for s in rnd.sample(sources, 4)]
    seeds = {f"h{i}" for i in range(5)} if seed > 2 else set()
    df = spark.createDataFrame(rows, "source_id string, row_id long, prompt_hash string, tokens long, key string")
    claimed = spark.createDataFrame([(h,) for h in seeds], "prompt_hash string") if seeds else None
    picked, stats = priority_select(df, [Part(s, q) for s, q in order], claimed, strict=False)
    want, figures = sequential(rows, order, seeds)
    assert {(r.source_id, r.row_id) for r in picked.collect()} == want
    got = {r.source_id: (r.selected_rows, r.selected_tokens, r.duplicates_skipped) for r in stats.collect()}
    # duplicates are counted up to the cut; without a cut all of the source's are
    assert {s: x[:2] for s, x in got.items()} == {s: x[:2] for s, x in figures.items()}
    for s, q in order:
        if q is None or figures[s][1] < q or figures[s][0]:
            assert got[s][2] == figures[s][2]


def test_odd_source_ids(spark):
    """An empty id, null and ids that look like paths are sources like any other."""
    names = ["", None, "a/b", "__HIVE_DEFAULT_PARTITION__", "x=y", " "]
    rows = [(names[i % 6], i, f"h{i % 40}", 3, hashlib.md5(str(i).encode()).hexdigest()) for i in range(120)]
    df = spark.createDataFrame(rows, "source_id string, row_id long, prompt_hash string, tokens long, key string")
    order = [(n, q) for n, q in zip(names, (9, None, 20, 10**6, 1, None), strict=True)]
    picked, stats = priority_select(df, [Part(s, q) for s, q in order], strict=False)
    want, figures = sequential([(s, *r) for s, *r in rows], order)
    assert {(r.source_id, r.row_id) for r in picked.collect()} == want
    assert {r.source_id: (r.selected_rows, r.selected_tokens, r.duplicates_skipped) for r in stats.collect()} == figures


def test_shortfall_is_an_error(spark):
    df = spark.createDataFrame([("a", 1, "h", 5, "0" * 32)], "source_id string, row_id long, prompt_hash string, tokens long, key string")
    with pytest.raises(RecipeError):
        priority_select(df, [Part("a", 6)])


def test_ranks_and_prefixes_do_not_depend_on_cells(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("g")).alias("g"), "id", order_key(1, F.col("id")).alias("key"), (F.col("id") % 7).alias("n"))
    one = ranked(df, ["g"], "key", ["id"], cells=1).select("id", "pos")
    many = ranked(df, ["g"], "key", ["id"], cells=64).select("id", "pos")
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    a, b = (until_quota(df, "g", "key", "id", "n", 100, cells=c).select("id") for c in (1, 64))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_quota_goldens():
    shares = {0.035: 72_849_923, 0.02: 41_628_528, 0.07: 145_699_846, 0.20: 416_285_275, 0.15: 312_213_956, 0.10: 208_142_638}
    for share, want in shares.items():
        plan = Recipe((Source("a", token_share=share), Source("b", token_share=1 - share)), 2_081_426_376)
        assert plan.quotas(0)["a"] == want
        assert sum(plan.quotas(0).values()) == 2_081_426_376
    with pytest.raises(RecipeError):
        plan.quotas(2_081_426_376)


def test_order_must_name_every_source():
    plan = Recipe((Source("a"), Source("b", selection=ALL_ONCE)), 1, selection_order=("b",))
    with pytest.raises(RecipeError):
        plan.ordered()
    assert [s.id for s in Recipe((Source("a"), Source("b")), 1, selection_order=("b", "a")).ordered()] == ["b", "a"]
