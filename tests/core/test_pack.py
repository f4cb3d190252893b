"""Packing against first-fit decreasing, row by row."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.catalog.selection import packing_plan
from millrace.operators import pack
from millrace.plans.recipe import RecipeError


def first_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        for i, room in enumerate(bins):
            if room >= n:
                bins[i] -= n
                break
        else:
            bins.append(capacity - n)
    return len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_fillings_are_as_tight_as_first_fit(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([64, 1000, 16_384])
    lengths = [min(capacity, max(1, int(rnd.paretovariate(rnd.choice([0.7, 1.5])) * capacity / 60))) for _ in range(3000)]
    plan = pack.fillings(Counter(lengths), capacity)
    held = Counter()
    for f in plan:
        assert sum(n * k for n, k in f.parts) <= capacity
        for n, k in f.parts:
            held[n] += k * f.bins
    assert held == Counter(lengths)
    bins, best = sum(f.bins for f in plan), first_fit_decreasing(lengths, capacity)
    assert bins <= best * 1.01 + 1 and len(plan) <= 3 * len(set(lengths)) + 3


def check(table, rows, capacity):
    by_bin = {}
    for r in table:
        if r["bin"] is not None:
            by_bin.setdefault(r["bin"], []).append((r["offset"], r["tokens"]))
    assert sorted(by_bin) == list(range(len(by_bin)))
    for parts in by_bin.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at  # one after another, without a gap
            at += n
        assert at <= capacity
    assert sorted((str(r["row_id"]), r["tokens"] or 0) for r in table) == sorted((str(i), n or 0) for i, n in rows)


def test_rows_of_hot_lengths_and_ids(spark):
    """A third of the rows share a length, another third an id; some have no tokens."""
    rnd = random.Random(2)
    rows = [(i, 700) for i in range(400)] + [(7, rnd.randrange(1, 1000)) for _ in range(400)] + [(i, rnd.randrange(1, 1001)) for i in range(400)] + [(1, None), (2, 0), (None, 5), (3, -1)]
    frame = spark.createDataFrame(rows, "row_id long, tokens long").repartition(5)
    table = pack.packed(frame, capacity=1000).collect()
    check(table, rows, 1000)
    assert sum(r["bin"] is None for r in table) == 3
    facts = pack.filled(pack.packed(frame, capacity=1000), capacity=1000).first()
    assert (facts["rows"], facts["overfull"], facts["overlapping"]) == (1201, 0, 0) and facts["fill"] == pytest.approx(facts["tokens"] / (facts["bins"] * 1000))
    assert sorted(map(str, table)) == sorted(map(str, pack.packed(frame.repartition(3), capacity=1000).collect()))


def test_odd_tables(spark):
    none = spark.createDataFrame([], "row_id long, tokens long")
    assert pack.packed(none).count() == 0 and pack.filled(pack.packed(none)).first()["bins"] == 0
    with pytest.raises(RecipeError):
        pack.packed(spark.createDataFrame([(1, 17)], "row_id long, tokens long"), capacity=16)


def test_query_packs_all_documents(spark):
    table = packing_plan(spark, "/root/testdata/sf0.001").collect()
    rows = [(r["row_id"], r["tokens"]) for r in table]
    check(table, rows, pack.CAPACITY)
    assert len(table) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.regexp_count("text", F.lit(r"\S")) > 0).count()
