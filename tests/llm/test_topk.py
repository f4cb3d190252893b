import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import topk


def brute(rows, k):
    def fine(v):
        return v is not None and all(x is not None and x == x and abs(x) != float("inf") for x in v)

    import math

    vecs = sorted({(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and fine(v)})
    out = []
    for q in sorted({i for i, _ in vecs if i % 10 == 0}):
        hits = {(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(qv, v, strict=True)))), i) for qi, qv in vecs if qi == q for i, v in vecs if i != q and len(v) == len(qv)}
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(hits)[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(v, i, "x") for i, v in rows], "embedding array<float>, vec_id long, score string")


@pytest.mark.parametrize(("seed", "dim", "spread"), [(0, 3, 1.0), (1, 8, 0.01), (2, 1, 2.0)])
def test_equals_brute_force(spark, monkeypatch, seed, dim, spread):
    monkeypatch.setattr(topk, "MIN_SHARD_ROWS", 40)
    rnd = random.Random(seed)
    centre = [rnd.gauss(0, 1) for _ in range(dim)]
    # float32 values, so that Spark and Python see the same numbers; rounding makes ties
    rows = [(i, [round((c if i % 3 else 0) + rnd.gauss(0, spread), 1) * 0.5 if i % 2 else 0.25 for c in centre]) for i in range(300)]
    rows = [(i, [float(f"{x:.2f}") // 0.03125 * 0.03125 for x in v]) for i, v in rows]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0]), (10, []), (11, []), (12, [1.0, 2.0]), (13, [1.0, 2.0]), (None, [9.0, 9.0]), (20, [1e18, 1.0]), (21, [-1e18, 1.0])]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3)
    assert topk.top_k(frame(spark, []), F.lit(True)).count() == 0


def test_recall_is_whole_with_a_shared_vector(spark, monkeypatch):
    """A third of the rows share one vector; ties go to the smaller ids."""
    monkeypatch.setattr(topk, "MIN_SHARD_ROWS", 50)
    rows = [(i, [1.0, 0.5] if i % 3 == 0 else [i / 1024, 0.0]) for i in range(400)]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=10)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_regions_cover_space_and_boxes_rule_out():
    """Every region of a layout holds its sample rows alone, and a floor keeps the regions that reach it."""
    rnd = np.random.default_rng(3)
    rows = rnd.integers(-1000, 1000, (500, 4))
    layout = topk.Layout(list(rows), 16)
    region = layout.of(rows)
    assert set(region) == set(range(1, 17)) and max(np.bincount(region)) < 70
    lo = np.stack([rows[region == r].min(axis=0) for r in range(1, 17)])
    hi = np.stack([rows[region == r].max(axis=0) for r in range(1, 17)])
    scores = rows @ rows[0]
    floor = int(np.sort(scores)[-10])
    batch = topk.pa.RecordBatch.from_pydict({"id": [0, 1, 2], "v": [rows[0].tolist(), rows[0].tolist(), [1]], "floor": [floor, None, 5]})
    out = next(topk._reached(iter([batch]), 4, np.arange(1, 17, dtype=np.int32), lo, hi))["regions"].to_pylist()
    assert set(region[scores >= floor]) <= set(out[0]) and len(out[0]) < 16
    assert out[1:] == [list(range(1, 17)), [0]]


def test_mixed_lengths_and_large_numbers(spark, monkeypatch):
    """Other lengths than the usual one, equal vectors beyond a shard's rows, and products beyond doubles."""
    monkeypatch.setattr(topk, "MIN_SHARD_ROWS", 30)
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    rnd = random.Random(5)
    rows = [(i, [float(rnd.randint(-50, 50)) * (2.0**30 if i % 7 == 0 else 1.0) for _ in range(3 if i % 4 else 2)]) for i in range(240)]
    rows += [(i, [1.0, 2.0, 3.0]) for i in range(240, 360)]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)
