"""Selection from a stream against the walk itself, over batches of any size, failures and restarts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.claims import ClaimStore
from millrace.operators.select import Part
from millrace.streaming.walk import StreamSelection

ROWS = "source_id string, row_id long, prompt_hash string, tokens long, at long, turn string"
PARTS = [Part("a", 90), Part("b", 70), Part("", None), Part(None, 40), Part("d", 0)]


def arrivals(seed, n=240):
    rng = random.Random(seed)
    names = ["a", "b", "", None, "d", "unlisted"]
    rows = [(rng.choice(names), i, f"p{int(rng.paretovariate(0.6)) % 90}", rng.choice([0, 1, 2, 5, 9]), i // 2, "x") for i in range(n)]
    rows[3], rows[4] = ("a", 3, None, 5, 1, "x"), ("b", 4, "p1", None, 2, "x")
    return rows


def walked(rows):
    left = {p.source_id: float("inf") if p.quota is None else max(p.quota, 1) for p in PARTS}
    claimed, out = set(), []
    for s, row_id, prompt, tokens, _, _ in rows:
        if s not in left or prompt is None or tokens is None or prompt in claimed or left[s] <= 0:
            continue
        claimed.add(prompt)
        left[s] -= tokens
        out.append((s, row_id))
    return out


def got(spark, walk):
    return sorted(((r["source_id"], r["row_id"]) for r in walk.taken(spark).collect()), key=str)


@pytest.mark.parametrize("seed,cuts", [(1, ()), (2, (2, 80, 82))])
def test_any_batches_give_the_walk(spark, tmp_path, seed, cuts):
    rows = arrivals(seed)
    walk = StreamSelection(f"{tmp_path}/walk", PARTS, buckets=4, cell_rows=16, merge_every=2)
    for i, (lo, hi) in enumerate(zip((0, *cuts), (*cuts, len(rows)), strict=True)):
        part = rows[lo:hi]
        random.Random(i).shuffle(part)
        walk.take(spark.createDataFrame(part, ROWS).repartition(3), i)
    assert got(spark, walk) == sorted(walked(rows), key=str)
    tokens = {r["source_id"]: (r["n"], r["t"]) for r in walk.taken(spark).groupBy("source_id").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()}
    assert walk.totals(spark) == tokens
    if cuts:  # the fourth batch came after the second one had merged the first and is itself the last
        assert ClaimStore(spark, f"{tmp_path}/walk/claims").batches() == ["000000000001.all", "000000000002", "000000000003"]


def test_a_full_source_claims_nothing(spark, tmp_path):
    """Each source is cut only because the one before it was: as many rounds as sources."""
    rows, parts = [], [Part(f"s{i}", 2) for i in range(5)]
    for i in range(5):
        rows += [(f"s{i}", 10 * i + j, f"q{i}" if j == 0 else f"p{i}" if j == 1 else f"p{i + 1}", 1, 10 * i + j, "x") for j in range(3)]
    walk = StreamSelection(f"{tmp_path}/walk", parts, buckets=4, cell_rows=2)
    walk.take(spark.createDataFrame(rows, ROWS), 0)
    assert [r for _, r in got(spark, walk)] == [0, 1, 10, 11, 20, 21, 30, 31, 40, 41]


def test_stream_failure_and_restart(spark, tmp_path, monkeypatch):
    rows, folder = arrivals(7), tmp_path / "in"
    for i, (lo, hi) in enumerate([(0, 60), (60, 150), (150, 240)]):
        spark.createDataFrame(rows[lo:hi], ROWS).coalesce(1).write.mode("append").parquet(str(folder))
        for f in folder.glob("part-*"):
            if f.stat().st_mtime > 1e9 + 10:
                os.utime(f, (1e9 + i, 1e9 + i))
    read = lambda: spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(folder))
    walk = StreamSelection(str(tmp_path / "walk"), PARTS, buckets=4)
    append = ClaimStore.append

    def failing(self, claims, batch):
        append(self, claims, batch)
        if int(batch) == 1:
            raise RuntimeError("lost after the claims were written")

    monkeypatch.setattr(ClaimStore, "append", failing)
    with pytest.raises(Exception, match="lost after"):
        walk.start(read(), str(tmp_path / "ck")).awaitTermination(300)
    assert walk.done(spark) == [0]
    monkeypatch.setattr(ClaimStore, "append", append)
    again = StreamSelection(str(tmp_path / "walk"), PARTS, buckets=4)
    again.start(read(), str(tmp_path / "ck")).awaitTermination(300)
    assert again.done(spark) == [0, 1, 2] and got(spark, again) == sorted(walked(rows), key=str)
    again.take(spark.createDataFrame(rows, ROWS), 2)  # done already
    again.take(spark.createDataFrame([], ROWS), 3)
    again.take(spark.createDataFrame(rows, ROWS), 4)  # every prompt of these is claimed, or its source is full
    full = {p.source_id for p in PARTS if p.quota is not None}
    assert [x for x in got(spark, again) if x[0] in full] == [x for x in sorted(walked(rows), key=str) if x[0] in full]
