"""The persistent claims: batches, the join where they lie, the bitmap ahead, another session."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace.operators import claims as C
from millrace.plans import mix
from millrace.plans.recipe import Input, Recipe, Source

ROWS = "prompt_hash string, source_id string, n long"


def frame(spark, lo, hi, source="a"):
    return spark.range(lo, hi).select(F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("prompt_hash"), F.lit(source).alias("source_id"), F.col("id").alias("n"))


def numbers(df):
    return sorted(r["n"] for r in df.collect())


def test_batches_and_what_is_left(spark, tmp_path):
    store = C.ClaimStore(spark, f"{tmp_path}/claims", buckets=8)
    asked = frame(spark, 0, 300)
    assert store.unclaimed(asked).count() == 300 and store.owners(asked).count() == 0
    store.append(frame(spark, 0, 100), "one")
    store.append(frame(spark, 50, 150, "b").unionByName(frame(spark, 50, 60, "c")), "two")
    assert numbers(store.unclaimed(asked)) == list(range(150, 300))
    owners = {r["n"]: (r["batch"], r["owner"]) for r in store.owners(asked).collect()}
    assert set(owners) == set(range(150)) and owners[70] == ("one", "a") and owners[120] == ("two", "b")
    store.append(frame(spark, 200, 210), "two")  # replaces the batch
    assert numbers(store.unclaimed(asked)) == [*range(100, 200), *range(210, 300)]
    store.append(frame(spark, 0, 0), "three")
    odd = frame(spark, 0, 3).unionByName(spark.createDataFrame([(None, "x", -1), (None, "y", -2)], ROWS)).unionByName(frame(spark, 250, 252)).unionByName(frame(spark, 250, 252))
    assert numbers(store.unclaimed(odd)) == [-2, -1, 250, 250, 251, 251]
    with pytest.raises(ValueError):
        store.append(asked, "a'b")


def test_merged_batches_answer_alike(spark, tmp_path):
    store, asked = C.ClaimStore(spark, f"{tmp_path}/claims", buckets=4), frame(spark, 0, 60)
    store.append(frame(spark, 0, 20), "b1")
    store.append(frame(spark, 10, 30, "b"), "b2")
    store.append(frame(spark, 40, 50, "c"), "b3")
    before = numbers(store.unclaimed(asked)), {r["n"]: r["owner"] for r in store.owners(asked).collect()}
    store.compact("b1")  # one batch is nothing to merge
    assert store.batches() == ["b1", "b2", "b3"]
    store.compact("b2")
    assert store.batches() == ["b2.all", "b3"]
    assert (numbers(store.unclaimed(asked)), {r["n"]: r["owner"] for r in store.owners(asked).collect()}) == before
    store.append(frame(spark, 50, 55), "b4")
    store.compact("b4")
    assert store.batches() == ["b4.all"] and numbers(store.unclaimed(asked)) == [*range(30, 40), *range(55, 60)]
    again = C.ClaimStore(spark, f"{tmp_path}/claims")
    assert again.buckets == 4 and numbers(again.unclaimed(asked)) == [*range(30, 40), *range(55, 60)]


def test_claims_are_not_shuffled(spark, tmp_path):
    store = C.ClaimStore(spark, f"{tmp_path}/claims", buckets=8)
    store.append(frame(spark, 0, 500), "one")
    store.append(frame(spark, 500, 900), "two")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = store.unclaimed(frame(spark, 0, 2000))
        assert numbers(df) == list(range(900, 2000))
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "LeftAnti" in plan and "SelectedBucketsCount: 8 out of 8" in plan
        assert len(re.findall(r"Exchange hashpartitioning", plan[plan.index("LeftAnti") :])) == 1  # of the rows that ask
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_new_rows_skip_the_join(spark, tmp_path):
    store = C.ClaimStore(spark, f"{tmp_path}/claims", buckets=4)
    store.append(frame(spark, 0, 1000), "one")
    maybe, sure = store._split(frame(spark, 500, 5000), "prompt_hash")
    assert set(range(500, 1000)) <= set(numbers(maybe)) and maybe.count() < 520 and maybe.count() + sure.count() == 4500


def test_another_session_goes_on(spark, tmp_path):
    C.ClaimStore(spark, f"{tmp_path}/claims", buckets=4).append(frame(spark, 0, 10), "one")
    other = spark.newSession()
    other.sql(f"drop table if exists {C.ClaimStore(spark, f'{tmp_path}/claims').name}")  # only the name; the files stay
    again = C.ClaimStore(other, f"{tmp_path}/claims", buckets=99)
    assert again.buckets == 4 and numbers(again.unclaimed(frame(other, 5, 15))) == list(range(10, 15))


def test_builds_and_audits_share_claims(spark, tmp_path):
    say = lambda i: ([("user", f"q{i}"), ("assistant", "word " * 80)], "de")
    kind = "messages array<struct<role:string,content:string>>, language string"
    for name, lo, hi in (("a", 0, 30), ("b", 20, 60)):
        spark.createDataFrame([say(i) for i in range(lo, hi)], kind).write.parquet(f"{tmp_path}/{name}")
    first = Recipe((Source("a", "r", token_share=1.0, input=Input(path=f"{tmp_path}/a")),), 1500, version="v1")
    second = replace(first, sources=(Source("b", "r", token_share=1.0, input=Input(path=f"{tmp_path}/b")),), version="v2", target_tokens=2000)
    store = C.ClaimStore(spark, f"{tmp_path}/claims", buckets=4)
    one = mix.build(spark, first, tmp_path, f"{tmp_path}/one", ledger=store)
    assert store.claims().count() == one["selected_rows"]
    line = mix.audit(spark, second, tmp_path, ["b"], seed_claims=store)[0]
    assert line["duplicates_after_seed"] > 0 and line["unique_rows_after_seed"] + line["duplicates_after_seed"] == 40
    two = mix.build(spark, second, tmp_path, f"{tmp_path}/two", ledger=store)
    hashes = [{r[0] for r in spark.read.parquet(f"{tmp_path}/{n}/train.parquet").select("prompt_hash").collect()} for n in ("one", "two")]
    assert not hashes[0] & hashes[1] and store.claims().count() == one["selected_rows"] + two["selected_rows"]
    again = mix.build(spark, second, tmp_path, f"{tmp_path}/two", ledger=store, force=True)  # its own batch doesn't stand in its way
    assert again["selected_rows"] == two["selected_rows"] and store.claims().count() == one["selected_rows"] + two["selected_rows"]
