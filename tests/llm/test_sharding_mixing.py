import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, sharding
from millrace.llm.queries import ORACLES, SEED

SCHEMA = "doc_id long, text string, source string, shard int, size string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x") for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1021, 4097])
def test_permutation(n):
    assert sorted(sharding.permute(x, n, 5) for x in range(n)) == list(range(n))


def test_permutation_scatters():
    at = [sharding.permute(x, 10_000, 9) for x in range(1000)]
    assert len({p // 500 for p in at}) == 20 and max(Counter(p % 40 for p in at).values()) < 50


@pytest.mark.parametrize("n", [0, 1, 39, 40, 41, 500])
def test_shards(spark, n):
    rnd = random.Random(n)
    rows = [(rnd.choice([i, 5, -3, None]) if i % 4 else i, rnd.choice([None, "", "é", "long " * 2000, f"t{i}"]), "s") for i in range(n)]
    got = sharding.shard_rows(docs(spark, rows), 40, seed=3).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and r.position == r.slot * 40 + r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(40)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_do_not_depend_on_partitions(spark, monkeypatch):
    rows = [(i % 150, "x" * (i % 5), "s") for i in range(300)]
    one = sharding.shard_rows(docs(spark, rows).repartition(1), 40)
    monkeypatch.setattr(sharding, "CHUNK", 1)
    many = sharding.shard_rows(docs(spark, rows[::-1]).repartition(9), 40)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)


def test_column_equals_plain_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 5, 77, 1000):
        got = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 4).alias("p")).collect()
        assert all(r.p == sharding.permute(r.id, n, 4) for r in got)


def water(sizes):
    """Clamp and reshare until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mix(spark, seed):
    rnd = random.Random(seed)
    names = [None, "", "a", "é", "Z", "zz", "b"][: rnd.randint(1, 7)]
    rows = [(i, rnd.choice([None, "", "w", "a b\tc", "x " * rnd.randrange(60)]), rnd.choice([names[0], *names])) for i in range(rnd.choice([20, 300]))]
    given = docs(spark, rows)
    got = mixing.mix_digest(given).collect()
    assert len(got) == len(rows)
    sizes, taken, longest = Counter(), Counter(), Counter()
    source = {i: s for i, _, s in rows}
    for r in got:
        s = source[r.doc_id]
        sizes[s] += r["size"]
        taken[s] += r.taken
        longest[s] = max(longest[s], r["size"])
        assert r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        assert r["size"] == len((next(t for i, t, _ in rows if i == r.doc_id) or "").split())
    want = water(sizes)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
    again = mixing.mix_digest(given.repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    copies = Counter(r.doc_id for r in mixing.mix(given).collect())
    assert all(copies[r.doc_id] == r.taken / r["size"] for r in got if r["size"])
    assert mixing.mix(given).columns == given.columns


def test_mix_equals_sql(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(i, " ".join("w" * rnd.randrange(1, 4) for _ in range(rnd.randrange(50))), rnd.choice(["a", "b", "c", None])) for i in range(200)] + [(7, "again and again", "a"), (None, "no id", "b")]
    docs(spark, rows).coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/d/*.parquet')")
    want = con.execute(ORACLES["op8_mixing"]).fetchall()
    got = mixing.mix_digest(docs(spark, rows), seed=SEED).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_mix_of_nothing(spark):
    assert mixing.mix_digest(docs(spark, [])).count() == 0
    assert [tuple(r) for r in mixing.mix_digest(docs(spark, [(1, None, "a")])).collect()] == [(1, 0, 0, 0.0, 0)]
    assert mixing.mix(docs(spark, [])).count() == 0


@pytest.mark.parametrize("shared", [5, None])
def test_many_rows_under_one_id(spark, shared):
    """Equal texts, most of them under one id: the cut splits the copies."""
    rows = [(shared if i < 80 else 1000 + i, "w " * 100, "a") for i in range(100)] + [(5000 + i, "x " * 30, "b") for i in range(60)]
    given = spark.createDataFrame([(i, t, s, k, "y" if k % 3 else None) for k, (i, t, s) in enumerate(rows)], "doc_id long, text string, source string, shard int, size string")
    got = mixing.mix_digest(given, weights=(1, 1), budget=(3, 4), max_epochs=2).collect()
    assert len(got) == len(rows)
    for source, words in (("a", 100), ("b", 30)):
        own = [r for r in got if r["size"] == words]
        assert abs(sum(r.taken for r in own) - own[0].target) <= words / 2, source
    assert len({r.taken for r in got if r.doc_id == shared}) == 2
    mixed = mixing.mix(given, weights=(1, 1), budget=(3, 4), max_epochs=2).collect()
    again = mixing.mix(given.repartition(7), weights=(1, 1), budget=(3, 4), max_epochs=2).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, again))
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.taken // r["size"]
    assert Counter(r.doc_id for r in mixed) == +taken


def test_copies_unfold_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 7)
    monkeypatch.setattr(mixing, "SLOTS", 3)
    rows = [(1, "a b c", "s")] * 50 + [(2, "a b c", "s")] * 31
    got = mixing.mix_digest(docs(spark, rows), budget=(5, 3)).collect()
    assert len(got) == 81 and abs(sum(r.taken for r in got) - 81 * 3 * 5 / 3) <= 1.5
    assert mixing.mix(docs(spark, rows), budget=(5, 3)).count() == sum(r.taken // 3 for r in got)


def test_a_very_long_text_is_counted_whole(spark):
    assert [r["size"] for r in mixing.mix_digest(docs(spark, [(1, "word " * 400_000, "a")])).collect()] == [400_000]
    assert [r["size"] for r in sharding.shard_rows(docs(spark, [(1, "word " * 400_000, "a")]), 40).collect()] == [2_000_016]


def test_rows_without_an_id_spread_over_buckets(spark):
    rows = spark.range(4000).select(F.lit(None).cast("long").alias("i"), F.crc32(F.col("id").cast("string").cast("binary")).alias("c"))
    sizes = [r["count"] for r in rows.groupBy(sharding.bucket_of(F.col("i"), F.col("c"), 64)).count().collect()]
    assert len(sizes) == 64 and max(sizes) < 120
    odd = spark.createDataFrame([("7", "a", "s"), ("x7", "b", "s"), (None, "b", "s")], "doc_id string, text string, source string")
    assert sorted((r.doc_id for r in sharding.shard_rows(odd, 40).collect()), key=str) == [7, None, None]


def test_columns_of_any_type_and_name_through_a_split_cut(spark):
    """Copies that differ in a map, a variant, a microsecond or a column with odd signs alone; the cut falls among them."""
    base = spark.range(90).select(
        F.lit(5).cast("long").alias("doc_id"), F.lit("w " * 100).alias("text"), F.lit("a").alias("source"), F.create_map(F.lit("k"), F.col("id") % 7).alias("m"),
        F.parse_json(F.concat(F.lit('{"v": '), (F.col("id") % 5).cast("string"), F.lit("}"))).alias("v"), F.timestamp_micros(F.col("id") % 3).alias("at"), (F.col("id") % 2).alias("a`b.c"), F.lit(b"x").alias("row"),
    )
    out = [mixing.mix(base.repartition(n), weights=(1,), budget=(4, 5), max_epochs=2) for n in (2, 7)]
    assert out[0].columns == base.columns and out[0].schema["m"].dataType == base.schema["m"].dataType
    rows = [sorted(map(str, o.select("doc_id", "m", F.to_json("v").alias("v"), "at", F.col("`a``b.c`")).collect())) for o in out]
    given = Counter(map(str, base.select("doc_id", "m", F.to_json("v").alias("v"), "at", F.col("`a``b.c`")).collect()))
    assert rows[0] == rows[1] and len(rows[0]) == 72 and not Counter(rows[0]) - given
