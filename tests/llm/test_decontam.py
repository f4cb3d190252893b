import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, decontam


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, item_id string, raw string"),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"),
    )


def example(seed):
    rnd = random.Random(seed)
    words = ["The", "of", "rare%d", "É", "x1", "a"]
    say = lambda n: " ".join((w % rnd.randrange(9) if "%" in w else w) for w in (rnd.choice(words) for _ in range(n)))
    items = [(i, say(rnd.choice([0, 1, 2, 3, 9, 10, 11, 30]))) for i in range(25)] + [(3, None), (4, "..."), (None, "Null ID item"), (11, "Null ID item"), (11, "Null ID item")]
    docs = []
    for i in range(80):
        text = say(rnd.randrange(50))
        if rnd.random() < 0.5:
            text = f"{text}! {(rnd.choice(items)[1] or '').upper()}? {say(5)}"
        docs.append((i, text))
    return docs + [(80, None), (81, ""), (82, "?!"), (7, "the null id item"), (7, "the null id item"), (None, "null ID item")], items


@pytest.mark.parametrize(("seed", "block"), [(0, 1 << 20), (1, 1 << 20), (2, 300), (3, 50)])
def test_equals_brute_force(spark, seed, block):
    docs, items = example(seed)
    d, b = frames(spark, docs, items)
    want = sorted(brute.contamination(docs, items, 10), key=str)
    assert sorted((tuple(r) for r in decontam.scan(d, b, 10, block).collect()), key=str) == want
    kept = decontam.decontaminate(d, b, 10, block)
    assert kept.columns == d.columns and kept.count() == sum(not r[5] for r in want)


def test_empty_tables_and_long_texts(spark):
    d, b = frames(spark, [(1, "w " * 200_000 + "a b c d e f g h i j")], [(1, "A b c d e f g h i j k")])
    assert tuple(decontam.scan(d, b).first())[1:4] == (200_010, 10, 1)
    assert decontam.scan(d, b.limit(0)).first().contaminated is False
    assert decontam.scan(d.limit(0), b).count() == 0
    assert decontam.decontaminate(d, b.limit(0)).count() == 1


def test_prefix_is_the_rarest_shingle():
    block = decontam.Block([("1", b"the of the of rare the of the of the")], 10)
    counts = {b"the of the": 90, b"of the of": 80, b"the of rare": 1, b"of rare the": 2, b"rare the of": 2}
    index = block.ranked(Counter(counts))
    assert list(index[3]) == [(b"the", b"of", b"rare")] and index[3][(b"the", b"of", b"rare")][0][0] == 2


def test_passes_do_not_grow_with_the_benchmark(spark):
    """How often the documents are read, counted by a function that every read runs."""
    from pyspark.sql import functions as F

    docs, _ = example(5)
    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    passes = []
    for n in (4, 60):
        items = [(i, f"rare{i} of the a x1 É rare{i % 7} the the of {i}") for i in range(n)]
        d, b = frames(spark, docs, items)
        d = d.withColumn("text", F.udf(counted, "string").asNondeterministic()("text"))
        before = seen.value
        got = decontam.scan(d, b, 10, block_bytes=40).collect()
        passes.append((seen.value - before) / len(docs))
        assert sorted(map(tuple, got), key=str) == sorted(brute.contamination(docs, items, 10), key=str)
    assert passes[0] == passes[1] <= 3


def test_one_text_in_a_third_of_all_rows_by_joins(spark):
    item = "a b c d e f g h i j k"
    docs = [(i, f"x {item} y" if i % 3 == 0 else f"plain {i}") for i in range(900)]
    d, b = frames(spark, docs, [(1, item), (2, "q " * 30)])
    got = decontam.scan(d, b, 10, block_bytes=10).collect()
    assert sorted(map(tuple, got)) == sorted(brute.contamination(docs, [(1, item)], 10))
    assert decontam.decontaminate(d, b, 10, block_bytes=10).count() == 600


def test_bytes_that_are_no_text_in_both_ways(spark):
    """Items and documents of invalid UTF-8 are compared byte by byte, however large the benchmark is."""
    raw = [b"one \xff two \xfe three a b c d e f g", b"one \xfd two \xfe three a b c d e f g", b"caf\xe9 x"]
    sql = "doc_id long, raw binary"
    d = spark.createDataFrame([(1, b"so " + raw[0] + b" end"), (2, b"so " + raw[1] + b" end"), (3, b"CAF\xe9 X!"), (4, b"caf\xe8 x")], sql).selectExpr("doc_id", "cast(raw as string) as text")
    b = spark.createDataFrame([(1, raw[0]), (2, raw[2])], sql).selectExpr("doc_id as item_id", "cast(raw as string) as text")
    ways = [sorted(map(tuple, decontam.scan(d, b, 10, block).collect())) for block in (1 << 20, 1)]
    assert ways[0] == ways[1] and [(r[0], r[2], r[5]) for r in ways[0]] == [(1, 12, True), (2, 10, True), (3, 2, True), (4, 0, False)]


def test_columns_of_any_name(spark):
    d = spark.createDataFrame([(1, "a b", "x", {"k": 1}), (2, "c", "y", {"k": 2})], "doc_id long, text string, `o`` d.d` string, key map<string,int>")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for block in (1 << 20, 1):
        kept = decontam.decontaminate(d, b, 10, block)
        assert kept.columns == d.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_large_way_on_odd_tables(spark):
    """A word in every document as an item, long texts, and tables without rows, by joins."""
    docs = [(i, f"the the {i} of the") for i in range(200)] + [(900, "long " * 150_000 + "a b c d e f g h i j"), (901, None), (None, "the")]
    items = [(1, "the"), (2, "A b c d e f g h i j k"), (None, "of the")]
    d, b = frames(spark, docs, items)
    assert sorted((tuple(r) for r in decontam.scan(d, b, 10, 1).collect()), key=str) == sorted(brute.contamination(docs, items, 10), key=str)
    assert decontam.scan(d.limit(0), b, 10, 1).count() == 0 and decontam.scan(d, b.limit(0), 10, -1).where("contaminated").count() == 0


def test_frequent_prefixes_and_windows_in_parts(spark, monkeypatch):
    """One-word items in every document: places and texts are dealt over parts, answers stay the same."""
    monkeypatch.setattr(common, "PART", 0.01)
    monkeypatch.setattr(common, "PART_LEAST", 3)
    docs = [(i, f"the cat {i} of the {'a b c d e f g h i j k' if i % 3 == 0 else 'b c d'} the") for i in range(150)]
    items = [(1, "the"), (2, "The!"), (3, "A b c d e f g h i j k"), (None, "of the"), (4, "b c d"), (5, "absent words only here")]
    d, b = frames(spark, docs, items)
    assert sorted((tuple(r) for r in decontam.scan(d, b, 10, 1).collect()), key=str) == sorted(brute.contamination(docs, items, 10), key=str)


def test_joined_in_parts(spark, monkeypatch):
    """Each row meets each of its key's rows once; no part of a key is much more than its share."""
    monkeypatch.setattr(common, "PART", 0.01)
    monkeypatch.setattr(common, "PART_LEAST", 10)
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 400)) as k")
    table = spark.createDataFrame([("hot", 1), ("hot", 2), ("k7", 3), ("none", 4)], "k string, v int")
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert [tuple(r) for r in common.frequent(counts, "k").collect()] == [("hot", 34)]
    want = rows.join(table, "k")
    got = common.joined_in_parts(rows, table, "k", counts, ["id"])
    assert sorted(map(tuple, got.select("id", "k", "v").collect())) == sorted(map(tuple, want.select("id", "k", "v").collect()))
    empty = common.joined_in_parts(rows.limit(0), table, "k", counts.limit(0), ["id"])
    assert empty.count() == 0
