import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, resample

KIND = "doc_id long, text string, rank string, score array<int>"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, target, percent=10, min_words=20, most=1, buckets=10_000, seed=2024):
    """docs: [(doc_id, text)] -> sorted (doc_id, n_features, weight, score, rank)."""

    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(b for x in texts for b in features(x)) for texts in ([x for _, x in docs], target))
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        f = features(text)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    k = percent * len(able) // 100
    out = [(*r[:4], i + 1 if i < k else None) for i, r in enumerate(able)]
    return sorted(out + [(*r[:4], None) for r in rows if not r[4]], key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def corpus(n, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["Alpha", "beta", "GAMMA", "étude", "x1", "日本", "the", "of", "Z"]
    return [(i, rnd.choice([" ", ", ", "-", "_"]).join(rnd.choice(vocabulary) for _ in range(rnd.randrange(60)))) for i in range(n)]


def test_equals_brute_force(spark):
    docs = corpus(400)
    docs += [(None, docs[3][1]), (None, docs[5][1]), (7, docs[7][1]), (8, "other " * 30), (900, None), (901, ""), (902, " \n.;"), (903, "long Word " * 60_000), (904, "x" * 300_000), (-5, docs[0][1] * 3)]
    target = ["alpha beta the x1", None, "Étude the of"]
    frame = spark.createDataFrame([(i, t, "r", [1]) for i, t in docs], KIND)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(resample.resample(frame, bench)) == brute(docs, target)
    assert got(resample.resample(frame, bench, percent=37, min_words=3, most_words=3, buckets=97, seed=1)) == brute(docs, target, 37, 3, 3, 97, 1)
    assert got(resample.resample(frame, bench, percent=100, min_words=0)) == brute(docs, target, 100, 0)


@pytest.mark.parametrize("percent", [5, 10, 40, 50, 100])
def test_hot_copies_at_the_cut(spark, percent):
    """A third of all rows are one row, another third has no id; a cut through copies draws exactly what is missing."""
    docs = corpus(60) + [(5, "same words here " * 10)] * 70 + [(None, "no id at all " * 8)] * 70
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = brute(docs, ["same words"], percent, 1)
    assert got(resample.resample(frame, spark.createDataFrame([("same words",)], "text string"), percent=percent, min_words=1)) == want
    assert sum(r[4] is not None for r in want) == percent * sum(1 for _, t in docs if words(t)) // 100


def test_radix_selection_over_the_range_of_longs(spark):
    big = 1 << 63
    rnd = random.Random(9)
    ids = [None, -big, big - 1, 0, -1, 1, *(rnd.randrange(-big, big) for _ in range(60))]
    rows = [(i, 1, 0, rnd.choice([-big, big - 1, 0, 65536, 65535, -3])) for i in ids]
    frame = spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long")
    order = sorted(rows, key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k in (1, 2, 17, 40, len(rows)):
        assert resample.kth_key(frame, k) == (order[k - 1][3], order[k - 1][0], k - 1)
    ranks = {r["rank"]: r["doc_id"] for r in resample.drawn(frame, 30).collect() if r["rank"]}
    assert ranks == {i + 1: r[0] for i, r in enumerate(order[:30])}


def test_only_the_selected_are_ranged(spark):
    frame = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(1).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight"), (F.col("id") % 500).alias("score"))
    out = resample.drawn(frame, 100)
    assert out.count() == 2000 and out.where("rank is not null").count() == 100
    assert out.where("rank <= 4").select("score").distinct().count() == 1


def test_empty_tables(spark):
    none, some = (spark.createDataFrame(rows, "doc_id long, text string") for rows in ([], corpus(30)))
    assert resample.resample(none, some).count() == 0
    assert got(resample.resample(some, none)) == brute(corpus(30), [])


def test_query(spark):
    out = queries.op13_resample(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == dict.fromkeys(("doc_id", "n_features", "weight", "score", "rank"), "bigint")
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    items = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text").collect()]
    assert got(out) == brute(docs, items)
