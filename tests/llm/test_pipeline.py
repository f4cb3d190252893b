import random

import brute
import corpus_pipeline

from millrace.llm import mixing, queries, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, where, rows, labels, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")


def corpus():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice(["ba", "ce", "di", "fo", "gu"]) for _ in range(rnd.randint(1, 5)))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(5)]
    rows, labels = [], []
    for i in range(400):
        text = " ".join(word() for _ in range(rnd.randint(20, 90)))
        toxic = i % 8 == 0
        if toxic:
            text += " grobian vilxer" * 2
        elif i % 8 == 1 and rows:
            text = rows[-1][1].replace(" grobian vilxer", "") if rnd.random() < 0.5 else rnd.choice(rows)[1]
        elif i % 8 == 2:
            text += " " + items[i % 5][1]
        rows.append((i, text, "en", f"s{i % 3}" if i % 5 else None, len(text)))
        labels.append((i, 1, int("grobian" in text)))
    return rows + [(400, None, None, None, None)], labels, items


def test_every_stage_against_brute_force(spark, tmp_path):
    rows, labels, items = corpus()
    write(spark, tmp_path, rows, labels, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    text = {r[0]: r[1] for r in rows}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "near-duplicates", "decontamination", "mixing", "sharding"]

    def apply(name, given):
        out = steps[name](spark, given, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "sharding" or out.columns == COLUMNS
        return out

    clean = apply("toxicity", docs)
    flagged = {r.doc_id for r in toxicity.classify(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).where("is_toxic").collect()}
    kept = {r.doc_id for r in clean.collect()}
    assert kept == set(text) - flagged and flagged == {i for i, t in text.items() if t and "grobian" in t}
    single = apply("near-duplicates", clean)
    groups = brute.components([(i, text[i]) for i in sorted(kept)], 5, 80)
    kept = {i for i, (_, c) in groups.items() if c == i}
    assert sorted(r.doc_id for r in single.collect()) == sorted(kept)
    pure = apply("decontamination", single)
    kept -= {r[0] for r in brute.contamination([(i, text[i]) for i in kept], items, 10) if r[5]}
    assert sorted(r.doc_id for r in pure.collect()) == sorted(kept)
    mix = apply("mixing", pure)
    want = sorted(r.doc_id for r in mixing.mix_digest(pure, corpus_pipeline.SEED).collect() for _ in range(r.taken // r["size"] if r["size"] else 0))
    assert sorted(r.doc_id for r in mix.where("text is not null and text <> ''").collect()) == want
    shards = apply("sharding", mix)
    assert shards.count() == mix.count()
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, shards.collect()))


def test_pipeline_of_nothing(spark, tmp_path):
    write(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_query_an_operator():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n in queries.QUERIES]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


def test_odd_columns_repeats_and_long_texts(spark, tmp_path):
    """Columns named like the stages' own, a map, repeated rows and a very long text go through all stages."""
    rows, labels, items = corpus()
    rows = [(*r, {"k": i % 3}, "x", i) for i, r in enumerate(rows)] + [(*rows[7], {"k": 1}, "y", 1)] * 3 + [(500, "long Words " * 100_000, "en", "s0", 5, {}, None, None)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, key map<string,long>, `times``.` string, row long"
    write(spark, tmp_path, [r[:5] for r in rows], labels, items)
    docs = spark.createDataFrame(rows, kind)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "sharding":
            assert out.columns == docs.columns, name
            out.write.parquet(f"{tmp_path}/odd-{name}")
            docs = spark.read.parquet(f"{tmp_path}/odd-{name}")
            assert docs.where("doc_id = 500 and length(text) = 1100000").count() >= (name != "mixing")
    assert out.count() == docs.count() > 0
