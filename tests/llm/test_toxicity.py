import random

import numpy as np

from millrace.llm import toxicity as X

STEMS = ["grob", "vilx", "zork"]


def corpus(n, seed=0):
    """Texts of invented words; toxic ones hold words that begin with a stem."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["ba", "ce", "di", "fo", "gu", "ha"]) for _ in range(rnd.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(5, 80))]
        toxic = rnd.random() < 0.15
        for _ in range(rnd.randint(1, 6) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(STEMS) + rnd.choice(["", "e", "ig", "st", "er"]))
        rows.append((i, " ".join(words).capitalize() + ".", "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id long, text string, p string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = corpus(1500)
    known = [x for x in labels if x[0] % 2]
    docs, flags = frames(spark, rows, known)
    got = {r.doc_id: r for r in X.classify(docs, flags).collect()}
    assert len(got) == 1500
    truth = dict(labels)
    held = [i for i in truth if i % 2 == 0]
    hit = sum(got[i].is_toxic for i in held if truth[i])
    assert hit >= 0.97 * sum(truth[i] for i in held) and not any(got[i].is_toxic for i in held if not truth[i])
    assert all("toxic" in got[i].categories for i in held if got[i].is_toxic)
    kept = X.keep_clean(docs, flags)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].is_toxic}
    again = {r.doc_id: r.p_toxic for r in X.classify(docs.repartition(5), flags.repartition(3)).collect()}
    assert all(abs(again[i] - got[i].p_toxic) < 1e-9 for i in got)


def rows_of(present, dense, n):
    return X._Rows(np.cumsum([0, *map(len, present)]), np.array([i for p in present for i in p]), dense, n)


def test_later_links_learn_from_out_of_fold_probabilities():
    """The second category equals the first; its own features say nothing, the chain says it all."""
    rnd = np.random.default_rng(0)
    y = (rnd.random(400) < 0.5).astype(float)
    rows = rows_of([[int(v)] for v in y], np.zeros((400, 2)), 2)
    blind = rows_of([[] for _ in y], np.zeros((400, 2)), 2)
    fold = np.arange(400) % X.FOLDS
    weights, cuts, out = X.train_chain(rows, [rows] * X.FOLDS, [y, y], fold)
    assert ((out[1] >= cuts[1]) == y).all() and len(weights[1]) == len(weights[0]) + 1
    p = out[0][:, None]
    w = blind.fit(y, np.ones(400), p)
    assert ((blind.predict(w, p) >= 0.5) == y).all()
    seen = rows.fit(y, (fold != 0).astype(float), np.zeros((400, 0)))
    assert np.allclose(rows.predict(seen, np.zeros((400, 0)))[fold == 0], out[0][fold == 0])


def test_a_row_without_a_label_trains_no_link_of_it():
    rnd = np.random.default_rng(1)
    y = (rnd.random(300) < 0.5).astype(float)
    rows = rows_of([[int(v)] for v in y], np.zeros((300, 2)), 2)
    fold = np.arange(300) % X.FOLDS
    gaps = np.where(np.arange(300) % 4 == 0, np.nan, y)
    weights, _, out = X.train_chain(rows, [rows] * X.FOLDS, [gaps], fold)
    known = ~np.isnan(gaps)
    assert np.allclose(weights[0], rows.fit(np.nan_to_num(gaps), known.astype(float), np.zeros((300, 0))))
    assert ((out[0] >= 0.5) == y).all()


def test_out_of_fold_owes_nothing_to_own_labels(spark):
    """Labels by chance: a screen over all rows would find words that fit them, a screen in each fold doesn't."""
    rnd = random.Random(5)
    rows = [(i, " ".join(f"w{rnd.randrange(4000)}" for _ in range(120)), "x") for i in range(600)]
    labels = [(i, int(rnd.random() < 0.3)) for i in range(600)]
    docs, flags = frames(spark, rows, labels)
    chain = X.train_chain
    seen = {}

    def spy(full, by_fold, y, fold):
        got = chain(full, by_fold, y, fold)
        seen["y"], seen["p"] = y[0], got[2][0]
        return got

    X.train_chain = spy
    try:
        X.train(docs, flags)
    finally:
        X.train_chain = chain
    y, p = seen["y"], seen["p"]
    order = np.argsort(np.argsort(p))
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert abs(auc - 0.5) < 0.1


def test_real_kinds_in_a_chain(spark):
    """Junk by its own words: the second link needs the first one's probability as well as its own features."""
    rnd = random.Random(7)
    rows, labels = corpus(1200, 4)
    rows = [(i, t + (" qqjunk" * 3 if rnd.random() < 0.4 else ""), p) for i, t, p in rows]
    truth = {i: (y, 0 if "qqjunk" in t else 1) for (i, t, _), (_, y) in zip(rows, labels, strict=True)}
    flags = spark.createDataFrame([(i, truth[i][1], truth[i][0]) for i in truth if i % 2], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    got = {r.doc_id: r for r in X.classify(docs, X.with_kinds(flags), X.KINDS).collect()}
    held = [i for i in truth if i % 2 == 0]
    for name, want in (("toxic", lambda y, q: y), ("toxic_junk", lambda y, q: y and not q), ("toxic_prose", lambda y, q: y and q)):
        right = sum((name in got[i].categories.split(",")) == bool(want(*truth[i])) for i in held)
        assert right >= 0.97 * len(held), name
    assert all(got[i].is_toxic == (got[i].categories != "") for i in got)


def test_foreign_labels_and_repeated_ids_change_nothing(spark):
    rows, labels = corpus(600, 2)
    docs, flags = frames(spark, rows, labels)
    want = {r.doc_id: (r.is_toxic, r.p_toxic) for r in X.classify(docs, flags).collect()}
    assert sum(t for t, _ in want.values()) > 50
    foreign = spark.range(10**6, 10**6 + 300_000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    got = {r.doc_id: (r.is_toxic, r.p_toxic) for r in X.classify(docs, flags.unionByName(foreign)).collect()}
    assert {i: t for i, (t, _) in got.items()} == {i: t for i, (t, _) in want.items()} and all(abs(got[i][1] - want[i][1]) < 1e-9 for i in got)
    many = docs.unionByName(docs.where("doc_id = 11").crossJoin(spark.range(5000)).drop("id"))
    assert X.labelled(many, flags, ["toxic"]).count() == 600
    got = {r.doc_id: r.is_toxic for r in X.classify(many, flags).collect()}
    assert got == {i: t for i, (t, _) in want.items()}
    assert X.labelled(many, flags, ["toxic"], sample=100).count() == 100


def test_fit_reaches_the_optimum():
    """Against Newton's method on a dense copy."""
    rnd = np.random.default_rng(3)
    x = (rnd.random((300, 6)) < 0.3).astype(float)
    dense = rnd.random((300, 2))
    y = (rnd.random(300) < 1 / (1 + np.exp(-(x @ rnd.normal(0, 1, 6) - 0.5)))).astype(float)
    w = rows_of([list(np.flatnonzero(r)) for r in x], dense, 6).fit(y, np.ones(300), np.zeros((300, 0)), rounds=800)
    a = np.hstack([x, dense, np.ones((300, 1))])
    reg = np.diag([0.3] * 8 + [0.0])
    v = np.zeros(9)
    for _ in range(30):
        p = 1 / (1 + np.exp(-(a @ v)))
        v -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + reg, a.T @ (p - y) + reg @ v)
    assert np.abs(w - v).max() < 1e-2


def test_odd_rows(spark):
    rows, labels = corpus(300, 1)
    rows = rows + [(1000, None, None), (1001, "", ""), (None, "grob grobe vilx zorkig grobst", "x"), (3, rows[3][1], "x"), (1002, "da " * 100_000, "x")]
    docs, flags = frames(spark, rows, labels + [(2000, 1), (None, 1), (5, None), (3, labels[3][1])])
    got = X.classify(docs, flags).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[None].is_toxic and not by[1000].is_toxic and not by[1001].is_toxic and not by[1002].is_toxic
    for none in (flags.limit(0), flags.where("toxic = 0")):
        assert not any(r.is_toxic for r in X.classify(docs, none).collect())
        assert X.keep_clean(docs, none).count() == len(rows)
    assert X.classify(docs.limit(0), flags).count() == 0


def test_ids_of_any_type_and_clashing_columns(spark):
    rows, labels = corpus(300, 1)
    docs = spark.createDataFrame([(f"d{i}", t, "r", "p", 1.0) for i, t, _ in rows], "doc_id string, text string, raw string, row string, p double")
    flags = spark.createDataFrame([(f"d{i}", y) for i, y in labels], "doc_id string, toxic int")
    got = {r.doc_id: r.is_toxic for r in X.classify(docs, flags).collect()}
    assert sum(got[f"d{i}"] == bool(y) for i, y in labels) >= 295
    kept = X.keep_clean(docs, flags)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, t in got.items() if not t}
