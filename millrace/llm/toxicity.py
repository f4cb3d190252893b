"""Toxicity categories by a chain of linear classifiers.

Categories are predicted in a fixed order. Each has a logistic model over the same features plus
the probabilities of the categories before it. While training, those probabilities come out of
fold: every document's are given by models that have not seen its fold, so a later model learns
from inputs as uncertain as those it meets when scoring.

Features are words and word beginnings of 3 to 6 letters. A screen keeps those whose presence
depends on a category's label (likelihood ratio), which leaves few; two more features say how many
words of a text carry a feature that tells the first category, and what share that is. Each fold has a screen of
its own, over the other folds, so out-of-fold probabilities owe nothing to a document's own label.
Whole texts are read.

Categories are columns of the labels table. ``with_kinds`` makes two more from the flags toxic and
quality: ``toxic_junk`` (toxic and of low quality) and ``toxic_prose`` (toxic and of high quality).
A document is toxic if any category of the chain holds for it.

Bounds: labels are first joined with the documents at hand; of the labelled ids ``sample`` (those of
smallest hash) train, each with one text, which bounds the rows on the driver. ``FEATURES`` features
a screen are kept. Scoring covers all documents and ships only the model.

Null and odd cases: a null or empty text has no features; a null label is no label, and a link
trains on the rows that have its label; a document labelled twice counts as toxic if one label says
so; of several texts under one labelled id the one of smallest hash trains; labels of absent
documents are ignored; without labels of both kinds nothing is flagged and the probability is the
share of positive labels (0 without any); rows with a null id are scored but never train; ids may be
of any type, and are compared as text; repeated rows are each scored; an empty table gives an empty
result; other columns, of any name, pass through ``keep_clean`` and are ignored by ``classify``.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import utf8, written

SAMPLE = 12_000
FEATURES = 2_000
FOLDS = 5
#: Least likelihood ratio of a feature, about one chance in a million.
SCREEN = 24.0
PREFIXES = (3, 4, 5, 6)
#: Counts held in a task before they are handed on.
HELD = 200_000
WORD = re.compile(r"[^\W_]+")


def words_of(raw: bytes | None) -> list[str]:
    return WORD.findall((raw or b"").decode("utf-8", "replace").lower())


def features_of(word: str) -> Iterator[str]:
    """The word itself, marked, and its beginnings."""
    yield word + "$"
    for n in PREFIXES:
        if len(word) >= n:
            yield word[:n]


@dataclass
class Model:
    """weights: one row a category, over [features..., log hits, share, earlier categories..., 1]."""

    categories: list[str]
    index: dict[str, int] = field(default_factory=dict)
    telling: frozenset[str] = frozenset()
    weights: list[np.ndarray] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    base: float = 0.0

    def __post_init__(self):
        self.starts = {f.rstrip("$")[:3] for f in self.index}

    def features(self, words: list[str]) -> tuple[list[int], float, float]:
        """Indices of the features present; log of telling words, their share."""
        present: set[int] = set()
        flagged: set[str] = set()
        for w in set(words):
            if w[:3] in self.starts:
                for f in features_of(w):
                    if (i := self.index.get(f)) is not None:
                        present.add(i)
                        if f in self.telling:
                            flagged.add(w)
        hits = sum(w in flagged for w in words) if flagged else 0
        return sorted(present), math.log1p(hits), min(1.0, 10 * hits / max(1, len(words)))

    def probabilities(self, words: list[str]) -> list[float]:
        if not self.weights:
            return [self.base] * len(self.categories)
        present, log_hits, share = self.features(words)
        out: list[float] = []
        n = len(self.index)
        for w in self.weights:
            z = w[present].sum() + w[n] * log_hits + w[n + 1] * share + float(np.dot(w[n + 2 : -1], out)) + w[-1]
            out.append(float(_sigmoid(z)))
        return out

    def cuts(self) -> list[float]:
        return self.thresholds or [2.0] * len(self.categories)

    def rejects(self, words: list[str]) -> bool:
        """Whether any category holds."""
        return any(p >= cut for p, cut in zip(self.probabilities(words), self.cuts(), strict=True))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class _Rows:
    """Sparse presence plus dense columns. ``starts``: where each row's indices begin in ``col``."""

    def __init__(self, starts: np.ndarray, col: np.ndarray, dense: np.ndarray, n: int):
        self.n, self.dense, self.col = n, dense, col.astype(np.int64)
        self.row = np.repeat(np.arange(len(dense)), np.diff(starts))

    def fit(self, y: np.ndarray, use: np.ndarray, extra: np.ndarray, rounds: int = 150, l2: float = 0.3) -> np.ndarray:
        """Regularized logistic regression on the rows in ``use``, by accelerated gradient steps
        scaled by each column's bound on curvature."""
        mask = use[self.row] > 0
        row, col = self.row[mask], self.col[mask]
        dense = np.hstack([self.dense, extra, np.ones((len(y), 1))]) * use[:, None]
        curve = np.concatenate([np.bincount(col, minlength=self.n), (dense**2).sum(axis=0)]) * 0.25
        busy = np.bincount(row, minlength=len(y)).max(initial=0) + dense.shape[1]
        step = 1.0 / (curve * min(busy, 12) + l2)
        w = np.zeros(self.n + dense.shape[1])
        ahead, t = w.copy(), 1.0
        for _ in range(rounds):
            z = np.bincount(row, weights=ahead[col], minlength=len(y)) + dense @ ahead[self.n :]
            r = (_sigmoid(z) - y) * use
            g = np.concatenate([np.bincount(col, weights=r[row], minlength=self.n), dense.T @ r]) + l2 * ahead
            g[-1] -= l2 * ahead[-1]
            nxt = ahead - step * g
            if np.dot(ahead - nxt, nxt - w) > 0:  # restart when the momentum points uphill
                t = 1.0
            t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
            ahead, w, t = nxt + (t - 1) / t2 * (nxt - w), nxt, t2
        return w

    def predict(self, w: np.ndarray, extra: np.ndarray) -> np.ndarray:
        dense = np.hstack([self.dense, extra, np.ones((len(self.dense), 1))])
        return _sigmoid(np.bincount(self.row, weights=w[self.col], minlength=len(dense)) + dense @ w[self.n :])


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1, nearest to one half among equals. Cuts below 0.35 are not tried: a
    model that knows nothing must not flag everything."""
    best = (-1.0, 0.0, 0.5)
    for cut in np.linspace(0.35, 0.75, 17):
        hit = float(((p >= cut) & (y == 1)).sum())
        f1 = 2 * hit / max(1.0, float((p >= cut).sum() + y.sum()))
        best = max(best, (round(f1, 6), -abs(cut - 0.5), float(cut)))
    return best[2]


def train_chain(full: _Rows, by_fold: list[_Rows], labels: list[np.ndarray], fold: np.ndarray) -> tuple[list[np.ndarray], list[float], list[np.ndarray]]:
    """Weights and thresholds of each link, and the out-of-fold probabilities.

    ``by_fold`` has the same rows under the features that each fold's own screen kept. A label that
    is not a number is unknown: its row trains no such link.
    """
    n = len(fold)
    weights, cuts, out = [], [], []
    earlier = np.zeros((n, 0))
    for y in labels:
        known = ~np.isnan(y)
        given = np.where(known, y, 0.0)
        p = np.zeros(n)
        for k, rows in enumerate(by_fold):
            test = fold == k
            if test.any():
                p[test] = rows.predict(rows.fit(given, (known & ~test).astype(float), earlier), earlier)[test]
        weights.append(full.fit(given, known.astype(float), earlier))
        cuts.append(_best_threshold(p[known], given[known]))
        out.append(p)
        earlier = np.hstack([earlier, p[:, None]])
    return weights, cuts, out


def _count_features(batches: Iterator[pa.RecordBatch], categories: int) -> Iterator[pa.RecordBatch]:
    """feature, fold, rows that hold it, and how many of these have each label."""
    seen: dict[tuple[int, tuple[int, ...]], Counter] = defaultdict(Counter)
    names = ["feature", "fold", *(f"c{i}" for i in range(categories + 1))]

    def flush() -> Iterator[pa.RecordBatch]:
        for (fold, flags), counts in seen.items():
            n = np.fromiter(counts.values(), np.int64, len(counts))
            own = [pa.array(n * flag) for flag in (1, *flags)]
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(np.full(len(n), fold, np.int32)), *own], names=names)
        seen.clear()

    for batch in batches:
        given = [[int((v or 0) > 0) for v in batch[f"y{i}"].to_pylist()] for i in range(categories)]
        for raw, fold, *flags in zip(batch["raw"], batch["fold"].to_pylist(), *given, strict=True):
            seen[fold, tuple(flags)].update({f for w in set(words_of(raw.as_py())) for f in features_of(w)})
            if sum(map(len, seen.values())) > HELD:
                yield from flush()
    yield from flush()


def _likelihood_ratio(p: np.ndarray, n: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """How much the presence of features (p positive and n negative rows of each) depends on the label."""
    share = (p + n) / (n_pos + n_neg)

    def term(seen: np.ndarray, total: int, share: np.ndarray) -> np.ndarray:
        return seen * np.log(np.where(seen > 0, seen / np.maximum(total * share, 1e-300), 1.0))

    g = 2 * (term(p, n_pos, share) + term(n, n_neg, share) + term(n_pos - p, n_pos, 1 - share) + term(n_neg - n, n_neg, 1 - share))
    return np.where((p + n >= 3) & (share < 1), g, 0.0)


def _tied(batches: Iterator[pa.RecordBatch], have: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The features that pass a screen: k (0: all folds, i + 1: all but fold i), feature, g, more.

    ``have``: for each k the rows and how many of them have each label. A feature passes that is
    tied to any label; ``more`` is how much more frequent it is where the first one holds."""
    for batch in batches:
        counts = np.stack([[batch[f"c{i}_{k}"].to_numpy() for k in range(FOLDS)] for i in range(len(have[0]))])
        for k, rows in have.items():
            held = counts.sum(axis=1) - (counts[:, k - 1] if k else 0)
            with_label = [i for i in range(1, len(rows)) if 0 < rows[i] < rows[0]]
            g = np.max([_likelihood_ratio(held[i], held[0] - held[i], rows[i], rows[0] - rows[i]) for i in with_label], axis=0, initial=0.0)
            at = np.flatnonzero(g >= SCREEN)
            pos, neg = held[1][at], (held[0] - held[1])[at]
            more = pos * (rows[0] - rows[1]) / np.maximum(neg * rows[1], 0.5)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), batch["feature"].take(pa.array(at)), pa.array(g[at]), pa.array(more)], names=["k", "feature", "g", "more"])


def _any(flags: list[Column]) -> Column:
    return functools.reduce(lambda x, y: x | y, flags)


def screens(sample: DataFrame, totals: dict[int, np.ndarray], features: int = FEATURES) -> list[list[tuple[str, float]]]:
    """The features most tied to the labels: over all folds, then over all but each one.

    A list of (feature, how much more frequent it is where the first label holds). ``totals`` has,
    for each fold, the rows and how many of them have each label. One counting job serves all the screens.
    """
    every = sum(totals.values())
    n = len(every)
    kind = ", ".join(["feature string", "fold int", *(f"c{i} long" for i in range(n))])
    counts = sample.select("raw", "fold", *[f"y{i}" for i in range(n - 1)]).mapInArrow(lambda it: _count_features(it, n - 1), kind)
    of = lambda i, k: F.sum(F.when(F.col("fold") == k, F.col(f"c{i}")).otherwise(0)).alias(f"c{i}_{k}")
    summed = counts.groupBy("feature").agg(*[of(i, k) for i in range(n) for k in range(FOLDS)])
    have = {0: every, **{k + 1: every - totals.get(k, 0 * every) for k in range(FOLDS)}}
    tied = summed.mapInArrow(lambda it: _tied(it, have), "k int, feature string, g double, more double")
    place = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("g"), "feature"))
    out: list[list[tuple[str, float]]] = [[] for _ in have]
    for r in sorted(tied.withColumn("place", place).where(F.col("place") <= features).collect(), key=lambda r: r["place"]):
        out[r["k"]].append((r["feature"], r["more"]))
    return out


def with_kinds(labels: DataFrame) -> DataFrame:
    """doc_id, toxic, toxic_junk, toxic_prose; the last two are unknown where toxic holds and quality is unknown."""
    toxic, good = F.col("toxic") > 0, F.col("quality") > 0
    kind = lambda held: (toxic & held).cast("int")
    return labels.select("doc_id", toxic.cast("int").alias("toxic"), kind(~good).alias("toxic_junk"), kind(good).alias("toxic_prose"))


KINDS = ("toxic", "toxic_junk", "toxic_prose")


def labelled(docs: DataFrame, labels: DataFrame, categories: Sequence[str], sample: int = SAMPLE) -> DataFrame:
    """The training rows: id, raw text, fold and the labels y0, y1 and so on.

    Only ids that ``docs`` hold are drawn from. Ids move without texts; the texts of the drawn ids
    come by a broadcast of these, and repeated rows of an id fold into one before they move.
    """
    named = F.col("doc_id").cast("string")
    flags = [F.max(F.col(c).cast("int")).alias(f"y{i}") for i, c in enumerate(categories)]
    known = labels.where(F.col("doc_id").isNotNull() & F.col(categories[0]).isNotNull()).groupBy(named.alias("id")).agg(*flags)
    here = docs.where(F.col("doc_id").isNotNull()).select(named.alias("id")).distinct()
    chosen = known.join(here, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample)  # bounds what is broadcast
    texts = docs.select(named.alias("id"), utf8("text").alias("raw")).join(F.broadcast(written(chosen, "toxic-ids")), "id")
    first = F.min_by("raw", F.struct(F.xxhash64("raw"), "raw")).alias("raw")
    one = texts.groupBy("id", *[f"y{i}" for i in range(len(categories))]).agg(first)
    one = one.repartition(max(8, docs.sparkSession.sparkContext.defaultParallelism), "id")  # counting features is worth all cores
    return one.withColumn("fold", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(FOLDS)).cast("int"))


def _featurize(batches: Iterator[pa.RecordBatch], models: list[Model]) -> Iterator[pa.RecordBatch]:
    """For each model the present features, log of hits and share."""
    for batch in batches:
        found = []
        for raw in batch["raw"]:  # the words of one text at a time
            words = words_of(raw.as_py())
            found.append([model.features(words) for model in models])
        keep = [n for n in batch.schema.names if n != "raw"]
        own, names = [], []
        for k in range(len(models)):
            rows = [f[k] for f in found]
            own += [pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.float64())]
            names += [f"present{k}", f"log_hits{k}", f"share{k}"]
        yield pa.RecordBatch.from_arrays([*(batch[n] for n in keep), *own], names=[*keep, *names])


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = ("toxic",), sample: int = SAMPLE) -> Model:
    """The chain over the given label columns."""
    names = list(categories)
    rows = written(labelled(docs, labels, categories, sample), "toxic-sample")
    sums = [F.count(F.lit(1)), *[F.count_if(F.col(f"y{i}") > 0) for i in range(len(names))]]
    totals = {r["fold"]: np.array(r["c"]) for r in rows.groupBy("fold").agg(F.array(*sums).alias("c")).collect()}
    n, n_pos = list(sum(totals.values()))[:2] if totals else (0, 0)
    if n_pos in (0, n):
        return Model(names, base=1.0 if n_pos else 0.0)
    models = [Model(names, {f: i for i, (f, _) in enumerate(kept)}, frozenset(f for f, more in kept if more > 4)) for kept in screens(rows, totals)]
    schema = T.StructType([f for f in rows.schema.fields if f.name != "raw"])
    for k in range(len(models)):
        schema = schema.add(f"present{k}", T.ArrayType(T.IntegerType())).add(f"log_hits{k}", T.DoubleType()).add(f"share{k}", T.DoubleType())
    table = rows.mapInArrow(lambda it: _featurize(it, models), schema).toArrow().combine_chunks().sort_by("id")  # ``sample`` rows at most
    column = lambda name: table[name].combine_chunks().to_numpy(zero_copy_only=False).astype(np.float64)

    def matrix(k: int) -> _Rows:
        present = table[f"present{k}"].combine_chunks()
        starts = np.concatenate([[0], np.cumsum(np.array(present.value_lengths()))])
        return _Rows(starts, present.flatten().to_numpy(zero_copy_only=False), np.stack([column(f"log_hits{k}"), column(f"share{k}")], axis=1), len(models[k].index))

    y = [np.where(np.isnan(v := column(f"y{i}")), np.nan, v > 0) for i in range(len(names))]
    model = models[0]
    model.weights, model.thresholds, _ = train_chain(matrix(0), [matrix(k + 1) for k in range(FOLDS)], y, table["fold"].to_numpy())
    return model


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = [model.probabilities(words_of(raw.as_py())) for raw in batch["raw"]]
        keep = [n for n in batch.schema.names if n != "raw"]
        yield pa.RecordBatch.from_arrays([*(batch[n] for n in keep), pa.array(p, pa.list_(pa.float64()))], names=[*keep, "p"])


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with its column raw replaced by p, the categories' probabilities."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "raw"]).add("p", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(lambda it: _score(it, shared.value), schema)


def _flags(model: Model) -> list[Column]:
    return [F.col("p")[i] >= F.lit(c) for i, c in enumerate(model.cuts())]


def classify(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = ("toxic",), sample: int = SAMPLE) -> DataFrame:
    """doc_id, a probability for each category, the categories that hold, is_toxic (any does)."""
    model = train(docs, labels, categories, sample)
    out = scored(docs.select("doc_id", utf8("text").alias("raw")), model)
    flags = _flags(model)
    held = F.array_join(F.filter(F.array(*[F.when(f, F.lit(c)) for f, c in zip(flags, model.categories, strict=True)]), lambda c: c.isNotNull()), ",")
    return out.select("doc_id", *[F.col("p")[i].alias(f"p_{c}") for i, c in enumerate(model.categories)], held.alias("categories"), _any(flags).alias("is_toxic"))


def keep_clean(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = ("toxic",), sample: int = SAMPLE) -> DataFrame:
    """The documents that no category of the chain holds for, all columns kept. Only texts go to Python, only verdicts return."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, categories, sample))

    @F.arrow_udf("boolean")
    def rejected(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for raws in texts:
            yield pa.array([shared.value.rejects(words_of(raw.as_py())) for raw in raws], pa.bool_())

    return docs.where(~rejected(utf8("text")))
