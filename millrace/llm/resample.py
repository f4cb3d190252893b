"""Importance resampling towards a target distribution.

Every feature (a run of words) falls into a bucket by its checksum. A bucket's gain is the logarithm of
how much more frequent it is in the target than in the documents, add-one smoothed and in whole
thousandths; a document's weight is the mean gain of its features. Gumbel noise from a digest of the
id is added, so that the documents with the highest scores are a draw without replacement by weight.

Weights are taken with arrays: a task cuts a text at once, looks up the buckets of its words and sums
the gains of a whole batch. Only counts of buckets are shuffled, at most ``buckets`` rows a task.

The draw is a radix selection: rows stand by descending score, then ascending id (null last). The key
is read digit by digit, 16 bits each: the rows that share the digits found so far are counted by the next
one, and the digit at which the count reaches k goes on. Leading bits that no row varies in are skipped. A
round reads a narrow table and gives at most 65,536 counts to the driver. The end is the exact k-th key and how many
rows before it. Only the selected rows are then dealt by range, sorted and ranked.

Null and odd cases: a null or empty text has no words, weight 0, and is drawn only if ``min_words`` is 0;
a null id is hashed as nothing after the seed and comes after every other id of its score; rows that share
score and id stand by features, then weight, and are copies of one row beyond that: copies fold with a
count, so a hot group is ranked as one row and unfolded again in chunks, and a cut through copies draws
exactly as many as are missing; texts of any length are read whole; without documents or without
target texts the formula holds as it is; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import utf8, written

#: Bits of a digit of the key: at most 65,536 counts a round.
DIGIT = 16
#: Entries of a worker's memo of words; longer words are not remembered.
MEMO, LONG_WORD = 400_000, 64
#: Selected rows in a range at most, as a rule, and copies of a row unfolded in one piece.
RANGE_ROWS, CHUNK = 500_000, 65536
LONG_SIGN = 1 << 63
#: Each byte as it counts: A to Z in lower case, other ASCII that is no digit or letter as a space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class _Buckets(dict):
    """The bucket of each word, kept for short words."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % self.n
        if len(word) <= LONG_WORD:
            if len(self) >= MEMO:
                self.clear()
            self[word] = bucket
        return bucket


def feature_buckets(raw: bytes | None, most_words: int, known: _Buckets) -> tuple[int, np.ndarray]:
    """(number of words, the buckets of all runs of 1 to ``most_words`` words) of a text."""
    words = (raw or b"").translate(FOLDED).split()
    parts = [np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))]
    for size in range(2, most_words + 1):
        runs = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
        parts.append(np.fromiter(map(known.__getitem__, runs), dtype=np.int64, count=len(runs)))
    return len(words), parts[0] if len(parts) == 1 else np.concatenate(parts)


def _tally(batches: Iterator[pa.RecordBatch], most_words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    known, counts = _Buckets(buckets), np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for raw in batch["raw"]:
            counts += np.bincount(feature_buckets(raw.as_py(), most_words, known)[1], minlength=buckets)
    some = np.flatnonzero(counts)
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, most_words: int = 1, buckets: int = 10_000) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket. A task adds up its own first."""
    own = texts.select(utf8("text").alias("raw")).mapInArrow(lambda it: _tally(it, most_words, buckets), "bucket long, n long")
    return own.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, most_words: int = 1, buckets: int = 10_000) -> np.ndarray:
    """The gain of each bucket, in thousandths. As many numbers as there are buckets reach the driver."""
    held = []
    for texts in (docs, target):
        counts = np.zeros(buckets, dtype=np.int64)
        for r in bucket_counts(texts, most_words, buckets).collect():  # bounded by the parameter
            counts[r["bucket"]] = r["n"]
        held.append(counts)
    (s, t), (all_s, all_t) = held, (int(h.sum()) for h in held)
    ratio = lambda i: (float(t[i]) + 1) * float(all_s + buckets) / ((float(s[i]) + 1) * float(all_t + buckets))
    return np.array([math.floor(1000 * math.log(ratio(i))) for i in range(buckets)], dtype=np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray, most_words: int) -> Iterator[pa.RecordBatch]:
    known = _Buckets(len(gain))
    for batch in batches:
        out = []
        for raw in batch["raw"]:
            words, found = feature_buckets(raw.as_py(), most_words, known)
            out.append((words, len(found), int(gain[found].sum()) // len(found) if len(found) else 0))
        columns = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_words", "n_features", "weight"])


def scored(docs: DataFrame, gain: np.ndarray, seed: int | str, most_words: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    narrow = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), utf8("text").alias("raw"))
    longs = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_words", "n_features", "weight")])
    rows = narrow.mapInArrow(lambda it: _weigh(it, gain, most_words), longs)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return rows.withColumn("score", F.col("weight") + noise)


def _bits(column: str, down: bool) -> Column:
    """A long whose unsigned order is the wanted order of the column."""
    turned = F.col(column).bitwiseXOR(F.lit(-LONG_SIGN).cast("long"))
    return F.bitwise_not(turned) if down else turned


def _varying(low: int, high: int) -> int:
    """How many low bits can differ between the least and the greatest value."""
    return ((low + LONG_SIGN) ^ (high + LONG_SIGN)).bit_length()


def _select(rows: DataFrame, column: str, down: bool, k: int) -> tuple[int, int]:
    """The value of the k-th row in the column's order, and how many rows come before all rows with it."""
    ends = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    varying, before, key = _varying(ends["low"], ends["high"]), 0, _bits(column, down)
    turned = ends["low"] + LONG_SIGN
    found = (((1 << 64) - 1 - turned if down else turned) >> varying) << varying
    left = rows
    while varying > 0:
        step = min(DIGIT, varying)
        varying -= step
        digit = F.shiftrightunsigned(key, varying).bitwiseAND(F.lit((1 << step) - 1))
        counts = sorted(left.groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect())  # at most 2 ** DIGIT rows
        for value, n in counts:
            if before + n >= k:
                break
            before += n
        found |= value << varying
        left = left.where(digit == value)
    value = ((1 << 64) - 1 - found if down else found) - LONG_SIGN
    return value, before


def kth_key(rows: DataFrame, k: int) -> tuple[int, int | None, int]:
    """(score, id, rows before) of the k-th of ``rows`` by descending score, then ascending id, null last."""
    score, before = _select(rows, "score", True, k)
    same = rows.where(F.col("score") == score)
    known = same.where(F.col("doc_id").isNotNull())
    n = known.count()
    if before + n < k:
        return score, None, before + n
    doc_id, ahead = _select(known, "doc_id", False, k - before)
    return score, doc_id, before + ahead


def _unfolded(rows: DataFrame, first: Column, count: Column) -> DataFrame:
    """Each row ``count`` times with its rank from ``first`` on; null ranks stay null. Large counts are dealt out in chunks."""
    own = [c for c in rows.columns if c not in ("n", "first")]
    dealt = rows.withColumns({"_n": count.cast("long"), "_first": first.cast("long")}).where("_n > 0")
    dealt = dealt.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(CHUNK).cast("long"))))
    dealt = dealt.withColumn("_i", F.explode(F.sequence(F.col("_from"), F.least(F.col("_n"), F.col("_from") + CHUNK) - 1)))
    return dealt.select(*own, (F.col("_first") + F.col("_i")).alias("rank"))


def drawn(rows: DataFrame, k: int) -> DataFrame:
    """doc_id, n_features, weight, score, rank of ``rows`` (those with the columns but rank, read several times): the
    first k are ranked from 1 on, all others have a null rank."""
    own = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if k <= 0:
        return rows.select(*own, unranked)
    score, doc_id, before = kth_key(rows, k)
    at = (F.col("score") == score) & F.col("doc_id").eqNullSafe(F.lit(doc_id).cast("long"))
    earlier = F.lit(False) if doc_id is None else F.coalesce(F.col("doc_id") < doc_id, F.lit(False))
    earlier = F.col("doc_id").isNotNull() if doc_id is None else earlier
    ahead = (F.col("score") > score) | ((F.col("score") == score) & earlier)
    folded = lambda part: part.groupBy(*own).agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight"]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(k / RANGE_ROWS))
    ranged = folded(rows.where(ahead)).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "draw-ranges")
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = ranged.groupBy("part").agg(F.sum("n").alias("rows")).select("part", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("first", F.coalesce(F.sum("n").over(inside), F.lit(0)) + 1).join(F.broadcast(offsets), "part")
    placed = placed.select(*own, "n", (F.col("first") + F.col("offset")).alias("first"))
    # rows with the very key of the cut: distinct ones by features and weight, of which there are few
    cut = folded(rows.where(at)).withColumn("first", F.coalesce(F.sum("n").over(Window.orderBy("n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    fit = F.greatest(F.lit(0), F.least(F.col("n"), F.lit(k - before) - F.col("first")))
    none = F.lit(None).cast("long")
    return (
        _unfolded(placed, F.col("first"), F.col("n"))
        .unionByName(_unfolded(cut, F.col("first") + before + 1, fit))
        .unionByName(_unfolded(cut, none, F.col("n") - fit))
        .unionByName(rows.where(~(ahead | at)).select(*own, unranked))
    )


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, most_words: int = 1, buckets: int = 10_000, seed: int | str = 2024) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; of those with at least ``min_words`` words, ``percent`` % are drawn."""
    rows = written(scored(docs, gains(docs, target, most_words, buckets), seed, most_words), "draw-scores")
    able = rows.where(F.col("n_words") >= min_words)
    ranks = drawn(able, percent * able.count() // 100)
    return ranks.unionByName(rows.where(F.col("n_words") < min_words).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
