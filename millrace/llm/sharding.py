"""Reproducible shuffle and sharding by a Feistel permutation with cycle walking.

Every row gets a global row number, the permutation maps the number to a position and
position p goes to shard ``p % n_shards``, slot ``p // n_shards``. The law is therefore
``rows``: shard sizes differ by one row at most and slots have no gaps. Row numbers follow
from the data alone (bucket, id, size, checksum), so partitioning, executors and reruns
don't matter, and shard and slot of a row number are computable without any table.

Only DataFrame functions run here.

Null and odd cases: a null text counts as no bytes (size is the overhead alone, checksum 0);
a null id is an id like any other, and one that is no integer counts as null; repeated rows each get a
position of their own; texts of any length are read whole; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

#: Fixed values of the round function: a Mersenne prime and a multiplier.
PRIME = 2147483647
MULTIPLIER = 48271
ROUNDS = 6
#: Rows are numbered bucket by bucket; a bucket should stay small enough to sort in memory.
MIN_BUCKETS = 1024
BUCKET_ROWS = 65536
#: Copies of one row are unfolded in chunks of this many.
CHUNK = 65536


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """One key below PRIME a round."""
    return [int.from_bytes(hashlib.md5(f"{seed}:{i}".encode()).digest()[:8], "big") % PRIME for i in range(rounds)]


def domain(n: int) -> tuple[int, int]:
    """The sides a, b of the smallest near-square rectangle that holds n cells."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permute(x: int, n: int, seed: int) -> int:
    """The position of row number x among n, computed without Spark."""
    a, b = domain(n)
    keys = round_keys(seed)
    while True:
        left, right = x % a, x // a
        for i, key in enumerate(keys):
            if i % 2 == 0:
                left = (left + _mix(right, key)) % a
            else:
                right = (right + _mix(left, key)) % b
        x = left + a * right
        if x < n:
            return x


def _mix(half: int, key: int) -> int:
    y = (half + key) % PRIME
    return (y * y % PRIME * MULTIPLIER + key) % PRIME


def permuted(row: Column, n: int, seed: int) -> Column:
    """``permute`` as a column. A walk passes at most the cells of the rectangle from n on,
    so that many further steps always suffice; few rows take any."""
    a, b = domain(n)
    keys = F.array(*[F.struct(F.lit(k).cast("long").alias("key"), F.lit(i % 2 == 0).alias("left")) for i, k in enumerate(round_keys(seed))])

    def mixed(half: Column, key: Column) -> Column:
        y = (half + key) % F.lit(PRIME)
        return ((y * y) % F.lit(PRIME) * F.lit(MULTIPLIER) + key) % F.lit(PRIME)

    def step(state: Column, k: Column) -> Column:
        return F.when(
            k["left"], F.struct(((state["l"] + mixed(state["r"], k["key"])) % F.lit(a)).alias("l"), state["r"].alias("r"))
        ).otherwise(F.struct(state["l"].alias("l"), ((state["r"] + mixed(state["l"], k["key"])) % F.lit(b)).alias("r")))

    def once(x: Column) -> Column:
        start = F.struct((x % F.lit(a)).cast("long").alias("l"), F.floor(x / F.lit(a)).cast("long").alias("r"))
        if n > 2**50:
            start = F.struct((x % F.lit(a)).cast("long").alias("l"), ((x - x % F.lit(a)) / F.lit(a)).cast("long").alias("r"))
        return F.aggregate(keys, start, step, lambda s: s["l"] + F.lit(a).cast("long") * s["r"])

    first = once(row)
    if a * b == n:
        return first
    walked = lambda x: F.aggregate(
        F.sequence(F.lit(1), F.lit(a * b - n)), x, lambda y, _: F.when(y < F.lit(n), y).otherwise(once(y))
    )
    # a one-element transform binds the first step, so that it isn't evaluated twice
    return F.transform(F.array(first), lambda y: F.when(y < F.lit(n), y).otherwise(walked(y)))[0]


def bucket_of(id_col: Column, crc: Column, buckets: int) -> Column:
    """A bucket from id and checksum by arithmetic that any SQL engine can repeat. The checksum
    spreads the rows of a hot id, or without one."""
    both = (F.pmod(F.coalesce(id_col, F.lit(0).cast("long")), F.lit(PRIME)) + crc) % F.lit(PRIME)
    return ((both * F.lit(MULTIPLIER)) % F.lit(PRIME)) % F.lit(buckets)


def shard_rows(docs: DataFrame, n_shards: int, seed: int = 20260818, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law), position.

    One narrow shuffle to fold equal rows, one to number buckets; texts never move.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col("doc_id").try_cast("long").alias("doc_id"),
        (F.octet_length(raw) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    folded = written(narrow.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")), "shard-keys")
    n = folded.agg(F.sum("n")).first()[0] or 0
    buckets = max(MIN_BUCKETS, math.ceil(n / BUCKET_ROWS))
    keyed = folded.withColumn("bucket", bucket_of(F.col("doc_id"), F.col("text_crc32"), buckets))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("bucket").agg(F.sum("n").alias("rows")).select(
        "bucket", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("bucket").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    numbered = keyed.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0))).join(offsets, "bucket")
    chunked = numbered.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / CHUNK))))
    unfolded = chunked.withColumn(
        "copy",
        F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1)),
    )
    placed = unfolded.select(
        "doc_id", "size", "text_crc32", permuted(F.col("offset") + F.col("before") + F.col("copy"), max(n, 1), seed).alias("position")
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("position") % n_shards).cast("int").alias("shard"),
        F.floor(F.col("position") / n_shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "position",
    )
