"""Shared storage and small helpers of the operators in this subpackage."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.storage import scratch, shared_dir, written

__all__ = ["bitmap_of", "frequent", "in_bitmap", "joined_by_share", "joined_in_parts", "named", "rolled", "scratch", "shared_dir", "utf8", "written"]

#: Least and most bits (powers of two) of a bitmap.
BITMAP_LEAST, BITMAP_MOST = 25, 28
#: Share of all rows from which on a key is dealt over parts; there are at most its inverse many such keys.
PART = 1 / 16384
#: Fewest rows of a part.
PART_LEAST = 1024
#: Odd factors that a shingle's words are mixed with.
STEP = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9, 0xABC98388FB8FAC03], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` words from each position on; none for fewer words."""
    from xxhash import xxh3_64_intdigest as h

    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(h, words), dtype=np.uint64, count=len(words))
    s = w[:n]
    for i in range(1, size):
        s = mixed(s * STEP[i % len(STEP)] + w[i : i + n])
    return s


def bitmap_of(values: DataFrame) -> bytes:
    """A bitmap of the longs in the only column of ``values``, one bit for each value's low bits: about
    16 bits a value, within fixed bounds. Few other values have their bit set; none of these is missed."""
    bits = 1 << min(BITMAP_MOST, max(BITMAP_LEAST, (16 * values.count()).bit_length()))
    at = F.pmod(F.col(values.columns[0]), F.lit(bits)).cast("long")
    pages = (
        values.select(at.alias("at"))
        .groupBy(F.expr("bitmap_bucket_number(at + 1)").alias("page"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at + 1))").alias("bits"))
    )
    page_bytes = 4096
    out = bytearray(bits // 8)
    for r in pages.toLocalIterator():
        start = (r["page"] - 1) * page_bytes
        out[start : start + page_bytes] = r["bits"]
    return bytes(out)


def in_bitmap(values: np.ndarray, bitmap: bytes) -> np.ndarray:
    """Which of the 64-bit values have their bit set."""
    at = values.view(np.uint64) & np.uint64(len(bitmap) * 8 - 1)
    held = np.frombuffer(bitmap, dtype=np.uint8)
    return (held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def utf8(text: str | Column) -> Column:
    """UTF-8 bytes of a text; null becomes empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text, F.lit("")).cast("binary")


def named(column: str) -> Column:
    """A column by its name, whatever signs that holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def frequent(counts: DataFrame, key: str) -> DataFrame:
    """key, parts: the keys of ``counts`` (key, n) with more than a ``PART`` of all rows, and how many such
    shares they have. There are at most ``1 / PART`` of them."""
    bound = max(PART_LEAST, math.ceil((counts.agg(F.sum("n")).first()[0] or 0) * PART))
    return counts.where(F.col("n") > bound).select(key, F.ceil(F.col("n") / bound).alias("parts"))


def joined_in_parts(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame, by: list[str]) -> DataFrame:
    """Inner join on ``key``, whose rows are counted in ``counts`` (key, n). Rows of a frequent key are dealt over
    parts by a hash of the columns ``by``; its rows of ``table`` go to each part. So no task gathers a key's rows."""
    hot = F.broadcast(frequent(counts, key).select(F.col(key).alias("_hot"), F.col("parts").alias("_parts")))
    mark = lambda df: df.join(hot, F.col(key) == F.col("_hot"), "left").drop("_hot")
    part = F.coalesce(F.pmod(F.xxhash64(*by), F.col("_parts")), F.lit(0).cast("long"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_parts"), F.lit(1).cast("long")) - 1))
    dealt, copied = (mark(df).withColumn("_part", p).drop("_parts") for df, p in ((rows, part), (table, every)))
    return dealt.join(copied, [key, "_part"]).drop("_part")


def joined_by_share(rows: DataFrame, key: Column, table: DataFrame, table_key: str, n: str, total: int, share: float = 0.001) -> DataFrame:
    """Left join of ``rows`` with a table of one row a key, whose column ``n`` counts the key's rows.

    Keys with at least ``share`` of all rows, of which there are at most ``1 / share``, go by
    broadcast, so no task gathers their rows. The rest are joined by key; rows already answered, or
    with a null key, are spread by a hash of the row. The table's other columns are added.
    """
    bound = max(100, math.ceil(total * share))
    others = [c for c in table.columns if c not in (table_key, n)]
    pick = lambda df, p: df.select(F.col(table_key).alias(f"{p}key"), *[F.col(c).alias(f"{p}{c}") for c in others])
    own = rows.columns
    marked = rows.withColumn("_key", key).join(F.broadcast(pick(table.where(F.col(n) >= bound), "_hot_")), F.col("_key") == F.col("_hot_key"), "left")
    apart = F.concat(F.lit("-"), F.xxhash64(*own).cast("string"))
    spread = F.when(F.col("_hot_key").isNull() & F.col("_key").isNotNull(), F.concat(F.lit("="), F.col("_key").cast("string"))).otherwise(apart)
    cold = pick(table.where(F.col(n) < bound), "_cold_").withColumn("_cold_key", F.concat(F.lit("="), F.col("_cold_key").cast("string")))
    joined = marked.withColumn("_spread", spread).join(cold, F.col("_spread") == F.col("_cold_key"), "left")
    return joined.select(*own, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in others])
