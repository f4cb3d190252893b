"""Packing rows into bins of a fixed number of tokens, by the histogram of their lengths.

Rows of one length are alike, so the plan is made for counts: lengths go down from the longest, and each is put where it fits
best, into as many bins of the same filling at once as there are. A plan is a list of fillings with a number of bins each,
about twice as many as there are lengths, of which a bin's capacity bounds the number; so it is made on the driver from one row a
length, however many rows there are. Rows are then dealt to the places of their length by rank in a hashed order.

Null and odd cases: a row without tokens (null, 0 or less) is in no bin; one longer than a bin is an error, since rows are never
cut; rows that share an id are rows of their own; an empty table has no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.rank import ranked
from millrace.operators.select import order_key
from millrace.plans.recipe import RecipeError

CAPACITY = 16_384


@dataclass(frozen=True)
class Filling:
    """``bins`` bins that hold the same lengths: (length, how many), longest first."""

    parts: tuple[tuple[int, int], ...]
    bins: int


def fillings(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Filling]:
    """Bins for so many rows of each length: longest first, each into the fullest bins that still take it."""
    free: dict[int, list[list]] = defaultdict(list)  # room left -> [parts, bins]
    rooms: list[int] = []
    done: list[Filling] = []

    def put(parts: tuple, bins: int, room: int) -> None:
        if bins and not room:
            done.append(Filling(parts, bins))
        elif bins:
            if not free[room]:
                insort(rooms, room)
            free[room].append([parts, bins])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        if not 0 < length <= capacity:
            raise RecipeError(f"rows of {length} tokens don't fit into bins of {capacity}")
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, (parts, bins) = capacity, ((), -(-left // (capacity // length)))
            else:
                room = rooms[at]
                parts, bins = free[room].pop()
                if not free[room]:
                    rooms.pop(at)
            each = room // length
            full = min(bins, left // each)
            put((*parts, (length, each)), full, room - each * length)
            left -= full * each
            rest = bins - full
            if rest and left:  # fewer than ``each`` are left: one bin takes them all
                put((*parts, (length, left)), 1, room - left * length)
                left, rest = 0, rest - 1
            put(parts, rest, room)
    return done + [Filling(parts, bins) for groups in free.values() for parts, bins in groups]


def places(plan: list[Filling]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first bin, rows a bin, first offset) of every run of like places."""
    out, ranks, first_bin = [], defaultdict(int), 0
    for f in plan:
        offset = 0
        for length, each in f.parts:
            out.append((length, ranks[length], ranks[length] + f.bins * each, first_bin, each, offset))
            ranks[length] += f.bins * each
            offset += length * each
        first_bin += f.bins
    return out


def packed(rows: DataFrame, tokens: str = "tokens", row_id: str = "row_id", capacity: int = CAPACITY, seed: int = 0) -> DataFrame:
    """``rows`` with ``bin`` and ``offset``: bins are numbered from 0 and rows of a bin don't overlap."""
    spark = rows.sparkSession
    sized = rows.where(F.col(tokens) > 0)
    counts = {r[tokens]: r["n"] for r in sized.groupBy(tokens).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows, or an error
    runs = spark.createDataFrame(places(fillings(counts, capacity)), "_length long, _from long, _to long, _bin long, _each long, _offset long")
    placed = ranked(sized.withColumn("_key", order_key(seed, F.col(row_id))), [tokens], "_key", [row_id], "_rank")
    here = (F.col(tokens) == F.col("_length")) & (F.col("_rank") > F.col("_from")) & (F.col("_rank") <= F.col("_to"))
    within = F.col("_rank") - 1 - F.col("_from")
    joined = placed.join(F.broadcast(runs), here)  # its size follows from the capacity
    own = [F.col(c) for c in rows.columns]
    binned = joined.select(*own, (F.col("_bin") + F.expr("(_rank - 1 - _from) div _each")).alias("bin"), (F.col("_offset") + within % F.col("_each") * F.col("_length")).alias("offset"))
    none = F.lit(None).cast("long")
    return binned.unionByName(rows.where(F.coalesce(F.col(tokens) <= 0, F.lit(True))).select(*own, none.alias("bin"), none.alias("offset")))


def filled(bins: DataFrame, tokens: str = "tokens", capacity: int = CAPACITY) -> DataFrame:
    """One row: rows, tokens, bins, overfull (bins beyond their capacity), overlapping (rows that start before the last one
    ends) and fill (share of the bins that is taken). A bin has at most ``capacity`` rows, so the window is bounded."""
    from pyspark.sql import Window

    end = F.lag(F.col("offset") + F.col(tokens)).over(Window.partitionBy("bin").orderBy("offset", tokens))
    marked = bins.where(F.col("bin").isNotNull()).withColumn("_late", F.coalesce(F.col("offset") < end, F.lit(False)))
    per = marked.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum(tokens).alias("t"), F.max(F.col("offset") + F.col(tokens)).alias("end"), F.count_if("_late").alias("late"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("bins"),
        F.count_if(F.col("end") > capacity).alias("overfull"), F.coalesce(F.sum("late"), F.lit(0)).alias("overlapping"),
        (F.sum("t") / (F.count(F.lit(1)) * capacity)).alias("fill"),
    )
