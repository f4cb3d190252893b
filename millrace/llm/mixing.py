"""Mixing of sources to target weights by capped water-filling, then seeded repetitions.

Sources weigh by rank in code-point order (null last). They share ``budget`` of all words by
weight; a source whose share exceeds ``max_epochs`` times its size stops there and its excess
goes to the others by weight, until none is above. A document is then taken
``floor(target / size of its source)`` times, and once more if it lies in the first part of
its source's seeded order: documents stand by md5(seed, id, md5 of the text), and those whose middle
word comes before the missing words are the ones taken again. A source so misses its target by half a
document at most.

Only DataFrame functions run here. Texts are never shuffled: the order is cut at one key a
source, and a document compares its own key to that cut. Rows equal in id, text and source share a
key; if the cut falls among such copies, so many of them are taken again as still fit. Only these
copies are folded, counted and unfolded again, so a group of any size is split exactly.

Null and odd cases: a null text has no words; a null source is a source, ranked last; a null id
sorts as an id of its own; rows that share an id alone are documents of their own; texts of any length
are counted whole; of copies that differ in other columns, those come first whose row has the
smaller digest; a mix without words has targets of 0; an empty table gives an empty result; other
columns, of any name, pass through ``mix`` and are ignored by ``mix_digest``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import named, written

#: A run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents in one cell of the order; only the cell that holds a source's cut is sorted.
CELL_ROWS = 4096
#: Parts of a split group of copies that differ in other columns; no window covers the whole group.
SLOTS = 4096
#: Copies of one row are unfolded in chunks of this many.
CHUNK = 65536
#: A row as JSON without loss.
EXACT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    """Place in the seeded order, by id and a digest of the text. Rows with equal keys are copies."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    digest = F.md5(text.cast("binary"))
    return F.md5(F.concat(F.lit(f"{seed}:"), part(doc_id.cast("string")), F.lit(":"), part(digest)).cast("binary"))


def _cell(key: Column, cells: int) -> Column:
    """Cells follow the key's order: the key's first 32 bits, scaled."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(cells) / F.lit(2**32)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: tuple[int, int] = (3, 2), max_epochs: int = 2) -> DataFrame:
    """source, source_size, weight, target of (source, source_size) rows, one row a source.

    In ascending order of cap per weight, a source is clamped if and only if its cap is no more
    than its share of what the sources before it have left; the first that isn't ends the
    clamping. Sums are decimals, so nothing overflows. The windows run over sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.array(*[F.lit(w) for w in weights])[F.col("rank") % len(weights)].cast("long")
    )
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")), "rank")
    ahead, all_rows = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    num, den = budget
    filled = (
        ranked.withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("left_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(ahead), F.lit(0)))
        .withColumn("taken_before", F.coalesce(F.sum("source_size").over(ahead), F.lit(0)) * max_epochs)
        # budget left, times den
        .withColumn("left", F.col("total") * num - F.col("taken_before") * den)
        .withColumn("over", wide("source_size") * (max_epochs * den) * wide("left_weight") > wide("left") * wide("weight"))
        .withColumn("open", F.max("over").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)))
    )
    share = F.struct(F.col("left").alias("left"), F.col("left_weight").alias("left_weight"))
    first_open = F.min(F.when(F.col("open"), F.struct(F.col("left_weight") * -1, share))).over(all_rows)
    return filled.withColumn("at", first_open).select(
        "source",
        "source_size",
        "weight",
        F.when(
            F.col("open"),
            F.col("at")["col2"]["left"].cast("double") / F.lit(float(den)) * F.col("weight").cast("double") / F.col("at")["col2"]["left_weight"].cast("double"),
        )
        .otherwise(F.col("source_size").cast("double") * float(max_epochs))
        .alias("target"),
    )


def plan_mix(docs: DataFrame, seed: int, **shares) -> tuple[DataFrame, DataFrame]:
    """The narrow table (doc_id, source, size, key) and the plan: for each source its size, target,
    whole repetitions, the last key that is taken once more, and how many copies of that key are."""
    narrow = written(
        docs.select(
            F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), order_key(F.col("doc_id"), F.col("text"), seed).alias("key")
        ),
        "mix-sizes",
    )
    cells = max(256, math.ceil(narrow.count() / CELL_ROWS))
    by_cell = narrow.groupBy("source", _cell(F.col("key"), cells).alias("cell")).agg(F.sum("size").alias("cell_size"))
    by_cell = written(by_cell, "mix-cells")
    plan = (
        targets(by_cell.groupBy("source").agg(F.sum("cell_size").alias("source_size")), **shares)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    plan = written(plan, "mix-targets")
    ahead = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    located = by_cell.withColumn("before", F.coalesce(F.sum("cell_size").over(ahead), F.lit(0)))
    keyed = plan.select(F.col("source").alias("plan_source"), "rest")
    located = located.join(keyed, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    cut_cell = written(
        located.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("cell_size"))).select(
            F.col("source").alias("cut_source"), F.col("cell").alias("cut_cell"), "before", "rest"
        ),
        "mix-cuts",
    )
    inside = narrow.withColumn("cell", _cell(F.col("key"), cells)).join(
        cut_cell, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("cell") == F.col("cut_cell"))
    )
    # copies fold before the window, so that it never runs over a hot group's rows
    folded = inside.groupBy("source", "key", "size", "before", "rest").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(earlier), F.lit(0))
    # copies whose middle word comes no later than the rest: the i-th of them has it at start + (i - 1/2) * size
    fits = F.when(F.col("size") > 0, F.floor(((F.col("rest") - F.col("start")) * 2 + F.col("size")) / (F.col("size") * 2))).otherwise(
        F.when(F.col("start") <= F.col("rest"), F.col("n")).otherwise(F.lit(0))
    )
    last = (
        folded.withColumn("start", start)
        .withColumn("fits", F.least(F.col("n"), fits).cast("long"))
        .where(F.col("fits") > 0)
        .groupBy(F.col("source").alias("last_source"))
        .agg(F.max(F.struct("key", "fits", "n")).alias("last"))
    )
    cuts = cut_cell.join(last, F.col("cut_source").eqNullSafe(F.col("last_source")), "left").select(
        "cut_source", "cut_cell", F.col("last.key").alias("last_key"), F.col("last.fits").alias("last_fits"), F.col("last.n").alias("last_n")
    )
    plan = plan.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
        F.col("source").alias("plan_source"), "source_size", "target", "whole", "rest", "cut_cell", "last_key", "last_fits", "last_n"
    )
    return narrow, written(plan.withColumn("cells", F.lit(cells).cast("long")), "mix-plan")


def _taken(rows: DataFrame, plan: DataFrame, own: list[str]) -> DataFrame:
    """``own`` columns and times of ``rows`` (own columns, source, key): how often each row is taken.

    Only the copies of a cut key that is split need more than a look at the plan, and they are alike
    in id, text and source: they fold, are ranked by a digest of their other columns, and unfold again.
    """
    cell = F.floor(F.conv(F.substring(F.col("key"), 1, 8), 16, 10).cast("long") * F.col("cells") / F.lit(2**32)).cast("long")
    again = (cell < F.col("cut_cell")) | ((cell == F.col("cut_cell")) & (F.col("key") <= F.col("last_key")))
    split = F.coalesce((F.col("key") == F.col("last_key")) & (F.col("last_fits") < F.col("last_n")), F.lit(False))
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    plain = planned.where(~split).select(*own, (F.col("whole") + F.when(F.coalesce(again, F.lit(False)), F.lit(1)).otherwise(F.lit(0))).alias("times"))
    if plan.where("last_fits < last_n").isEmpty():
        return plain
    # columns of any type fold by a digest of all of them; equal digests are equal rows
    digest = F.sha2(F.to_json(F.struct(*[named(c) for c in own]), EXACT), 256)
    hashed = planned.where(split).withColumn("h", digest)
    one = [F.any_value(named(c)).alias(c) for c in own]
    folded = written(hashed.groupBy("plan_source", "h", "whole", "last_fits").agg(F.count(F.lit(1)).alias("n"), *one), "mix-split")
    by_slot = folded.groupBy("plan_source", _slot(F.col("h")).alias("slot")).agg(F.sum("n").alias("rows"))
    ahead = Window.partitionBy("plan_source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_slot.select(F.col("plan_source").alias("slot_source"), "slot", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("offset"))
    placed = folded.withColumn("own_slot", _slot(F.col("h"))).join(offsets, F.col("plan_source").eqNullSafe(F.col("slot_source")) & (F.col("own_slot") == F.col("slot")))
    within = Window.partitionBy("plan_source", "slot").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("place", F.col("offset") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    more = F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), F.col("last_fits") - F.col("place")))
    halves = F.array(F.struct(more.alias("rows"), (F.col("whole") + 1).alias("times")), F.struct((F.col("n") - more).alias("rows"), F.col("whole").alias("times")))
    counted = placed.select(*own, F.explode(halves).alias("half")).select(*own, F.col("half.rows").alias("rows"), F.col("half.times").alias("times"))
    return plain.unionByName(_unfolded(counted, "rows"))


def _slot(h: Column) -> Column:
    return F.pmod(F.xxhash64(h), F.lit(SLOTS))


def _unfolded(rows: DataFrame, count: str) -> DataFrame:
    """Each row as often as ``count`` says; a large count is dealt out in chunks first."""
    dealt = rows.where(F.col(count) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / CHUNK).cast("long"))))
    dealt = dealt.withColumn("left", F.least(F.lit(CHUNK).cast("long"), F.col(count) - F.col("chunk") * CHUNK)).repartition("chunk")
    return dealt.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("left")))).drop("chunk", "left", "one", count)


def mix_digest(docs: DataFrame, seed: int = 20260818, **shares) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    narrow, plan = plan_mix(docs, seed, **shares)
    timed = _taken(narrow.select("doc_id", "size", F.col("source").alias("own_source"), "source", "key"), plan, ["doc_id", "size", "own_source"])
    sized = plan.select("plan_source", "source_size", "target")
    return timed.join(sized, F.col("own_source").eqNullSafe(F.col("plan_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).cast("long").alias("taken")
    )


def mix(docs: DataFrame, seed: int = 20260818, **shares) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    _, plan = plan_mix(docs, seed, **shares)
    own = docs.columns
    packed = docs.select(F.struct(*[named(c) for c in own]).alias("row"), F.col("source"), order_key(F.col("doc_id"), F.col("text"), seed).alias("key"))
    taken = _taken(packed, plan, ["row"])
    copies = taken.where(F.col("times") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return copies.select(*[F.col("row")[c].alias(c) for c in own])
