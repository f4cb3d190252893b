"""Priority-ordered, quota-aware selection with duplicates claimed by selected rows only.

Sources are walked in order. Within a source, rows stand in a seeded order; the first row of each
prompt that no earlier source has *selected* is a candidate, and candidates are taken until their
tokens reach the quota, the crossing row included. Rows past the quota claim nothing.

So each source is cut at one key of its order, and the cuts say everything: a contested prompt goes to
the first source whose row of it stands before that source's cut. All cuts are found at once, again
and again under the claims that the last ones imply, until none moves. The first source's cut is right
at once, the second's one round later, so the rounds end with the cuts of the walk; as a rule most
cuts are right after two or three. A round sums tokens by cell of the order (the key's leading bits)
and looks into the one cell of each source that holds its cut; no window runs over a whole source.

Sources are numbered by their place, so any id will do, the empty one and null included.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.recipe import RecipeError
from millrace.sources.storage import written

CELL_ROWS = 4096
MOST_CELLS = 1 << 16


def order_key(seed: int | Column, row_id: Column) -> Column:
    """The seeded order: md5 hex of seed and a stable row key, the same in every engine."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), row_id.cast("string")).cast("binary"))


def cell_of(key: Column, cells: int) -> Column:
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(cells) / F.lit(2**32)).cast("long")


@dataclass(frozen=True)
class Part:
    """A source's place in the walk: its id and quota; no quota takes every candidate."""

    source_id: str | None
    quota: int | None


def heads(rows: DataFrame, source: str = "source_id") -> DataFrame:
    """The first row of each prompt in each source: source, prompt_hash, key, row_id, tokens.

    A partial aggregation runs before the shuffle, so a prompt with many copies doesn't gather.
    """
    first = F.min(F.struct("key", "row_id", "tokens"))
    return rows.groupBy(source, "prompt_hash").agg(first.alias("f")).select(source, "prompt_hash", "f.key", "f.row_id", "f.tokens")


def priority_select(rows: DataFrame, order: Sequence[Part], claimed: DataFrame | None = None, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Walk the sources of ``rows`` (source_id, row_id, prompt_hash, tokens, key) in ``order``.

    Gives the selected rows (source_id, row_id, prompt_hash, tokens) and per-source statistics
    (source_id, selected_rows, selected_tokens, duplicates_skipped). ``claimed`` holds prompt hashes
    that are taken from the start. With ``strict``, a source that can't fill its quota is an error.
    Rows of sources that ``order`` doesn't name are left out.
    """
    spark = rows.sparkSession
    places = spark.createDataFrame([(i, p.source_id, p.quota) for i, p in enumerate(order)], "turn int, place_id string, quota long")
    placed = rows.join(F.broadcast(places), F.col("source_id").eqNullSafe(F.col("place_id")))  # one row a source
    narrow = written(placed.select("turn", "row_id", "prompt_hash", F.col("tokens").cast("long").alias("tokens"), "key"), "select-rows")
    most = narrow.groupBy("turn").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    cells = min(MOST_CELLS, max(64, math.ceil(most / CELL_ROWS)))
    firsts = heads(narrow, "turn")
    if claimed is not None:
        firsts = firsts.join(claimed.select("prompt_hash").distinct(), "prompt_hash", "left_anti")
    shared = firsts.groupBy("prompt_hash").agg(F.count(F.lit(1)).alias("holders"))
    firsts = firsts.join(shared, "prompt_hash").withColumn("contested", F.col("holders") > 1).withColumn("cell", cell_of(F.col("key"), cells))
    firsts = written(firsts.drop("holders"), "select-heads")
    cuts = _cuts(firsts, places)
    ends = F.broadcast(_ends(firsts, cuts))  # one row a source
    before = F.col("end_key").isNull() | (F.struct("key", "row_id") <= F.struct(F.col("end_key").alias("key"), F.col("end_row").alias("row_id")))
    chosen = _alive(firsts, ends).join(ends, "turn").where(before)
    selected = written(chosen.join(F.broadcast(places), "turn").select("turn", F.col("place_id").alias("source_id"), "row_id", "prompt_hash", "tokens"), "selected")
    seen = narrow.join(ends, "turn").where(before).groupBy("turn").agg(F.count(F.lit(1)).alias("seen"))
    got = selected.groupBy("turn").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    figures = {r["turn"]: r for r in seen.join(got, "turn", "left").collect()}
    stats = []
    for i, part in enumerate(order):
        r = figures.get(i)
        n, tokens, rows_seen = (r["n"] or 0, r["t"] or 0, r["seen"]) if r else (0, 0, 0)
        if strict and part.quota is not None and tokens < part.quota:
            raise RecipeError(f"{part.source_id} has {tokens} of {part.quota} tokens")
        stats.append((part.source_id, n, tokens, rows_seen - n))
    kind = "source_id string, selected_rows long, selected_tokens long, duplicates_skipped long"
    return selected.drop("turn"), spark.createDataFrame(stats, kind)


def _ends(firsts: DataFrame, cuts: dict[int, tuple]) -> DataFrame:
    """turn, end_key, end_row of each source; null where it is taken whole."""
    kind = f"turn int, end_key string, end_row {firsts.schema['row_id'].dataType.simpleString()}"
    return firsts.sparkSession.createDataFrame([(i, *end) for i, end in sorted(cuts.items())], kind)


def _alive(firsts: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows of ``firsts`` whose prompt no earlier source takes, if sources are cut at ``ends``."""
    ended = firsts.where("contested").join(ends, "turn")
    inside = F.col("end_key").isNull() | (F.struct("key", "row_id") <= F.struct(F.col("end_key").alias("key"), F.col("end_row").alias("row_id")))
    holder = F.min(F.when(inside, F.col("turn"))).over(Window.partitionBy("prompt_hash"))  # as many rows as sources
    free = ended.withColumn("holder", holder).where(F.col("holder").isNull() | (F.col("turn") <= F.col("holder"))).select(*firsts.columns)
    return firsts.where("not contested").unionByName(free)


def _cuts(firsts: DataFrame, places: DataFrame) -> dict[int, tuple]:
    """The (key, row id) at which each source's running total first reaches its quota; (None, None)
    where it never does or there is no quota. At least the first row is before any cut."""
    quotas = {r["turn"]: r["quota"] for r in places.collect()}
    cuts: dict[int, tuple] = dict.fromkeys(quotas, (None, None))
    open_sources = F.broadcast(places.where(F.col("quota").isNotNull()).select("turn", "quota"))
    if all(q is None for q in quotas.values()):
        return cuts
    plain = written(firsts.where("not contested").groupBy("turn", "cell").agg(F.sum("tokens").alias("t")), "select-sums")
    contested = written(firsts.where("contested"), "select-contested")
    # the first round supposes that nothing is claimed, any later one what the round before implies
    ends = None
    while True:
        free = contested if ends is None else _alive(contested, F.broadcast(ends))
        sums = plain.unionByName(free.groupBy("turn", "cell").agg(F.sum("tokens").alias("t"))).groupBy("turn", "cell").agg(F.sum("t").alias("t"))
        upto = Window.partitionBy("turn").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)  # over a source's cells
        reached = sums.withColumn("cum", F.sum("t").over(upto)).join(open_sources, "turn").where(F.col("cum") >= F.col("quota"))
        crossing = reached.groupBy("turn", "quota").agg(F.min(F.struct("cell", (F.col("cum") - F.col("t")).alias("before"))).alias("c"))
        crossing = F.broadcast(crossing.select("turn", "quota", "c.cell", "c.before"))  # one row a source
        candidates = firsts.where("not contested").unionByName(free).join(crossing, ["turn", "cell"])
        inside = Window.partitionBy("turn").orderBy("key", "row_id").rowsBetween(Window.unboundedPreceding, 0)  # over one cell
        hit = candidates.withColumn("cum", F.sum("tokens").over(inside) + F.col("before")).where(F.col("cum") >= F.col("quota"))
        found = {r["turn"]: (r["m"]["key"], r["m"]["row_id"]) for r in hit.groupBy("turn").agg(F.min(F.struct("key", "row_id")).alias("m")).collect()}
        now = {i: found.get(i, (None, None)) for i in cuts}
        if now == cuts and ends is not None:
            return cuts
        cuts, ends = now, _ends(firsts, now)


def claims(selected: DataFrame) -> DataFrame:
    """Who owns each prompt; the seed of later audits."""
    return selected.select("prompt_hash", "source_id")
