"""Selection from a stream: a quota for each source and one claim for each prompt, exact in the order of arrival.

Rows are considered as they arrive. A row is taken if its source's quota isn't reached yet and no row taken before
holds its prompt; the row that crosses the quota is taken, rows past it claim nothing. Arrival is the number of the
micro-batch, then ``at``, ``row_id`` and the source's place, so the result follows from the order alone, however it is cut into batches.

Claims belong to prompts and quotas to sources, and each needs the other: a prompt that a full source passes over is
free for the next one. State under one key can't hold both unless all rows meet in one task, so state is kept in tables:
claims in a ``ClaimStore``, joined where they lie, totals as one row a source. A micro-batch is cut at one place of
each source's order, and all cuts are found together: at first no source is cut, so that a prompt goes to its first
row; each round cuts the sources under the claims that the cuts before imply. Cuts only move down and never below
the true ones, and each round settles at least the next true one, so the rounds end with the walk's cuts.

A micro-batch is done once its totals stand in the folder. One that is repeated after a failure replaces what it had written
and doesn't see its own claims; one that is done is passed over. So rows are taken exactly once, across restarts too.

Null and odd cases: rows without a prompt, tokens or a listed source are left out; a null ``at`` comes first in its batch;
repeated rows are one prompt; a quota below 1 counts as 1, so that a source takes a row at least; without a quota all new
prompts are taken; an empty batch takes nothing; other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.claims import BUCKETS, ClaimStore
from millrace.operators.select import Part
from millrace.sources.scan import Store
from millrace.sources.storage import temporary, written

CELL_ROWS = 65_536
#: Names of batches have as many digits, so that they sort.
DIGITS = 12


def _place(prefix: str = "") -> Column:
    return F.struct(F.col(f"{prefix}at").alias("at"), F.col(f"{prefix}row_id").alias("row_id"))


def _inside() -> Column:
    """Up to the source's end; without an end, all."""
    return ~F.col("cut") | (_place() <= _place("end_"))


class StreamSelection:
    """The selection below a folder of any store, for the sources and quotas in ``parts``."""

    def __init__(self, folder: str, parts: Sequence[Part], buckets: int = BUCKETS, cell_rows: int = CELL_ROWS, merge_every: int = 64):
        self.folder, self.parts, self.buckets, self.cell_rows, self.merge_every = folder, list(parts), buckets, cell_rows, merge_every

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take from what is there now, then stop. ``stream``: source_id, row_id, prompt_hash, tokens, at."""
        return stream.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def done(self, spark: SparkSession) -> list[int]:
        """The batches that are done."""
        names = (e.path.rsplit("/", 1)[-1] for e in Store(spark, self.folder).matching("totals/*.json"))
        return sorted(int(n.removesuffix(".json")) for n in names)

    def totals(self, spark: SparkSession, below: int | None = None) -> dict[str | None, tuple[int, int]]:
        """Rows and tokens taken of each source, by all batches or those before ``below``."""
        known = [b for b in self.done(spark) if below is None or b < below]
        rows = json.loads(Store(spark, self.folder).text(f"totals/{known[-1]:0{DIGITS}d}.json")) if known else []
        return {s: (n, t) for s, n, t in rows}

    def taken(self, spark: SparkSession) -> DataFrame | None:
        """source_id, row_id, prompt_hash, tokens, at, batch of all rows taken; None before the first batch."""
        known = self.done(spark)
        if not known:
            return None
        rows = spark.read.option("recursiveFileLookup", "false").parquet(Store(spark, self.folder).uri("taken"))
        return rows.withColumn("batch", F.col("batch").cast("long")).where(F.col("batch") <= known[-1])

    def take(self, batch: DataFrame, number: int) -> None:
        """One micro-batch."""
        spark = batch.sparkSession
        store, name = Store(spark, self.folder), f"{number:0{DIGITS}d}"
        if store.exists(f"totals/{name}.json"):
            return
        totals = self.totals(spark, below=number)
        left = [(i, p.source_id, None if p.quota is None else max(p.quota, 1) - totals.get(p.source_id, (0, 0))[1]) for i, p in enumerate(self.parts)]
        places = spark.createDataFrame([x for x in left if x[2] is None or x[2] > 0], "turn int, place_id string, left long")
        claims = ClaimStore(spark, store.uri("claims"), self.buckets)
        known = [b for b in self.done(spark) if b < number]
        with temporary(spark):
            if known and number % self.merge_every == 0:
                claims.compact(f"{known[-1]:0{DIGITS}d}")  # only batches that are done and won't be repeated
            chosen = self._chosen(batch, places, claims, name)
            chosen.write.mode("overwrite").parquet(store.uri(f"taken/batch={name}"))
            chosen = spark.read.schema(chosen.schema).parquet(store.uri(f"taken/batch={name}"))
            claims.append(chosen, name)
        for r in chosen.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).collect():  # one row a source
            n, t = totals.get(r["source_id"], (0, 0))
            totals[r["source_id"]] = (n + r["n"], t + r["t"])
        store.put(f"totals/.{name}", json.dumps([[s, *x] for s, x in totals.items()]))
        store.move(f"totals/.{name}", f"totals/{name}.json")

    def _chosen(self, batch: DataFrame, places: DataFrame, claims: ClaimStore, name: str) -> DataFrame:
        rows = batch.select("source_id", "row_id", "prompt_hash", F.col("tokens").cast("long").alias("tokens"), "at").where("prompt_hash is not null and tokens is not null")
        placed = rows.join(F.broadcast(places), F.col("source_id").eqNullSafe(F.col("place_id")))  # one row a source
        # of a source's rows of one prompt only the first can be taken; a partial aggregation runs before the shuffle
        first = F.min(F.struct("at", "row_id", "tokens")).alias("f")
        firsts = written(placed.groupBy("turn", "prompt_hash").agg(first).select("turn", "prompt_hash", "f.*"), "walk-firsts")
        fresh = written(claims.unclaimed(firsts, but=name), "walk-fresh")
        cells = max(1, math.ceil(fresh.count() / self.cell_rows))
        holders = fresh.groupBy("prompt_hash").agg(F.count(F.lit(1)).alias("holders"))
        marked = fresh.join(holders, "prompt_hash").withColumn("contested", F.col("holders") > 1).drop("holders")
        # cells of about equal size, whatever the places are; the table fixes them
        celled = written(marked.repartitionByRange(cells, "at", "row_id").withColumn("cell", F.spark_partition_id()), "walk-cells")
        ends = _ends(celled, places)
        chosen = _holding(celled, ends).join(F.broadcast(ends), "turn").where(_inside())
        return chosen.join(F.broadcast(places), "turn").select(F.col("place_id").alias("source_id"), "row_id", "prompt_hash", "tokens", "at")


def _holding(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows that get their prompt if sources are cut at ``ends``: its first before its source's end."""
    alive = rows.where("contested").join(F.broadcast(ends), "turn").where(_inside())
    order = Window.partitionBy("prompt_hash").orderBy("at", "row_id", "turn")  # as many rows as sources
    won = alive.withColumn("nth", F.row_number().over(order)).where("nth = 1").select(*rows.columns)
    return rows.where("not contested").unionByName(won)


def _ends(rows: DataFrame, places: DataFrame) -> DataFrame:
    """turn, cut, end_at, end_row_id: where the running total of each source reaches what it has left, if it does."""
    spark = rows.sparkSession
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("at", "row_id")}
    turns = [r["turn"] for r in places.select("turn").collect()]
    made = lambda now: spark.createDataFrame([(i, i in now, *now.get(i, (None, None))) for i in turns], f"turn int, cut boolean, end_at {kinds['at']}, end_row_id {kinds['row_id']}")
    limits = F.broadcast(places.where("left is not null").select("turn", "left"))
    before: dict[int, tuple] = {}
    ends = made(before)
    while True:
        held = _holding(rows, ends)
        sums = held.groupBy("turn", "cell").agg(F.sum("tokens").alias("t"))
        upto = Window.partitionBy("turn").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)  # over a source's cells
        reached = sums.withColumn("cum", F.sum("t").over(upto)).join(limits, "turn").where(F.col("cum") >= F.col("left"))
        crossing = reached.groupBy("turn", "left").agg(F.min(F.struct("cell", (F.col("cum") - F.col("t")).alias("ahead"))).alias("c"))
        crossing = F.broadcast(crossing.select("turn", "left", "c.cell", "c.ahead"))  # one row a source
        inside = Window.partitionBy("turn").orderBy("at", "row_id").rowsBetween(Window.unboundedPreceding, 0)  # over one cell
        hits = held.join(crossing, ["turn", "cell"]).withColumn("cum", F.sum("tokens").over(inside) + F.col("ahead")).where(F.col("cum") >= F.col("left"))
        now = {r["turn"]: (r["m"]["at"], r["m"]["row_id"]) for r in hits.groupBy("turn").agg(F.min(_place()).alias("m")).collect()}
        if now == before:
            return ends
        before, ends = now, made(now)
