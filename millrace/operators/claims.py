"""Claimed prompts that outlive a build: a table bucketed by hash, which builds append to and audits ask.

The table lies in a folder of any store, partitioned by batch and bucketed by prompt. Rows that ask are dealt into as many
buckets by the same hash, so the claims of all earlier builds are joined where they lie, without a shuffle. Ahead of
the join stands a bitmap of all claims, kept by batch in pages beside the table: a row whose bit isn't set is new for sure and moves
nowhere. The bitmap has a fixed size (32 MB), so it is broadcast whatever the table holds; it misses no claim, and the more claims
there are, the more rows go on to the join.

Many small batches are merged by ``compact``, so that buckets keep few files. A batch is written as a whole: appending it again replaces it, so a build that is repeated claims nothing twice. Null and odd cases:
a null prompt is never claimed and always new; a prompt claimed twice in a batch is one claim, of the source that sorts first;
an empty batch claims nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.scan import Store
from millrace.sources.storage import written

#: Bits of the bitmap, and of a page of it (fixed by the aggregate that makes it).
BITS, PAGE = 1 << 28, 32_768
BUCKETS = 256


def _bit(prompt: Column) -> Column:
    return F.pmod(F.xxhash64(prompt), F.lit(BITS))


class ClaimStore:
    """The claims below a folder. ``buckets`` counts when the folder is new; an existing one keeps its own."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.store = spark, Store(spark, folder)
        if self.store.exists("buckets"):
            buckets = int(self.store.text("buckets"))
        else:
            self.store.put("buckets", str(buckets))
        self.buckets = buckets
        self.name = "claims_" + hashlib.sha256(self.store.uri().encode()).hexdigest()[:16]
        spark.sql(
            f"create table if not exists {self.name} (prompt_hash string, source_id string, batch string) using parquet partitioned by (batch) "
            f"clustered by (prompt_hash) sorted by (prompt_hash) into {buckets} buckets location '{self.store.uri('table')}'"
        )
        if self.store.exists("table"):
            spark.sql(f"alter table {self.name} recover partitions")

    def claims(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, claims: DataFrame, batch: str) -> None:
        """Add the prompts of a batch (prompt_hash, source_id), or replace the batch."""
        if not batch or not batch.replace("-", "").replace("_", "").replace(".", "").isalnum():
            raise ValueError("a batch is named by letters, digits, dots, hyphens and underscores")
        once = claims.where(F.col("prompt_hash").isNotNull()).groupBy("prompt_hash").agg(F.min("source_id").alias("source_id"))
        dealt = once.repartition(self.buckets, "prompt_hash")
        dealt.createOrReplaceTempView(f"{self.name}_new")
        self.spark.sql(f"insert overwrite table {self.name} partition (batch = '{batch}') select prompt_hash, source_id from {self.name}_new")
        self.spark.catalog.dropTempView(f"{self.name}_new")
        bit = _bit(F.col("prompt_hash"))
        mine = self.claims().where(F.col("batch") == batch).select(F.floor(bit / PAGE).cast("long").alias("page"), (bit % PAGE).alias("at"))
        pages = mine.groupBy("page").agg(F.bitmap_construct_agg("at").alias("bits"))
        pages.write.mode("overwrite").parquet(self.store.uri(f"bitmap/batch={batch}"))

    def batches(self) -> list[str]:
        return sorted(r["partition"].removeprefix("batch=") for r in self.spark.sql(f"show partitions {self.name}").collect())

    def compact(self, upto: str) -> None:
        """Merge the batches up to ``upto``, by name, into one named ``<upto>.all``, which sorts behind them and before later ones.

        Each prompt stays with the source that claimed it first. The merged batch is whole before the others go, so claims are
        complete at any time; after a failure in between, some stand twice, which changes no answer, until the next call.
        """
        merged = f"{upto}.all"
        old = [b for b in self.batches() if b <= upto]
        if len(old) < 2:
            return
        first = F.min(F.struct("batch", "source_id")).alias("f")
        once = self.claims().where(F.col("batch").isin(old)).groupBy("prompt_hash").agg(first)
        self.append(written(once.select("prompt_hash", "f.source_id"), "claims-merged"), merged)
        for b in old:
            self.spark.sql(f"alter table {self.name} drop if exists partition (batch = '{b}')")
            self.store.delete(f"table/batch={b}")
            self.store.delete(f"bitmap/batch={b}")
        self.spark.catalog.refreshTable(self.name)

    def _pages(self) -> DataFrame | None:
        if not self.store.exists("bitmap"):
            return None
        pages = self.spark.read.schema("page long, bits binary, batch string").parquet(self.store.uri("bitmap"))
        return pages.groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))  # BITS / PAGE rows at most

    def _split(self, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame] | None:
        """Rows that may be claimed, and rows that surely aren't."""
        pages = self._pages()
        if pages is None:
            return None
        bit = _bit(F.col(key))
        held = F.broadcast(pages.withColumnsRenamed({"page": "_page", "bits": "_bits"}))
        marked = rows.join(held, F.floor(bit / PAGE) == F.col("_page"), "left")
        byte = F.conv(F.hex(F.substring("_bits", F.floor(bit % PAGE / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        maybe = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
        own = [F.col(f"`{c}`") for c in rows.columns]
        return marked.where(F.col(key).isNotNull() & maybe).select(*own), marked.where(F.col(key).isNull() | ~maybe).select(*own)

    def unclaimed(self, rows: DataFrame, key: str = "prompt_hash", but: str | None = None) -> DataFrame:
        """The rows whose prompt no batch has claimed, the batch ``but`` apart; ``rows`` is read twice."""
        split = self._split(rows, key)
        if split is None:
            return rows
        maybe, sure = split
        claims = self.claims() if but is None else self.claims().where(F.col("batch") != but)
        taken = claims.select(F.col("prompt_hash").alias("_claimed"))
        new = maybe.repartition(self.buckets, key).join(taken, F.col(key) == F.col("_claimed"), "left_anti")
        return sure.unionByName(new)

    def owners(self, rows: DataFrame, key: str = "prompt_hash") -> DataFrame:
        """The rows that are claimed, with the batch and source that claimed them first, by name of the batch."""
        split = self._split(rows, key)
        if split is None:
            return rows.withColumns({"batch": F.lit(None).cast("string"), "owner": F.lit(None).cast("string")}).limit(0)
        first = self.claims().groupBy(F.col("prompt_hash").alias("_claimed")).agg(F.min(F.struct("batch", "source_id")).alias("_first"))
        joined = split[0].repartition(self.buckets, key).join(first, F.col(key) == F.col("_claimed"))
        return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("_first.batch").alias("batch"), F.col("_first.source_id").alias("owner"))
