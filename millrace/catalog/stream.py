"""The query of the streaming selection: documents arrive in two deliveries, the second one after a restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.common import document_rows, sources_of, sql_document_rows
from millrace.operators.select import Part
from millrace.sources.storage import scratch, written
from millrace.streaming.walk import StreamSelection


def stream_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the order of their ids, each source up to a third of its tokens, each prompt once."""
    rows = written(document_rows(spark, sf_dir).withColumn("at", F.col("row_id")), "stream-rows")
    totals = {r["source_id"]: r["t"] for r in rows.groupBy("source_id").agg(F.sum("tokens").alias("t")).collect()}  # one row a source
    walk = StreamSelection(scratch(spark, "stream-walk"), [Part(s, totals[s] // 3) for s in sources_of(rows)], buckets=32)
    ends = rows.agg(F.min("at").alias("lo"), F.max("at").alias("hi")).first()
    middle = 0 if ends["lo"] is None else (ends["lo"] + ends["hi"]) // 2
    intake, checkpoint = scratch(spark, "stream-intake"), scratch(spark, "stream-checkpoint")
    for delivery in (F.col("at") <= middle, F.col("at") > middle):
        rows.where(delivery).write.mode("append").parquet(intake)
        walk.start(spark.readStream.schema(rows.schema).parquet(intake), checkpoint).awaitTermination()
    taken = walk.taken(spark)
    return (rows.where(F.lit(False)) if taken is None else taken).select("source_id", "row_id", "prompt_hash", "tokens")


QUERIES = {"stream_select": stream_select}

#: Rounds that the SQL writes out: one more than the test tables have sources.
ROUNDS = 21


def _rounds() -> str:
    """Each round cuts the sources under the claims that the cuts before imply; the last one repeats the one before."""
    ctes = [
        sql_document_rows(),
        "q as (select source_id, greatest(sum(tokens)::bigint // 3, 1) as quota from d group by 1)",
        "f as materialized (select * exclude (copy) from (select *, row_number() over (partition by source_id, prompt_hash order by row_id) as copy from d) where copy = 1)",
        "e0 as (select source_id, null::bigint as cut from q)",
    ]
    for i in range(ROUNDS + 1):
        ctes.append(
            f"""h{i} as materialized (select * exclude (nth) from (select f.*, row_number() over (partition by prompt_hash order by row_id) as nth
              from f join e{i} e using (source_id) where e.cut is null or row_id <= e.cut) where nth = 1)"""
        )
        ctes.append(
            f"""e{i + 1} as materialized (select q.source_id, min(row_id) filter (where cum >= quota) as cut from q left join
              (select source_id, row_id, sum(tokens) over (partition by source_id order by row_id) as cum from h{i}) using (source_id) group by 1)"""
        )
    return "with " + ", ".join(ctes)


ORACLES = {"stream_select": f"{_rounds()} select source_id, row_id, prompt_hash, tokens from h{ROUNDS}"}
