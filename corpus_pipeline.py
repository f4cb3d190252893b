"""A training-corpus pipeline over the table documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Toxic documents go, one document of each near-duplicate group stays, documents that
hold a benchmark window go, sources are mixed to their target weights (documents may repeat), and
every row of the mix gets its shard and slot.

Null and odd cases follow the operators: a null or empty text is clean, similar to nothing and
without words, so it stays until the mix, which takes it like any document of size 0; a null id is a
row of its own to every stage, never a near-duplicate; a null source is a source; repeated rows share
the fate of their id and text; of an empty table every stage makes an empty one; columns other than
doc_id, text and source may have any name and type and pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontam, mixing, neardup, sharding, toxicity
from millrace.sources.storage import scratch, temporary

SEED = 20260818


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that any category of the chain holds for go. Labelled documents among ``docs`` train it."""
    return toxicity.keep_clean(docs, toxicity.with_kinds(spark.read.parquet(f"{sf_dir}/labels.parquet")), toxicity.KINDS)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group over five-word shingles at 80 % the smallest id stays."""
    return neardup.near_duplicates(docs, size=5, percent=80)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents with ten consecutive words of an item, or a whole shorter item, go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each document as often as the mix takes it."""
    return mixing.mix(docs, seed=SEED, weights=(3, 1, 2), budget=(3, 2), max_epochs=2)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: shard and slot of every row of the mix."""
    return sharding.shard_rows(docs, n_shards=40, seed=SEED)


STAGES = [
    ("toxicity", toxic_out),
    ("near-duplicates", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The first stage is a trained classifier, which SQL can't repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each to the table that the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        with temporary(spark):  # what the stage wrote on its way goes once its result is written
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
