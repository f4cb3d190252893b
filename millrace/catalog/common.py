"""Tables and SQL fragments that the queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import prompt_hash
from millrace.functions.tokens import PATTERN, PatternCounter
from millrace.operators.select import order_key

SEED = 20260818
LEAST, MOST = 64, 16384
COUNTER = PatternCounter()


def sql_tokens(text: str) -> str:
    return f"len(regexp_extract_all({text}, '{PATTERN}'))::bigint"


def sql_norm(text: str) -> str:
    """Folding in SQL: exact for the texts of the tables, not for every character."""
    return rf"trim(regexp_replace(replace(lower({text}), 'ß', 'ss'), '\s+', ' ', 'g'))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_index():
    """A source's number, from which its seed follows; a name without one has none."""
    return F.coalesce(F.substring("source", 4, 9).try_cast("int"), F.lit(0))


def sources_of(rows: DataFrame) -> tuple[str, ...]:
    """All sources, by number, then name: one row a source."""
    found = [r["source_id"] for r in rows.select("source_id").distinct().collect()]
    return tuple(sorted((s for s in found if s is not None), key=lambda s: (int(s[3:]) if s[3:].isdigit() else 1 << 31, s)))


def document_rows(spark: SparkSession, sf_dir: str, banded: bool = True) -> DataFrame:
    """Documents as selection rows: source_id, row_id, prompt_hash, tokens, key, lang."""
    d = table(spark, sf_dir, "documents")
    rows = d.select(
        F.col("source").alias("source_id"),
        F.col("doc_id").alias("row_id"),
        "lang",
        prompt_hash(F.col("lang"), F.col("text")).alias("prompt_hash"),
        COUNTER.count(F.col("text")).alias("tokens"),
        order_key(source_index() + SEED, F.col("doc_id")).alias("key"),
    )
    return rows.where(F.col("tokens").between(LEAST, MOST)) if banded else rows


def sql_document_rows(banded: bool = True) -> str:
    """The same as a common table expression named d."""
    band = f"where tokens between {LEAST} and {MOST}" if banded else ""
    return f"""d as (select * from (
      select source as source_id, doc_id as row_id, lang, sha256(concat(lang, chr(0), {sql_norm("text")})) as prompt_hash,
             {sql_tokens("text")} as tokens, md5(concat((substr(source, 4)::int + {SEED})::varchar, ':', doc_id::varchar)) as key
      from documents) {band})"""
