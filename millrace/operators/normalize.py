"""From a source's rows to canonical rows: adapter, language, trace gate, token band, prompt hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import messages as M
from millrace.functions.template import rendered
from millrace.functions.text import normalized_prompt, row_language
from millrace.functions.tokens import PatternCounter, TokenCounter
from millrace.operators.adapters import adapt, column
from millrace.plans.recipe import Source

#: Least code points of assistant text where a source demands reasoning.
TRACE = 128
#: The canonical columns.
CANONICAL = ("messages", "prompt_hash", "token_count", "source_id", "language", "task", "has_think_tags")


def length_reason(tokens: Column, least: int, most: int) -> Column:
    """Both bounds are inclusive."""
    return F.when(tokens < least, "too_short").when(tokens > most, "too_long").otherwise("ok")


def language_of(df: DataFrame, source: Source) -> Column:
    if source.language != "from_row":
        return F.lit(source.language or "unknown")
    name = source.language_field
    return row_language(column(df, name, T.StringType()), present=name in df.columns)


def normalized(df: DataFrame, source: Source, least: int, most: int, counter: TokenCounter | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical columns, ``_valid`` and ``_reason``, one row for each input row, in one narrow stage.

    Rows that no adapter accepts are empty; rows rejected later keep their messages and counts.
    A null token count (the template or the tokenizer failed) is ``template_error``.
    """
    counter = counter or PatternCounter()
    adapted = df.withColumn("_language", language_of(df, source)).withColumn("_adapted", adapt(source.adapter, df))
    ok = F.col("_adapted.reason") == "ok"
    text = adapted.withColumn("_assistant", M.assistant_text(F.col("_adapted.messages")))
    short = ok & F.lit(source.require_reasoning_trace) & (F.char_length("_assistant") < TRACE)
    counted = text.withColumn("_short", short).withColumn(
        "_tokens", F.when(ok & ~F.col("_short"), counter.count(F.when(ok & ~F.col("_short"), rendered(F.col("_adapted.messages")))))
    )
    counted = counted.withColumn("_prompt", F.when(ok, normalized_prompt(M.first_user(F.col("_adapted.messages")))))
    band = length_reason(F.col("_tokens"), least, most)
    reason = (
        F.when(~ok, F.col("_adapted.reason"))
        .when(F.col("_short"), "reasoning_trace_too_short")
        .when(F.col("_tokens").isNull(), "template_error")
        .when(band != "ok", band)
        .when(F.coalesce(F.col("_prompt"), F.lit("")) == "", "missing_normalized_prompt")
        .otherwise("ok")
    )
    hashed = F.sha2(F.concat(F.col("_language"), F.char(F.lit(0)), F.col("_prompt")).cast("binary"), 256)
    return counted.select(
        *keep,
        F.col("_adapted.messages").alias("messages"),
        F.when(F.coalesce(F.col("_prompt"), F.lit("")) != "", hashed).otherwise(F.lit("")).alias("prompt_hash"),
        F.coalesce("_tokens", F.lit(0)).cast("long").alias("token_count"),
        F.lit(source.id).alias("source_id"),
        F.col("_language").alias("language"),
        F.lit(source.role).alias("task"),
        F.coalesce(ok & F.contains("_assistant", F.lit("<think>")) & F.contains("_assistant", F.lit("</think>")), F.lit(False)).alias("has_think_tags"),
        (reason == "ok").alias("_valid"),
        reason.alias("_reason"),
    )


def reasons(rows: DataFrame) -> DataFrame:
    """source_id, _reason, rows: over all rows, accepted ones included."""
    return rows.groupBy("source_id", "_reason").agg(F.count(F.lit(1)).alias("rows"))


def valid(rows: DataFrame) -> DataFrame:
    return rows.where("_valid").drop("_valid", "_reason")
