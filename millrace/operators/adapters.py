"""Record adapters: from a source's own columns to messages with a reject reason.

An adapter takes the DataFrame (to see which columns exist) and gives struct<messages, reason>.
``register`` adds further ones; an unknown name rejects every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.messages import MESSAGES, cleaned
from millrace.functions.text import strip

Adapter = Callable[[DataFrame], Column]
_registry: dict[str, Adapter] = {}


def register(name: str) -> Callable[[Adapter], Adapter]:
    def add(adapter: Adapter) -> Adapter:
        _registry[name] = adapter
        return adapter

    return add


def adapt(name: str, df: DataFrame) -> Column:
    return _registry[name](df) if name in _registry else rejected("unknown_adapter")


def rejected(reason: str) -> Column:
    return F.struct(F.array().cast(MESSAGES).alias("messages"), F.lit(reason).alias("reason"))


def column(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """A column that a source may lack."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


@register("messages")
def messages(df: DataFrame) -> Column:
    return cleaned(column(df, "messages", MESSAGES))


@register("accepted_messages")
def accepted_messages(df: DataFrame) -> Column:
    """Messages of rows whose quality record accepts them."""
    accepted = F.coalesce(F.col("quality")["accepted"].cast("boolean"), F.lit(False)) if "quality" in df.columns else F.lit(False)
    return F.when(accepted, cleaned(column(df, "messages", MESSAGES))).otherwise(rejected("quality_not_accepted"))


def first_verified(generations: Column, complete: Column, *verdicts: Column) -> Column:
    """The first generation that is complete and passed by any verdict. The arrays are aligned by
    index; where one is null or short, it says no."""
    said = lambda flags, i: F.coalesce(F.get(flags, i), F.lit(False))

    def valid(_: Column, i: Column) -> Column:
        passed = said(verdicts[0], i)
        for v in verdicts[1:]:
            passed = passed | said(v, i)
        return said(complete, i) & passed

    return F.filter(F.transform(generations, lambda g, i: F.struct(i.alias("i"), g.alias("text"), valid(g, i).alias("valid"))), lambda g: g["valid"])


@register("openr1_verified")
def openr1_verified(df: DataFrame) -> Column:
    """Conversations answered by the first verified generation.

    A usable conversation gets its last message replaced, unless the generation is blank. Else a
    conversation is built from problem, or input where that is empty; without either the reason is
    the one that cleaning gave.
    """
    flags = T.ArrayType(T.BooleanType())
    valid = first_verified(
        F.coalesce(column(df, "generations", T.ArrayType(T.StringType())), F.array().cast("array<string>")),
        column(df, "is_reasoning_complete", flags),
        column(df, "correctness_math_verify", flags),
        column(df, "correctness_llama", flags),
    )
    count = F.coalesce(column(df, "correctness_count", T.IntegerType()), F.lit(0))
    best = F.get(valid, F.lit(0))["text"]
    usable = cleaned(column(df, "messages", MESSAGES))
    say = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    answer = strip(F.coalesce(best, F.lit("None")))  # a null generation reads as the text None
    swapped = F.concat(F.slice(usable["messages"], 1, F.greatest(F.size(usable["messages"]) - 1, F.lit(0))), F.array(say("assistant", answer)))
    prompt = F.coalesce(F.nullif(column(df, "problem", T.StringType()), F.lit("")), F.nullif(column(df, "input", T.StringType()), F.lit("")))
    built = F.array(say("user", strip(prompt)), say("assistant", answer))
    ok = lambda m: F.struct(m.cast(MESSAGES).alias("messages"), F.lit("ok").alias("reason"))
    return (
        F.when((count < 1) | (F.size(valid) == 0), rejected("openr1_unverified"))
        .when((usable["reason"] == "ok") & (answer != ""), ok(swapped))
        .when(usable["reason"] == "ok", usable)
        .when(strip(F.coalesce(prompt, F.lit(""))) != "", ok(built))
        .otherwise(usable)
    )
