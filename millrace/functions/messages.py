"""Conversations as ``array<struct<role, content>>``: cleaning with reject reasons, and views of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import strip

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)

#: The closed set of outcomes of a row.
REASONS = (
    "ok", "messages_not_list", "message_not_mapping", "unsupported_role", "empty_content", "missing_user", "missing_assistant",
    "assistant_not_last", "openr1_unverified", "quality_not_accepted", "unknown_adapter", "reasoning_trace_too_short",
    "template_error", "too_short", "too_long", "missing_normalized_prompt",
)
ROLES = ("system", "user", "assistant")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once: a one-element transform binds it, where plain nesting,
    or inlining of a struct's fields into later projections, would repeat it at every mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _checked(messages: Column) -> Column:
    """Per message: stripped role and content, and ``ok``, ``drop`` or the reason it fails."""

    def one(m: Column, s: Column) -> Column:
        role, content = s["role"], s["content"]
        known = F.coalesce(role.isin(*ROLES), F.lit(False))
        code = (
            F.when(m.isNull(), "message_not_mapping")
            .when(~known, "unsupported_role")
            .when(content.isNull() | ((content == "") & (role != "system")), "empty_content")
            .when(content == "", "drop")
            .otherwise("ok")
        )
        return F.struct(role.alias("role"), content.alias("content"), code.alias("code"))

    stripped = lambda m: F.struct(strip(m["role"]).alias("role"), strip(m["content"]).alias("content"))
    return F.transform(messages, lambda m: bound(stripped(m), lambda s: one(m, s)))


def cleaned(messages: Column) -> Column:
    """struct<messages, reason>: the stripped messages without blank system turns, and the first
    failure in message order, else the first failure of the whole. Messages are empty unless ok."""

    def split(checked: Column) -> Column:
        bad = F.filter(checked, lambda m: ~m["code"].isin("ok", "drop"))
        kept = F.transform(F.filter(checked, lambda m: m["code"] == "ok"), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
        return F.struct(F.get(bad, F.lit(0))["code"].alias("bad"), kept.alias("kept"))

    def judged(s: Column) -> Column:
        has = lambda role: F.exists(s["kept"], lambda m: m["role"] == role)
        reason = (
            F.when(messages.isNull(), "messages_not_list")
            .when(s["bad"].isNotNull(), s["bad"])
            .when(~has("user"), "missing_user")
            .when(~has("assistant"), "missing_assistant")
            .when(F.element_at(s["kept"], -1)["role"] != "assistant", "assistant_not_last")
            .otherwise("ok")
        )
        return F.struct(s["kept"].alias("kept"), reason.alias("reason"))

    nothing = F.array().cast(MESSAGES)
    shown = lambda s: F.struct(F.when(s["reason"] == "ok", s["kept"]).otherwise(nothing).alias("messages"), s["reason"].alias("reason"))
    return bound(_checked(messages), lambda c: bound(split(c), lambda s: bound(judged(s), shown)))


def of_role(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def first_user(messages: Column) -> Column:
    return F.get(of_role(messages, "user"), F.lit(0))["content"]


def assistant_text(messages: Column) -> Column:
    return F.array_join(F.transform(of_role(messages, "assistant"), lambda m: m["content"]), "\n")


def has_think_tags(messages: Column) -> Column:
    text = assistant_text(messages)
    return F.contains(text, F.lit("<think>")) & F.contains(text, F.lit("</think>"))


def gathered(turns: DataFrame, key: str, order: list[str], role: str, content: str) -> DataFrame:
    """One row a key with its messages in order, from one row a message."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col(role).alias("role"), F.col(content).alias("content"))))
    return turns.groupBy(key).agg(ordered.alias("m")).select(
        key, F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages")
    )
