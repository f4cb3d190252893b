"""Queries over conversations: cleaning, canonical rows, rendering, masks, tags, adapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.common import COUNTER, LEAST, MOST, sql_norm, sql_tokens, table
from millrace.functions import messages as M
from millrace.functions.template import assistant_spans as spans
from millrace.functions.template import rendered
from millrace.operators.adapters import adapt
from millrace.operators.normalize import normalized
from millrace.plans.recipe import Source


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.gathered(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], "role", "text")


def clean_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir).select(M.cleaned(F.col("messages"))["reason"].alias("reason"))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalized(conversations(spark, sf_dir), Source("conversations", role="chat", language="en"), LEAST, MOST, COUNTER, keep=("conv_id",))
    return rows.where("_valid").select("conv_id", "prompt_hash", "token_count", F.size("messages").alias("n_messages"), "source_id", "language", "task", "has_think_tags")


def canonical_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalized(conversations(spark, sf_dir), Source("conversations", language="en", require_reasoning_trace=True), LEAST, 1024, COUNTER)
    return rows.groupBy("_reason").agg(F.count(F.lit(1)).alias("rows"), F.sum("token_count").alias("tokens")).withColumnRenamed("_reason", "reason")


def chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = rendered(F.col("messages"))
    rows = conversations(spark, sf_dir).select("conv_id", text.alias("rendered"))
    return rows.withColumn("sha256", F.sha2(F.col("rendered").cast("binary"), 256))


def assistant_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir).select(
        "conv_id", COUNTER.count(F.array_join(spans(F.col("messages")), "\n")).alias("assistant_tokens"), COUNTER.count(rendered(F.col("messages"))).alias("total_tokens")
    )
    return rows.withColumn("usable", (F.col("assistant_tokens") > 0) & (F.col("assistant_tokens") < F.col("total_tokens")))


def think_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second conversation gets a tagged thought, so that both outcomes occur."""
    rows = table(spark, sf_dir, "conversations").withColumn("text", F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("<think>x</think> "), "text")).otherwise(F.col("text")))
    rows = M.gathered(rows, "conv_id", ["turn"], "role", "text")
    return rows.select(M.has_think_tags(F.col("messages")).alias("tagged")).groupBy("tagged").agg(F.count(F.lit(1)).alias("rows"))


def openr1_first_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as problems and their lines as generations."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus", "l_returnflag")
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("g"))
    rows = orders.select(
        "l_orderkey",
        F.concat(F.lit("order "), "l_orderkey").alias("problem"),
        F.transform("g", lambda x: F.concat(F.lit("part "), x["l_partkey"], F.lit(" of "), x["l_suppkey"])).alias("generations"),
        F.transform("g", lambda x: x["l_linestatus"] == "F").alias("is_reasoning_complete"),
        F.transform("g", lambda x: x["l_returnflag"] == "R").alias("correctness_math_verify"),
        F.transform("g", lambda x: x["l_returnflag"] == "A").alias("correctness_llama"),
        F.size("g").alias("correctness_count"),
    )
    out = rows.withColumn("a", adapt("openr1_verified", rows))
    return out.select("l_orderkey", F.col("a.reason").alias("reason"), F.get("a.messages", F.lit(1))["content"].alias("answer"))


def adapter_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as questions, the adapter by id; the fourth name is unknown."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    rows = d.select(
        (F.col("doc_id") % 4).alias("kind"),
        F.array(say("user", F.col("text")), say("assistant", F.col("lang"))).alias("messages"),
        F.struct((F.col("quality") == 1).alias("accepted")).alias("quality"),
        F.array("text").alias("generations"),
        F.array(F.col("n_chars") > 1000).alias("is_reasoning_complete"),
        F.array(F.col("lang") == "en").alias("correctness_math_verify"),
        F.lit(1).alias("correctness_count"),
    )
    names = ("messages", "accepted_messages", "openr1_verified", "other")
    reason = F.lit(None).cast("string")
    for i, name in enumerate(names):
        reason = F.when(F.col("kind") == i, adapt(name, rows)["reason"]).otherwise(reason)
    return rows.select("kind", reason.alias("reason")).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("rows"))


def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that break the final-turn or length contract."""
    rows = conversations(spark, sf_dir)
    last = F.element_at("messages", -1)["role"]
    tokens = COUNTER.count(rendered(F.col("messages")))
    out = rows.select("conv_id", (last == "assistant").alias("ends_on_assistant"), tokens.between(LEAST, 1024).alias("tokens_in_bounds"))
    return out.where(~F.col("ends_on_assistant") | ~F.col("tokens_in_bounds"))


QUERIES = {f.__name__: f for f in (clean_reasons, canonical_rows, canonical_reasons, chat_render, assistant_spans, think_tags, openr1_first_valid, adapter_dispatch, schema_contract)}

_CHECKED = """m as (select conv_id, turn, trim(role) as r, trim(text) as c,
    case when role is null or trim(role) not in ('system', 'user', 'assistant') then 'unsupported_role'
         when text is null or (trim(text) = '' and trim(role) <> 'system') then 'empty_content'
         when trim(text) = '' then 'drop' else 'ok' end as code from conversations),
  g as (select conv_id, arg_min(code, turn) filter (code not in ('ok', 'drop')) as bad,
    count(*) filter (code = 'ok') as n, count(*) filter (code = 'ok' and r = 'user') as users, count(*) filter (code = 'ok' and r = 'assistant') as answers,
    arg_max(r, turn) filter (code = 'ok') as last_role, arg_min(c, turn) filter (code = 'ok' and r = 'user') as prompt,
    string_agg(c, chr(10) order by turn) filter (code = 'ok' and r = 'assistant') as assistant from m group by conv_id),
  q as (select *, case when bad is not null then bad when users = 0 then 'missing_user' when answers = 0 then 'missing_assistant'
    when last_role <> 'assistant' then 'assistant_not_last' else 'ok' end as reason from g)"""
_RENDERED = """w as (select conv_id, turn, trim(role) as role, trim(text) as text, row_number() over o as n,
    first_value(trim(role)) over o = 'system' as folded, first_value(trim(text)) over o as system_text
    from conversations window o as (partition by conv_id order by turn)),
  t as (select conv_id, turn, role = 'assistant' and not (folded and n = 1) as learned,
    case when folded and n = 1 then '' else '<start_of_turn>' || case when role = 'assistant' then 'model' when folded and n = 2 then 'user' else role end || chr(10) end as head,
    case when folded and n = 1 then '' else case when folded and n = 2 and role <> 'assistant' then system_text || chr(10) || chr(10) else '' end || text || '<end_of_turn>' || chr(10) end as body
    from w),
  c as (select conv_id, '<bos>' || string_agg(head || body, '' order by turn) as rendered, coalesce(string_agg(body, chr(10) order by turn) filter (learned), '') as learned from t group by conv_id)"""
_TOK = sql_tokens

ORACLES = {
    "clean_reasons": f"with {_CHECKED} select reason, count(*) as rows from q group by reason",
    "canonical_rows": f"""with {_CHECKED}, {_RENDERED}, x as (select q.*, {_TOK("rendered")} as tokens from q join c using (conv_id) where reason = 'ok')
        select conv_id, sha256(concat('en', chr(0), {sql_norm("prompt")})) as prompt_hash, tokens as token_count, n::int as n_messages,
               'conversations' as source_id, 'en' as language, 'chat' as task, (contains(assistant, '<think>') and contains(assistant, '</think>')) as has_think_tags
        from x where tokens between {LEAST} and {MOST}""",
    "canonical_reasons": f"""with {_CHECKED}, {_RENDERED}, x as (
          select case when reason <> 'ok' then reason when length(assistant) < 128 then 'reasoning_trace_too_short' when {_TOK("rendered")} < {LEAST} then 'too_short'
                      when {_TOK("rendered")} > 1024 then 'too_long' else 'ok' end as reason,
                 case when reason = 'ok' and length(assistant) >= 128 then {_TOK("rendered")} else 0 end as tokens from q join c using (conv_id))
        select reason, count(*) as rows, sum(tokens)::bigint as tokens from x group by reason""",
    "chat_render": f"with {_RENDERED} select conv_id, rendered, sha256(rendered) as sha256 from c",
    "assistant_spans": f"""with {_RENDERED}, x as (select conv_id, {_TOK("learned")} as assistant_tokens, {_TOK("rendered")} as total_tokens from c)
        select *, assistant_tokens > 0 and assistant_tokens < total_tokens as usable from x""",
    "think_tags": """with x as (select conv_id, coalesce(string_agg(case when conv_id % 2 = 0 then '<think>x</think> ' else '' end || text, chr(10)) filter (role = 'assistant'), '') as a
        from conversations group by conv_id) select contains(a, '<think>') and contains(a, '</think>') as tagged, count(*) as rows from x group by 1""",
    "openr1_first_valid": """with x as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus, l_returnflag) as n from lineitem),
        o as (select l_orderkey, arg_min('part ' || l_partkey || ' of ' || l_suppkey, n) filter (l_linestatus = 'F' and l_returnflag in ('R', 'A')) as answer from x group by l_orderkey)
        select l_orderkey, case when answer is null then 'openr1_unverified' else 'ok' end as reason, answer from o""",
    "adapter_dispatch": """with x as (select doc_id % 4 as kind, case doc_id % 4 when 0 then 'ok' when 1 then case when quality = 1 then 'ok' else 'quality_not_accepted' end
        when 2 then case when n_chars > 1000 and lang = 'en' then 'ok' else 'openr1_unverified' end else 'unknown_adapter' end as reason from documents left join labels using (doc_id))
        select kind, reason, count(*) as rows from x group by kind, reason""",
    "schema_contract": f"""with {_RENDERED}, l as (select conv_id, arg_max(role, turn) as last_role from conversations group by conv_id),
        x as (select conv_id, last_role = 'assistant' as ends_on_assistant, {_TOK("rendered")} between {LEAST} and 1024 as tokens_in_bounds from c join l using (conv_id))
        select * from x where not ends_on_assistant or not tokens_in_bounds""",
}
