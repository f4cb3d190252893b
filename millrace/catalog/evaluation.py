"""Queries of the evaluation block, with sources as models and languages as tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.common import table
from millrace.operators import evals
from millrace.sources import results

METRICS = ["quality,none", "toxic,none"]
TASKS = ["de", "en", "es", "fr"]
BASELINE = "src0"


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    per = d.groupBy(F.col("source").alias("model_id"), F.col("lang").alias("task")).agg(F.avg("quality").alias(METRICS[0]), F.avg("toxic").alias(METRICS[1]))
    return evals.unpivoted(per, ["model_id", "task"], METRICS)


def _macro(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    scores = evals.task_scores(_scores(spark, sf_dir))
    return scores, evals.macro(scores)


def eval_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    models, tasks = d.select(F.col("source").alias("model_id")).distinct(), d.select(F.col("lang").alias("task")).distinct()
    return evals.matrix(models, tasks, only_tasks=["de", "fr"])


def eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scores(spark, sf_dir)
    return rows.select("model_id", "task", "metric", F.round("value", 6).alias("value"), evals.stderr_name(F.col("metric")).alias("stderr_metric"))


def eval_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the whole matrix without scores."""
    d = table(spark, sf_dir, "documents")
    pairs = evals.matrix(d.select(F.col("source").alias("model_id")).distinct(), d.select(F.col("lang").alias("task")).distinct())
    found = _scores(spark, sf_dir).where(F.col("metric") == METRICS[0]).withColumn("result_sha256", F.col("metric"))
    return evals.required_rows(pairs, found)


def eval_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by way of result documents: one JSON document a model and task, written and read as variants; one task in four
    has its second metric as a text, which is a problem and no value."""
    per = _scores(spark, sf_dir).groupBy("model_id", "task").agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    text = F.when(F.col("task") == TASKS[0], F.to_json(F.struct(F.col("m")[METRICS[0]].alias(METRICS[0]), F.lit("none").alias(METRICS[1])))).otherwise(F.to_json("m"))
    content = F.concat(F.lit('{"results": {"'), "task", F.lit('": '), text, F.lit('}, "n-shot": {"'), "task", F.lit('": 3}}'))
    docs = per.select("model_id", "task", F.concat_ws("/", "model_id", "task").alias("path"), content.cast("binary").alias("content"))
    pairs = per.select("model_id", "task", F.explode(F.array(*map(F.lit, METRICS))).alias("metric"))
    return results.results_of(docs, pairs).select("model_id", "task", "metric", F.round("value", 6).alias("value"), "num_fewshot", "problem")


def eval_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _macro(spark, sf_dir)[1].select("model_id", F.round("macro", 6).alias("macro"))


def eval_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    macros = _macro(spark, sf_dir)[1].withColumn("macro", F.round("macro", 9))
    candidates = macros.select("model_id", F.substring("model_id", 4, 9).cast("int").alias("position")).where("position > 0")
    return evals.chosen(macros, candidates).select("model_id", F.round("macro", 6).alias("macro"))


def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, macros = _macro(spark, sf_dir)
    exact = lambda df, c: df.withColumn(c, F.round(c, 9))
    return evals.report(exact(scores, "score"), exact(macros, "macro"), TASKS, BASELINE)


def latest_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return evals.last_attempt(events, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


QUERIES = {f.__name__: f for f in (eval_documents, eval_matrix, eval_rows, eval_missing, eval_macro, eval_select, eval_report, latest_attempt)}

_PER = """per as (select source as model_id, lang as task, avg(quality) as q, avg(toxic) as x from documents join labels using (doc_id) group by 1, 2),
  scores as (select model_id, task, (q + x) / 2 as score from per), macros as (select model_id, avg(score) as macro from scores group by 1)"""
_CELL = "coalesce(printf('%.2f', round(max(score) filter (task = '{t}'), 9) * 100), '—') as {t}"

ORACLES = {
    "eval_documents": f"""with {_PER} select model_id, task, 'quality,none' as metric, round(q, 6) as value, 3 as num_fewshot, null::varchar as problem from per
        union all select model_id, task, 'toxic,none', case when task <> '{TASKS[0]}' then round(x, 6) end, 3, case when task = '{TASKS[0]}' then 'no number for toxic,none' end from per""",
    "eval_matrix": "select model_id, task from (select distinct source as model_id from documents), (select distinct lang as task from documents) where task in ('de', 'fr')",
    "eval_rows": f"""with {_PER} select model_id, task, 'quality,none' as metric, round(q, 6) as value, 'quality_stderr,none' as stderr_metric from per
        union all select model_id, task, 'toxic,none', round(x, 6), 'toxic_stderr,none' from per""",
    "eval_missing": f"""with {_PER} select model_id, task, 0::bigint as documents from (select distinct source as model_id from documents), (select distinct lang as task from documents)
        where (model_id, task) not in (select (model_id, task) from per)""",
    "eval_macro": f"with {_PER} select model_id, round(macro, 6) as macro from macros",
    "eval_select": f"with {_PER} select model_id, round(macro, 6) as macro from macros where model_id <> 'src0' order by round(macros.macro, 9) desc, substr(model_id, 4)::int limit 1",
    "eval_report": f"""with {_PER}, b as (select round(macro, 9) as base from macros where model_id = '{BASELINE}')
        select s.model_id, {", ".join(_CELL.format(t=t) for t in TASKS)}, printf('%.2f', round(max(macro), 9) * 100) as macro, printf('%+.2f', (round(max(macro), 9) - max(base)) * 100) as delta
        from scores s join macros using (model_id) cross join b group by s.model_id""",
    "latest_attempt": "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n = 1",
}
