"""Evaluation: the matrix of models and tasks, scores, macro means, choice of a candidate, report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.recipe import RecipeError


def wanted(name: Column, requested: Iterable[str]) -> Column:
    """An empty request wants everything."""
    requested = list(requested)
    return name.isin(requested) if requested else F.lit(True)


def matrix(models: DataFrame, tasks: DataFrame, only_models: Iterable[str] = (), only_tasks: Iterable[str] = ()) -> DataFrame:
    """Every wanted model with every wanted task. Both lists come from a configuration, so the
    product of the two is as small as the plan to run it."""
    for known, asked, what in ((models.select("model_id"), set(only_models), "models"), (tasks.select("task"), set(only_tasks), "tasks")):
        if asked:
            there = {r[0] for r in known.where(F.col(known.columns[0]).isin(list(asked))).distinct().collect()}
            if asked - there:
                raise RecipeError(f"unknown {what}: {', '.join(sorted(asked - there))}")
    return models.where(wanted(F.col("model_id"), only_models)).crossJoin(tasks.where(wanted(F.col("task"), only_tasks)))


def stderr_name(metric: Column) -> Column:
    return F.regexp_replace(metric, r"\A([^,]*),", "$1_stderr,")


def unpivoted(scores: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Long rows (keys, metric, value) from one column a metric."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return scores.select(*keys, F.explode(pairs).alias("m")).select(*keys, "m.metric", "m.value")


def required_rows(matrix_rows: DataFrame, results: DataFrame, keys: tuple[str, ...] = ("model_id", "task")) -> DataFrame:
    """Pairs of the matrix that lack a result, or have several."""
    counts = results.groupBy(*keys).agg(F.count_distinct("result_sha256").alias("documents"))
    return matrix_rows.join(counts, list(keys), "left").withColumn("documents", F.coalesce("documents", F.lit(0))).where("documents <> 1")


def task_scores(rows: DataFrame) -> DataFrame:
    """The mean of a task's primary metrics, for each model."""
    return rows.groupBy("model_id", "task").agg(F.avg("value").alias("score"))


def macro(scores: DataFrame) -> DataFrame:
    """The unweighted mean over tasks."""
    return scores.groupBy("model_id").agg(F.avg("score").alias("macro"))


def geometric_macro(scores: DataFrame, gates: DataFrame | None = None) -> DataFrame:
    """The geometric mean over tasks; with gates (task, least), models below one are left out."""
    rows = scores
    if gates is not None:
        failed = scores.join(gates, "task").where(F.col("score") < F.col("least")).select("model_id").distinct()
        rows = scores.join(failed, "model_id", "left_anti")
    return rows.groupBy("model_id").agg(F.exp(F.avg(F.log(F.greatest("score", F.lit(1e-12))))).alias("macro"))


def chosen(macros: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidate (model_id, position) with the highest macro, the earliest among equals."""
    best = F.max(F.struct("macro", (-F.col("position")).alias("p"), "model_id"))
    return macros.join(candidates, "model_id").agg(best.alias("b")).select("b.model_id", "b.macro")


def deltas(macros: DataFrame, baseline: str) -> DataFrame:
    """model_id, macro, delta to the baseline's. The baseline is one row."""
    base = macros.where(F.col("model_id") == baseline).select(F.col("macro").alias("base"))
    return macros.crossJoin(F.broadcast(base)).select("model_id", "macro", (F.col("macro") - F.col("base")).alias("delta"))


def percent(value: Column) -> Column:
    return F.when(value.isNull(), "—").otherwise(F.format_string("%.2f", value * 100))


def signed_percent(value: Column) -> Column:
    return F.when(value.isNull(), "—").otherwise(F.format_string("%+.2f", value * 100))


def report(scores: DataFrame, macros: DataFrame, tasks: list[str], baseline: str) -> DataFrame:
    """One row a model: a column a task, Macro, Delta, as texts."""
    wide = scores.groupBy("model_id").pivot("task", tasks).agg(F.first("score"))
    joined = wide.join(deltas(macros, baseline), "model_id")
    return joined.select("model_id", *[percent(F.col(f"`{t}`")).alias(t) for t in tasks], percent(F.col("macro")).alias("macro"), signed_percent(F.col("delta")).alias("delta"))


def summary(rows: DataFrame, chosen: str | None = None, rule: str = "", left_out: Iterable[tuple[str, str]] = ()) -> dict:
    """An evaluation as a document: the report's rows by model, who was chosen and by what rule, and what wasn't run. A row a model."""
    return {
        "models": {r["model_id"]: {c: r[c] for c in rows.columns if c != "model_id"} for r in rows.orderBy("model_id").collect()},
        "choice": {"model": chosen, "rule": rule} if chosen else None,
        "left_out": [{"what": what, "why": why} for what, why in left_out],
    }


def markdown(doc: dict, title: str) -> str:
    """A summary as a text: the choice first, then a table in even columns."""
    out = [title, "=" * len(title), ""]
    if doc["choice"]:
        out += [f"{doc['choice']['model']} was chosen ({doc['choice']['rule'] or 'no rule given'}).", ""]
    columns = ["model", *next(iter(doc["models"].values()), {})]
    cells = [columns, *([m, *map(str, values.values())] for m, values in doc["models"].items())]
    widths = [max(map(len, column)) for column in zip(*cells, strict=True)]
    table = [" | ".join(c.ljust(w) if i == 0 else c.rjust(w) for i, (c, w) in enumerate(zip(line, widths, strict=True))) for line in cells]
    out += [table[0], "-|-".join("-" * w for w in widths), *table[1:], ""]
    if doc["left_out"]:
        out += ["Not evaluated:", *(f"  {x['what']}, because {x['why']}" for x in doc["left_out"]), ""]
    return "\n".join(out)


def last_attempt(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The latest row of each key, by partial aggregation rather than a window."""
    own = [c for c in rows.columns if c != key]
    best = F.max_by(F.struct(*own), F.struct(*order))
    return rows.groupBy(key).agg(best.alias("b")).select(key, *[F.col(f"b.{c}").alias(c) for c in own])
