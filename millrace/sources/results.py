"""Evaluation files: result documents, the matrix as a tab-separated table, reports.

Result documents are JSON of any shape and read by the executors as variants; the driver opens none.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.recipe import RecipeError
from millrace.sources.scan import Store

MATRIX = "model_id string, model_path string, task string, capability string, num_fewshot int, max_gen_toks int"
WANTED = "model_id string, task string, metric string"
#: An object of which only what is asked for is looked at.
OBJECT = "map<string,variant>"
#: Types of a variant that count as numbers.
NUMBERS = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def wanted(spark: SparkSession, models: Iterable[str], primary: Mapping[str, Sequence[str]]) -> DataFrame:
    """model_id, task, metric: every model's primary metrics of every task."""
    return spark.createDataFrame([(m, t, x) for m in models for t, metrics in primary.items() for x in metrics], WANTED)


def result_documents(spark: SparkSession, root: str, pattern: str = "results_*.json") -> DataFrame:
    """model_id, task, path, content of the documents below root/model/task, at any depth."""
    base = Store(spark, root).uri()
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(str(root))
    below = F.split(F.substring("path", len(base) + 2, 1 << 20), "/")
    return found.select(below[0].alias("model_id"), F.get(below, 1).alias("task"), "path", "content").where(F.size(below) > 2)


def _number(value: Column) -> Column:
    """A variant as a double if it is a number; neither texts nor truth values are."""
    return F.when(F.schema_of_variant(value).rlike(NUMBERS), F.try_variant_get(value, "$", "double"))


def results_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """model_id, task, metric, value, stderr, num_fewshot, result_sha256 and problem of every wanted metric; a problem
    says why there is no value.

    Each pair of model and task must have exactly one document, which a grouped count tells: a pair's documents fold to one
    of them, so any number of copies is one row.
    """
    from millrace.operators.evals import stderr_name

    per = documents.groupBy("model_id", "task").agg(F.count(F.lit(1)).alias("documents"), F.max_by("content", F.struct("path")).alias("content"))
    asked = wanted.join(per, ["model_id", "task"], "left").withColumn("doc", F.try_parse_json(F.col("content").cast("string")))
    of_task = lambda place: F.try_element_at(F.try_variant_get("doc", place, OBJECT), F.col("task"))
    values = F.try_variant_get(of_task("$.results"), "$", OBJECT)
    read = asked.withColumns({"values": values, "value": _number(F.try_element_at(values, F.col("metric"))), "stderr": _number(F.try_element_at(values, stderr_name(F.col("metric"))))})
    one = F.coalesce(F.col("documents"), F.lit(0))
    problem = (
        F.when(one != 1, F.format_string("%d result documents, not 1", one))
        .when(F.col("values").isNull(), F.concat(F.lit("no result of "), "task"))
        .when(F.col("value").isNull(), F.concat(F.lit("no number for "), "metric"))
    )
    return read.select(
        "model_id", "task", "metric", F.when(problem.isNull(), F.col("value")).alias("value"), F.when(problem.isNull(), F.col("stderr")).alias("stderr"),
        _number(of_task("$['n-shot']")).cast("int").alias("num_fewshot"), F.sha2("content", 256).alias("result_sha256"), problem.alias("problem"),
    )


def read_results(spark: SparkSession, root: str, models: Iterable[str], primary: Mapping[str, Sequence[str]], most_named: int = 20) -> DataFrame:
    """The primary metrics of every model on every task; an error names what is missing or no number."""
    rows = results_of(result_documents(spark, root), wanted(spark, models, primary))
    if wrong := rows.where("problem is not null").select("model_id", "task", "problem").distinct().orderBy("model_id", "task", "problem").limit(most_named).collect():
        raise RecipeError("; ".join(f"{r['model_id']}/{r['task']}: {r['problem']}" for r in wrong))
    return rows.drop("problem")


def write_matrix(matrix: DataFrame, path: str) -> None:
    matrix.coalesce(1).write.mode("errorifexists").option("sep", "\t").option("header", True).csv(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).schema(MATRIX).csv(path)


def matrix_row(matrix: DataFrame, index: int, *order: str) -> dict:
    """The row of an array task, counted from 0."""
    rows = matrix.orderBy(*order).offset(index).limit(1).collect()
    if not rows:
        raise IndexError(index)
    return rows[0].asDict()


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("errorifexists").option("header", True).csv(path)


def files_with_size(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, bytes of the files below a folder, listed by Spark."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return found.select("path", F.col("length").alias("bytes"))
