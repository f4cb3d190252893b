"""Expectations about selected rows; every gate is a DataFrame of what breaks it, or a check that raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from millrace.plans.recipe import ALL_ONCE, Recipe, RecipeError, Source

#: Columns that a selected table must have.
REQUIRED = ("messages", "prompt_hash", "token_count", "source_id", "language", "task")


def missing_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> list[str]:
    return sorted(set(required) - set(df.columns))


def _sound(least: int, most: int) -> tuple[Column, Column]:
    """Whether a row ends on the assistant, and whether its tokens are within bounds."""
    last = F.get(F.col("messages"), F.size("messages") - 1)["role"]
    return F.coalesce(last == "assistant", F.lit(False)), F.coalesce(F.col("token_count").between(least, most), F.lit(False))


def observed(rows: DataFrame, sources: Sequence[str], least: int, most: int) -> tuple[DataFrame, Observation]:
    """``rows`` and what is seen of them while they are written: rows, tokens and tagged rows, in all and by source,
    and rows that break the contract. So no gate reads the messages again."""
    ends, inside = _sound(least, most)
    seen = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("tokens"), F.count_if(~ends).alias("unended"), F.count_if(~inside).alias("unbounded")]
    for i, s in enumerate(sources):
        own = F.col("source_id") == s
        seen += [F.count_if(own).alias(f"rows_{i}"), F.coalesce(F.sum(F.when(own, F.col("token_count"))), F.lit(0)).alias(f"tokens_{i}"), F.count_if(own & F.col("has_think_tags")).alias(f"tagged_{i}")]
    what = Observation()
    return rows.observe(what, *seen), what


def check_written(seen: dict[str, int], expected: dict[str, tuple[int, int]]) -> None:
    """What was written must be what was selected: (rows, tokens) of each source in order, and every row must be sound."""
    for i, (source, want) in enumerate(expected.items()):
        if (got := (seen[f"rows_{i}"], seen[f"tokens_{i}"])) != want:
            raise RecipeError(f"{source}: the table has {got[0]} rows and {got[1]} tokens, {want[0]} and {want[1]} were selected")
    if seen["rows"] != sum(r for r, _ in expected.values()):
        raise RecipeError(f"the table has {seen['rows']} rows, {sum(r for r, _ in expected.values())} were selected")
    if seen["unended"] or seen["unbounded"]:
        raise RecipeError(f"{seen['unended']} rows of the table don't end on the assistant, {seen['unbounded']} are out of bounds")


def row_violations(rows: DataFrame, least: int, most: int) -> DataFrame:
    """Every row whose last message isn't the assistant's or whose token count is out of bounds."""
    ends, inside = _sound(least, most)
    return rows.withColumn("ends_on_assistant", ends).withColumn("tokens_in_bounds", inside).where(~ends | ~inside)


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def language_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_id", "language").agg(F.count(F.lit(1)).alias("rows"))


def source_metrics(rows: DataFrame) -> DataFrame:
    """Rows, tokens, languages and tagged rows of each source, in one pass."""
    return rows.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("selected_rows"),
        F.sum("token_count").alias("selected_tokens"),
        F.count_distinct("language").alias("languages"),
        F.count_if("has_think_tags").alias("think_tag_rows"),
    )


def token_shares(stats: DataFrame, tokens: str = "selected_tokens") -> DataFrame:
    """Each source's share of all tokens, and of the weighted sources' tokens. The windows run over
    one row a source."""
    every = Window.partitionBy()
    weighted = F.when(F.col("selection") != ALL_ONCE, F.col(tokens))
    return stats.withColumn("actual_share", F.col(tokens) / F.sum(tokens).over(every)).withColumn("weighted_share", weighted / F.sum(weighted).over(every))


def within(actual: Column, requested: Column, tolerance: float) -> Column:
    return F.abs(actual - requested) <= F.lit(tolerance)


def mismatches(expected: DataFrame, actual: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys that only one side has, or whose values differ."""
    one = expected.select(*keys, F.col(value).alias("expected"))
    two = actual.select(*keys, F.col(value).alias("actual"))
    return one.join(two, keys, "full_outer").where(~F.col("expected").eqNullSafe(F.col("actual")))


def check_source(source: Source, reasons: dict[str, int], rows: int, tokens: int, languages: int) -> None:
    """The recipe's expectations about one source."""
    for reason, n in (source.expected_filter_reasons or {}).items():
        if reasons.get(reason, 0) != n:
            raise RecipeError(f"{source.id}: {reasons.get(reason, 0)} rows are {reason}, not {n}")
    for name, expected, got in (("rows", source.expected_selected_rows, rows), ("tokens", source.expected_selected_tokens, tokens), ("languages", source.expected_languages, languages)):
        if expected is not None and got != expected:
            raise RecipeError(f"{source.id}: {got} selected {name}, not {expected}")


def check_totals(recipe: Recipe, tokens: dict[str, int]) -> None:
    """Tokens reach the target, sources are the recipe's, weighted shares are within tolerance."""
    if set(tokens) != {s.id for s in recipe.sources}:
        raise RecipeError("the sources differ from the recipe's")
    if sum(tokens.values()) < recipe.target_tokens:
        raise RecipeError(f"{sum(tokens.values())} tokens are below the target {recipe.target_tokens}")
    weighted = [s for s in recipe.sources if s.selection != ALL_ONCE]
    total = sum(tokens[s.id] for s in weighted)
    for s in weighted:
        if abs(tokens[s.id] / total - float(s.token_share or 0)) > recipe.token_share_tolerance:
            raise RecipeError(f"{s.id}: share {tokens[s.id] / total:.4f} is outside the tolerance")
