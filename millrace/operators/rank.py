"""Ranks and running totals in a hashed order, without gathering a group in one task.

The order key is hex, so its leading bits cut the order into cells. Offsets come from one row a
cell; a window then runs inside each cell only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.select import cell_of

LEAST_CELLS = 256
CELL_ROWS = 65536


def cells_for(rows: int) -> int:
    return max(LEAST_CELLS, math.ceil(rows / CELL_ROWS))


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def ranked(rows: DataFrame, groups: Sequence[str], key: str, ties: Sequence[str], name: str = "pos", cells: int | None = None) -> DataFrame:
    """``rows`` with their position, from 1, in each group's order."""
    cells = cells or cells_for(rows.count())
    celled = rows.withColumn("_cell", cell_of(F.col(key), cells))
    counts = celled.groupBy(*groups, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(g).alias(f"_o_{g}") for g in groups], F.col("_cell").alias("_o_cell"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    joined = celled.join(offsets, _same([*[(g, f"_o_{g}") for g in groups], ("_cell", "_o_cell")]))
    inside = Window.partitionBy(*groups, "_cell").orderBy(key, *ties)
    return joined.withColumn(name, F.col("_before") + F.row_number().over(inside)).select(*rows.columns, name)


def until_quota(rows: DataFrame, group: str, key: str, tie: str, amount: str, quota: int, cells: int | None = None) -> DataFrame:
    """Each group's rows, in order, up to and with the one at which the running total of ``amount``
    reaches ``quota``; at least one row."""
    cells = cells or cells_for(rows.count())
    quota = max(quota, 1)
    celled = rows.withColumn("_cell", cell_of(F.col(key), cells))
    sums = celled.groupBy(group, "_cell").agg(F.sum(amount).alias("_t"))
    ahead = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    crossing = sums.withColumn("_before", F.coalesce(F.sum("_t").over(ahead), F.lit(0))).where((F.col("_before") < quota) & (F.col("_before") + F.col("_t") >= quota))
    crossing = crossing.select(F.col(group).alias("_g"), F.col("_cell").alias("_c"), "_before")
    inside = Window.partitionBy(group).orderBy(key, tie).rowsBetween(Window.unboundedPreceding, 0)
    hits = celled.join(crossing, _same([(group, "_g"), ("_cell", "_c")])).withColumn("_cum", F.sum(amount).over(inside) + F.col("_before"))
    ends = hits.where(F.col("_cum") >= quota).groupBy(F.col(group).alias("_e")).agg(F.min(F.struct(F.col(key).alias("k"), F.col(tie).alias("t"))).alias("_end"))
    kept = rows.join(ends, _same([(group, "_e")]), "left")
    return kept.where(F.col("_end").isNull() | (F.struct(F.col(key).alias("k"), F.col(tie).alias("t")) <= F.col("_end"))).select(*rows.columns)
