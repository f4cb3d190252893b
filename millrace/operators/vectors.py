"""Finiteness of numeric arrays, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def count_nan(v: Column) -> Column:
    return F.size(F.filter(v, F.isnan))


def count_inf(v: Column) -> Column:
    return F.size(F.filter(v, lambda x: F.abs(x) == F.lit(float("inf"))))


def absmax(v: Column) -> Column:
    """Largest magnitude among the finite values, 0 without any."""
    return F.coalesce(F.array_max(F.transform(F.filter(v, is_finite), F.abs)), F.lit(0.0))


def audit(rows: DataFrame, vector: str, *groups: str) -> DataFrame:
    """tensors, values, nan, inf, nonfinite, absmax."""
    v = F.col(vector).cast("array<double>")
    each = rows.select(*groups, F.size(v).alias("n"), count_nan(v).alias("nan"), count_inf(v).alias("inf"), absmax(v).alias("m"))
    return each.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("tensors"),
        F.sum("n").cast("long").alias("values"),
        F.sum("nan").cast("long").alias("nan"),
        F.sum("inf").cast("long").alias("inf"),
        F.sum(F.col("nan") + F.col("inf")).cast("long").alias("nonfinite"),
        F.max("m").alias("absmax"),
    )
