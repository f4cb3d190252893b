"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: For each open ``temporary``, the tables made inside.
_made: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master may go without it and gets a folder of its own."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    where = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", "millrace")
    spark.conf.set("spark.checkpoint.dir", where)
    return where


def scratch(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    for made in _made:
        made.append(path)
    return path


def written(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Cut the lineage at a table in the shared folder: a lost executor then costs a reread. ``by``: a column whose
    values have folders of their own."""
    path = scratch(df.sparkSession, label)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the tables made inside at the end. What is read from them must be written elsewhere by then."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            _delete(spark, path)


def clear(spark: SparkSession) -> None:
    """Delete this application's tables below the shared folder, once their results are stored elsewhere."""
    _delete(spark, f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}")
