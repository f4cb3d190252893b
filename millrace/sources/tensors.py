"""Weight files: headers read through the files' store, values scanned in chunks on the executors."""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a value of each element type.
WIDTH = {"F64": 8, "F32": 4, "F16": 2, "BF16": 2, "I64": 8, "I32": 4, "I16": 2, "I8": 1, "U8": 1, "BOOL": 1}
CHUNK_VALUES = 64 << 20


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or uri, and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path else Path(path).resolve().as_uri())


def header(path: str) -> tuple[int, dict]:
    """(where the data begin, name -> dtype, shape, data_offsets) of a safetensors file."""
    fs, local = opened(path)
    with fs.open_input_file(local) as f:
        (n,) = struct.unpack("<Q", f.read(8))
        doc = json.loads(f.read(n))
    doc.pop("__metadata__", None)
    return 8 + n, doc


def inventory(spark: SparkSession, paths: list[str], chunk_values: int = CHUNK_VALUES) -> DataFrame:
    """One row a chunk: file, name, dtype, shape, begin, count of values."""
    rows = []
    for path in paths:
        base, tensors = header(path)
        for name, t in sorted(tensors.items()):
            total, width = math.prod(t["shape"]), WIDTH[t["dtype"]]
            for first in range(0, max(total, 1), chunk_values):
                rows.append((path, name, t["dtype"], list(t["shape"]), base + t["data_offsets"][0] + first * width, min(chunk_values, total - first)))
    return spark.createDataFrame(rows, "file string, name string, dtype string, shape array<long>, begin long, count long")


def as_floats(raw: bytes, dtype: str) -> np.ndarray:
    if dtype == "BF16":
        return (np.frombuffer(raw, np.uint16).astype(np.uint32) << 16).view(np.float32)
    kind = {"F64": np.float64, "F32": np.float32, "F16": np.float16}.get(dtype)
    return np.frombuffer(raw, kind) if kind else np.zeros(0, np.float32)


def as_numbers(raw: bytes, dtype: str) -> np.ndarray:
    """Values of any element type."""
    kind = {"I64": np.int64, "I32": np.int32, "I16": np.int16, "I8": np.int8, "U8": np.uint8, "BOOL": np.uint8}.get(dtype)
    return np.frombuffer(raw, kind) if kind else as_floats(raw, dtype)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path, name, dtype, begin, count in zip(*(batch[c].to_pylist() for c in ("file", "name", "dtype", "begin", "count")), strict=True):
            fs, local = opened(path)
            with fs.open_input_file(local) as f:
                f.seek(begin)
                v = as_floats(f.read(count * WIDTH[dtype]), dtype)
            fine = v[np.isfinite(v)]
            out.append((path, name, dtype, count, int(np.isnan(v).sum()), int(np.isinf(v).sum()), float(np.abs(fine).max()) if len(fine) else 0.0))
        cols = list(zip(*out, strict=True)) if out else [()] * 7
        types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["file", "name", "dtype", "values", "nan", "inf", "absmax"])


def measured(chunks: DataFrame) -> DataFrame:
    """file, name, dtype, values, nan, inf, absmax of each tensor; a task holds one chunk at a time."""
    parts = chunks.repartition(max(1, min(chunks.count(), 4 * chunks.sparkSession.sparkContext.defaultParallelism)))
    each = parts.mapInArrow(_measure, "file string, name string, dtype string, values long, nan long, inf long, absmax double")
    return each.groupBy("file", "name", "dtype").agg(*[F.sum(c).alias(c) for c in ("values", "nan", "inf")], F.max("absmax").alias("absmax"))


def verdict(tensors: DataFrame, required: tuple[str, ...] = (), expected_tensors: int | None = None, expected_values: int | None = None, dtype: str | None = None) -> dict:
    """tensors, values, nonfinite and what is wrong: duplicate or missing names, unexpected totals, element types other than ``dtype``."""
    t = tensors.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("name").alias("d"), F.sum("values").alias("v"), F.sum(F.col("nan") + F.col("inf")).alias("bad")).first()
    there = {r["name"] for r in tensors.where(F.col("name").isin(*required)).select("name").distinct().collect()} if required else set()
    wrong = []
    if t["n"] != t["d"]:
        wrong.append("a tensor occurs twice")
    wrong += [f"{name} is missing" for name in required if name not in there]
    if expected_tensors is not None and t["n"] != expected_tensors:
        wrong.append(f"{t['n']} tensors, not {expected_tensors}")
    if expected_values is not None and t["v"] != expected_values:
        wrong.append(f"{t['v']} values, not {expected_values}")
    others = sorted(r["dtype"] for r in tensors.select("dtype").distinct().collect()) if dtype is not None else []  # element types are few
    if dtype is not None and others != [dtype]:
        wrong.append(f"element types are {', '.join(others)}, not {dtype}")
    if t["bad"]:
        wrong.append(f"{t['bad']} values aren't finite")
    return {"tensors": t["n"], "values": t["v"] or 0, "nonfinite": t["bad"] or 0, "wrong": wrong}
