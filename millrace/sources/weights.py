"""Weight files (safetensors) as a data source: ``spark.read.format("weights")`` and ``df.write.format("weights")``.

Reading: headers are read through the files' own store and planned as chunks of tensors, some millions of values a task, so a
tensor of any size spreads over tasks and small ones share one. ``names`` (comma separated) or a filter on name leaves out the other tensors before anything of them is read. Writing: each task packs its rows into files of about ``file_bytes``, under names of
its attempt, which the commit renames; what a failed attempt wrote is never seen.

Register it once a session: ``weights.register(spark)``. Odd cases: a tensor without values is one row with an empty list; null lists are
written as tensors without values; a row without a name is an error; files that are no weight files are an error on reading.
"""

from __future__ import annotations

import itertools
import json
import math
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from millrace.sources.tensors import WIDTH, as_numbers, header, opened

SCHEMA = "file string, name string, dtype string, shape array<bigint>, first bigint, values array<double>"
SUFFIX = ".safetensors"
#: Values in a row at most, values that a task reads, and bytes of a written file, about.
CHUNK, TASK, FILE_BYTES = 1 << 20, 1 << 25, 256 << 20


@dataclass
class Chunk:
    """Values ``first`` to ``first + count`` of a tensor, which begin at a byte of the file."""

    file: str
    name: str
    dtype: str
    shape: tuple[int, ...]
    first: int
    begin: int
    count: int


@dataclass
class Share(InputPartition):
    """What one task reads: chunks of one file after another."""

    chunks: list[Chunk]


def _files(uri: str) -> list[str]:
    fs, path = opened(uri)
    info = fs.get_file_info(path)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(path, recursive=True))
    prefix = uri[: -len(path)] if uri.endswith(path) else "file://"
    return sorted(prefix + f.path for f in found if f.is_file and f.base_name.endswith(SUFFIX) and not f.base_name.startswith(("_", ".")))


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.chunk, self.task = options["path"], int(options.get("chunk_values", CHUNK)), int(options.get("task_values", TASK))
        self.names = frozenset(options["names"].split(",")) if options.get("names") else None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("name",):
                asked = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
                self.names = asked if self.names is None else self.names & asked
            else:
                yield f

    def partitions(self) -> list[Share]:
        out: list[Share] = []
        size = 0
        for file in _files(self.uri):
            base, tensors = header(file)
            for name, t in sorted(tensors.items()):
                if self.names is not None and name not in self.names:
                    continue
                total, width = math.prod(t["shape"]), WIDTH[t["dtype"]]
                for first in range(0, max(total, 1), self.chunk):
                    chunk = Chunk(file, name, t["dtype"], tuple(t["shape"]), first, base + t["data_offsets"][0] + first * width, min(self.chunk, total - first))
                    if not out or size + chunk.count > self.task:
                        out.append(Share([]))
                        size = 0
                    out[-1].chunks.append(chunk)
                    size += chunk.count
        return out or [Share([])]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        for file, chunks in itertools.groupby(partition.chunks, key=lambda c: c.file):
            fs, path = opened(file)
            with fs.open_input_file(path) as f:
                held, size = [], 0
                for c in chunks:
                    held.append((c, as_numbers(f.read_at(c.count * WIDTH[c.dtype], c.begin), c.dtype).astype(np.float64)))
                    size += c.count
                    if size >= self.chunk or len(held) == 1024:
                        yield self._batch(file, held)
                        held, size = [], 0
                if held:
                    yield self._batch(file, held)

    @staticmethod
    def _batch(file: str, held: list[tuple[Chunk, np.ndarray]]) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(v) for _, v in held)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([v for _, v in held])))
        head = [[file] * len(held), [c.name for c, _ in held], [c.dtype for c, _ in held]]
        shapes, firsts = pa.array([list(c.shape) for c, _ in held], pa.list_(pa.int64())), pa.array([c.first for c, _ in held], pa.int64())
        return pa.RecordBatch.from_arrays([*map(pa.array, head), shapes, firsts, lists], names=["file", "name", "dtype", "shape", "first", "values"])


@dataclass
class Files(WriterCommitMessage):
    names: list[str]


class Writer(DataSourceWriter):
    """Rows with name and values, and dtype (F64 or F32, F32 by default) and shape where they have these columns."""

    def __init__(self, options: dict[str, str], columns: list[str]):
        if not {"name", "values"} <= set(columns):
            raise ValueError("weights need the columns name and values")
        self.uri, self.limit = options["path"], int(options.get("file_bytes", FILE_BYTES))

    def write(self, rows: Iterator) -> Files:
        fs, folder = opened(self.uri)
        fs.create_dir(folder, recursive=True)
        attempt, names, held, size = uuid.uuid4().hex, [], {}, 0

        def close() -> None:
            head, at = {}, 0
            for name, (dtype, shape, raw) in held.items():
                head[name] = {"dtype": dtype, "shape": shape, "data_offsets": [at, at + len(raw)]}
                at += len(raw)
            text = json.dumps(head).encode()
            name = f"part-{attempt}-{len(names):04d}{SUFFIX}"
            with fs.open_output_stream(f"{folder}/_{name}", compression=None) as out:
                out.write(struct.pack("<Q", len(text)) + text)
                for _, _, raw in held.values():
                    out.write(raw)
            names.append(name)
            held.clear()

        for row in rows:
            r = row.asDict()
            if r["name"] is None or r["name"] in held:
                raise ValueError(f"a tensor without a name of its own: {r['name']}")
            dtype = r.get("dtype") or "F32"
            raw = np.array(r["values"] or [], dtype={"F64": "<f8", "F32": "<f4"}[dtype]).tobytes()
            if held and size + len(raw) > self.limit:
                close()
                size = 0
            held[r["name"]] = (dtype, list(r.get("shape") or [len(raw) // WIDTH[dtype]]), raw)
            size += len(raw)
        if held:
            close()
        return Files(names)

    def commit(self, messages: list[Files | None]) -> None:
        fs, folder = opened(self.uri)
        for m in messages:
            for name in m.names if m else ():
                fs.move(f"{folder}/_{name}", f"{folder}/{name}")

    def abort(self, messages: list[Files | None]) -> None:
        fs, folder = opened(self.uri)
        for m in messages:
            for name in m.names if m else ():
                fs.delete_file(f"{folder}/_{name}")


class Weights(DataSource):
    @classmethod
    def name(cls) -> str:
        return "weights"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options, schema.names)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it have filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Weights)
