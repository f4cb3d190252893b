"""Exact top-k inner-product search with KD-trees per shard.

Rows are dealt by space: a KD-tree over a sample of ``SAMPLE`` rows (it balances, and decides nothing
else) cuts space into ``REGIONS`` regions at most, and every row goes to its region, with the
others of its length. A region is dealt to shards of bounded size by a hash of the id, so equal
vectors don't make a large shard. Every region has a tight box over all of its rows.

In each shard a KD-tree splits at medians along the widest dimension and keeps tight bounding boxes.
A query walks a tree best first: a box bounds the inner product by taking, dimension by dimension,
the end that suits the query's sign, and the walk ends when no box can reach the kth score. The kth
score travels: a query first searches its home shard, and the score found there is the floor with
which it is sent on, and only to the regions whose boxes can reach it.

A shard's rows arrive before its queries in one sorted stream, so a task holds one shard and
one batch of queries at a time; queries are never broadcast or collected, region boxes are broadcast.

Null and odd cases: a vector that is null or holds a null or non-finite component takes no
part, nor does a row with a null id; an empty vector has score 0 against other empty ones;
vectors of different lengths are never compared; rows that repeat id and vector count once;
rows that share only the id are all candidates, none for the queries under that id, whose results
merge; ties go to the smaller id; an empty table gives an empty result; other columns are ignored.
Scores are exact integers; beyond the range of a long they stop at its ends.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

LEAF_ROWS = 64
#: Upper limit for a shard; small tables get smaller shards so that all cores have one.
SHARD_ROWS = 65536
MIN_SHARD_ROWS = 1024
#: Regions of space, which bound the boxes that are broadcast, and about how many rows lay them out.
REGIONS = 1024
SAMPLE = 16384
#: Queries whose bounds to all boxes of a tree are held at once.
QUERY_ROWS = 256
LONG = 2**63 - 1


def _within_long(x: np.ndarray) -> np.ndarray:
    """Python's integers stop at the ends of a long before they are compared, so that ties are ties."""
    return np.clip(x, -LONG - 1, LONG) if x.dtype == object else x


class KDTree:
    """Median splits over the rows of one shard; rows are stored leaf by leaf."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.arange(len(ids))
        lo, hi, span, child = [], [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            rows = vectors[order[start:end]]
            low, high = rows.min(axis=0), rows.max(axis=0)
            node = len(lo)
            lo.append(low)
            hi.append(high)
            span.append((start, end))
            child.append([-1, -1])
            if parent >= 0:
                child[parent][side] = node
            if end - start > leaf and rows.shape[1] and (high > low).any():
                at = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(rows[:, int(np.argmax(high - low))], at)]
                todo += [(start, start + at, node, 0), (start + at, end, node, 1)]
        self.ids, self.vectors = ids[order], vectors[order]
        self.lo, self.hi, self.span, self.child = np.array(lo), np.array(hi), span, child

    def search(self, own: np.ndarray, queries: np.ndarray, floors: list[int | None], k: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(position of the query, its best (score, id) that reach the floor)."""
        bounds = _within_long(np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T)
        for i, (me, q, floor) in enumerate(zip(own, queries, floors, strict=True)):
            bound, best = bounds[i], []  # best: a heap of (score, -id), the worst first
            kth = -math.inf if floor is None else floor
            heap = [(-bound[0], 0)]
            while heap:
                ub, node = heapq.heappop(heap)
                if -ub < kth:
                    break
                left, right = self.child[node]
                if left >= 0:
                    for c in (left, right):
                        if bound[c] >= kth:
                            heapq.heappush(heap, (-bound[c], c))
                    continue
                start, end = self.span[node]
                scores, ids = _within_long(self.vectors[start:end] @ q), self.ids[start:end]
                for j in np.flatnonzero((scores >= kth) & (ids != me)):
                    entry = (int(scores[j]), -int(ids[j]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    kth = max(kth, best[0][0])
            if best:
                yield i, [(s, -n) for s, n in best]


def _matrix(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.array(column.value_lengths()))
    return np.split(flat, ends[:-1]) if len(ends) else []


def _search_stream(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    shard, stock, trees = None, [], None

    def build() -> dict[int, tuple[np.ndarray, np.ndarray]]:
        by_dim: dict[int, dict[tuple[int, bytes], np.ndarray]] = {}
        for ids, vecs in stock:
            for i, v in zip(ids, vecs, strict=True):
                by_dim.setdefault(len(v), {})[(int(i), v.tobytes())] = v
        out = {}
        for dim, rows in by_dim.items():
            out[dim] = (np.array([i for i, _ in rows], dtype=np.int64), np.stack(list(rows.values())))
        return out

    def tree_for(dim: int, wide: bool) -> KDTree:
        """Doubles hold the products exactly below 2**53; beyond, Python's integers do."""
        if (dim, wide) not in trees:
            ids, m = raw[dim]
            trees[dim, wide] = KDTree(ids, m.astype(object) if wide else m.astype(np.float64))
        return trees[dim, wide]

    raw: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        sh, kind = batch["shard"].to_numpy(), batch["kind"].to_numpy()
        if not len(sh):
            continue
        cuts = [0, *(np.flatnonzero((np.diff(sh) != 0) | (np.diff(kind) != 0)) + 1), len(sh)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            ids, vecs = part["id"].to_numpy(), _matrix(part["v"])
            if sh[a] != shard:
                shard, stock, trees = sh[a], [], None
            if kind[a] == 0:
                stock.append((ids, vecs))
                continue
            if trees is None:
                raw, trees, stock = build(), {}, []
            floors = part["floor"].to_pylist()
            out: tuple[list, list, list] = ([], [], [])
            for dim in sorted({len(v) for v in vecs}):
                if dim not in raw:
                    continue
                at = [i for i, v in enumerate(vecs) if len(v) == dim]
                q = np.stack([vecs[i] for i in at])
                largest = max((float(np.abs(x.astype(float)).max()) if x.size else 0.0) for x in (q, raw[dim][1]))
                wide = dim * largest * largest >= 2.0**53
                tree = tree_for(dim, wide)
                q = q.astype(object) if wide else q.astype(np.float64)
                for first in range(0, len(at), QUERY_ROWS):
                    some = at[first : first + QUERY_ROWS]
                    for i, found in tree.search(ids[some], q[first : first + QUERY_ROWS], [floors[j] for j in some], k):
                        for score, n in found:
                            out[0].append(int(ids[some[i]]))
                            out[1].append(n)
                            out[2].append(score)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])


def quantized(vector: Column, scale: float = 1024.0) -> Column:
    """Components as floor(scale * x); null where the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


class Layout:
    """Median splits of space into regions 1 and on, for vectors of one length; all others are region 0."""

    def __init__(self, vectors: list[np.ndarray], regions: int):
        sizes = Counter(len(v) for v in vectors)
        self.dim = min(sizes, key=lambda d: (-sizes[d], d)) if sizes else -1
        own = np.stack([v for v in vectors if len(v) == self.dim]) if sizes else np.zeros((0, 0), dtype=np.int64)
        self.axis, self.cut, self.child, self.region, self.depth = [0], [0], [[0, 0]], [1], 0
        todo = deque([(0, own, 0)])
        n = 1
        while todo and n < regions:
            node, rows, depth = todo.popleft()
            if len(rows) < 2 or not rows.shape[1]:
                continue
            axis = int(np.argmax(rows.max(axis=0).astype(float) - rows.min(axis=0).astype(float)))
            values = np.sort(rows[:, axis])
            cut = values[len(values) // 2]
            if values[0] == cut:  # many rows share the least value: cut above it
                above = values[values > cut]
                if not len(above):
                    continue
                cut = above[0]
            right = rows[:, axis] >= cut
            n += 1
            self.axis[node], self.cut[node] = axis, int(cut)
            self.child[node] = [len(self.axis), len(self.axis) + 1]
            for part, region in ((rows[~right], self.region[node]), (rows[right], n)):
                todo.append((len(self.axis), part, depth + 1))
                self.axis.append(0)
                self.cut.append(0)
                self.child.append([len(self.axis) - 1] * 2)  # a leaf leads to itself
                self.region.append(region)
            self.depth = max(self.depth, depth + 1)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The region of each row of a matrix."""
        node = np.zeros(len(vectors), dtype=np.int64)
        axis, cut, child = np.array(self.axis), np.array(self.cut, dtype=np.int64), np.array(self.child)
        if vectors.shape[1]:
            for _ in range(self.depth):
                side = vectors[np.arange(len(vectors)), axis[node]] >= cut[node]
                node = child[node, side.astype(np.int64)]
        return np.array(self.region)[node]


def _of_length(vecs: list[np.ndarray], dim: int) -> tuple[list[int], np.ndarray]:
    """Positions of the vectors of a length, and these as a matrix."""
    at = [i for i, v in enumerate(vecs) if len(v) == dim]
    return at, np.stack([vecs[i] for i in at]) if at else np.zeros((0, max(dim, 0)), dtype=np.int64)


def _place(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Add every row's region."""
    for batch in batches:
        region = np.zeros(batch.num_rows, dtype=np.int32)
        at, m = _of_length(_matrix(batch["v"]), layout.dim)
        region[at] = layout.of(m)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], names=[*batch.schema.names, "region"])


def _boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """region, lo, hi: one row for each region that a task meets."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        region, m = batch["region"].to_numpy(), np.stack(_matrix(batch["v"]))
        for r in np.unique(region).tolist():
            rows = m[region == r]
            lo, hi = rows.min(axis=0), rows.max(axis=0)
            held[r] = (np.minimum(lo, held[r][0]), np.maximum(hi, held[r][1])) if r in held else (lo, hi)
    if held:
        cols = [pa.array(list(held), pa.int32()), *(pa.array([x[i].tolist() for x in held.values()], pa.list_(pa.int64())) for i in (0, 1))]
        yield pa.RecordBatch.from_arrays(cols, names=["region", "lo", "hi"])


def _reached(batches: Iterator[pa.RecordBatch], dim: int, regions: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Add the regions whose boxes can reach a query's floor; all of them where doubles aren't exact."""
    least, most = lo.astype(np.float64), hi.astype(np.float64)
    largest = max((float(np.abs(x).max()) for x in (least, most) if x.size), default=0.0)
    for whole in batches:
        for first in range(0, whole.num_rows, QUERY_ROWS):
            batch = whole.slice(first, QUERY_ROWS)
            vecs, floors = _matrix(batch["v"]), batch["floor"].to_pylist()
            out: list[list[int]] = [[0]] * len(vecs)  # rows of other lengths are all in region 0
            at, m = _of_length(vecs, dim)
            q = m.astype(np.float64)
            bounds = np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T if at else None
            for i, j in enumerate(at):
                exact = q.shape[1] * largest * float(np.abs(q[i]).max(initial=0.0)) < 2.0**53
                out[j] = regions[bounds[i] >= floors[j]].tolist() if exact and floors[j] is not None else regions.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "regions"])


def region_boxes(placed: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regions from 1 on with the least and largest components of all their rows; ``REGIONS`` at most."""
    parts = placed.where("region > 0").select("region", "v").mapInArrow(_boxes, "region int, lo array<long>, hi array<long>")
    ends = parts.select("region", F.posexplode_outer(F.arrays_zip("lo", "hi")).alias("pos", "x")).groupBy("region", "pos").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi"))
    listed = ends.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("pos", "lo", "hi"))).alias("ends")).collect()
    width = lambda name: np.array([[e[name] for e in r["ends"] if e["pos"] is not None] for r in listed], dtype=np.int64)
    return np.array([r["region"] for r in listed], dtype=np.int32), width("lo"), width("hi")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for every row where ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col), scale).alias("v"), is_query.alias("asks")
    )
    rows = rows.where(F.col("v").isNotNull())
    n = rows.count()
    cores = spark.sparkContext.defaultParallelism
    regions = min(REGIONS, max(math.ceil(n / SHARD_ROWS), min(2 * cores, math.ceil(n / MIN_SHARD_ROWS)), 1))
    seen = rows.select("v").sample(min(1.0, SAMPLE / max(n, 1)), seed=1).limit(2 * SAMPLE).toArrow()["v"].combine_chunks()
    layout = Layout(_matrix(seen), regions)
    placed = written(rows.mapInArrow(lambda it: _place(it, layout), "id long, v array<long>, asks boolean, region int"), "topk-rows")

    shards, dealt = 0, []  # region, its first shard, how many it has
    for r in sorted(placed.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()):  # a row a region
        dealt.append((r["region"], shards, math.ceil(r["n"] / SHARD_ROWS)))
        shards += dealt[-1][2]
    shards = max(shards, 1)
    table = F.broadcast(spark.createDataFrame(dealt, "region int, first int, parts int"))
    placed = placed.join(table, "region").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int"))
    nothing = F.lit(None).cast("long").alias("floor")
    stock = placed.select("shard", F.lit(0).alias("kind"), "id", "v", nothing)
    asked = placed.where("asks").select(F.col("shard").alias("home"), "id", "v").distinct()

    def search(queries: DataFrame) -> DataFrame:
        stream = stock.unionByName(queries).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind", "id")
        return stream.mapInArrow(lambda it: _search_stream(it, k), "query_id long, vec_id long, score long")

    at_home = asked.select(F.col("home").alias("shard"), F.lit(1).alias("kind"), "id", "v", nothing)
    first = written(_ranked(search(at_home), k), "topk-home")
    if shards > 1:
        floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        boxes = spark.sparkContext.broadcast(region_boxes(placed))
        reached = asked.join(floors, "id", "left").mapInArrow(
            lambda it: _reached(it, layout.dim, *boxes.value), "id long, home int, v array<long>, floor long, regions array<int>"
        )
        away = (
            reached.withColumn("region", F.explode("regions"))
            .join(table, "region")
            .withColumn("shard", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)))
            .where(F.col("shard") != F.col("home"))
            .select("shard", F.lit(1).alias("kind"), "id", "v", "floor")
        )
        first = _ranked(first.select("query_id", "vec_id", "score").unionByName(search(away)), k)
    return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
