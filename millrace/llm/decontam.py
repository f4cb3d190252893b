"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of an item, or a whole item of fewer words. Every window
holds shingles of up to ``SHINGLE`` words. Shingles are ordered by rarity, that is by how often
they occur in all documents; a document can only contain a window if it contains the window's
rarest shingle, so that one shingle is the window's prefix. Joining documents with windows on
prefixes gives candidates at known positions; a candidate must fit into the document (positional
and length bounds) and is then compared word by word, over the window's whole length.

Up to ``BLOCK_BYTES`` of benchmark text, windows are broadcast and joined where the documents are
read, without any shuffle. Beyond, the same join is one of tables: documents are passed three times
(to count shingles, to give the places of prefixes with the words around them, to take the answers),
however large the benchmark is, and bitmaps of bounded size keep out shingles that no window has.
Places of a frequent prefix, and texts of a frequent window, are dealt over parts, to each of which the
windows or items go.

Null and odd cases: a null text has no words and is not contaminated; an item without words has no
window; words are found in texts of any length; repeated documents give repeated rows; an item
with a null id marks words but is neither counted nor listed; repeated items count once; an empty
benchmark leaves every document clean; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import bitmap_of, frequent, in_bitmap, joined_by_share, joined_in_parts, named, rolled, utf8, written

SHINGLE = 3
#: Most UTF-8 bytes of benchmark text that are broadcast.
BLOCK_BYTES = 1 << 20
#: Hashes held in a task before they are added up and handed on.
HELD = 1 << 20
#: ASCII letters in lower case and digits stay, so do all bytes above ASCII; the rest separates words.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(TABLE).split()


def windows_of(words: list[bytes], window: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def shingles_of(words: list[bytes], size: int) -> list:
    if size == 1:
        return words
    return list(zip(*(words[i:] for i in range(size)), strict=False))


class Block:
    """The windows of items of bounded size, with an index by prefix once rarity is known."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int):
        owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item_id, raw in items:
            for w in windows_of(words_of(raw), window):
                owners[w].update([] if item_id is None else [item_id])
        self.windows = [(w, frozenset(ids)) for w, ids in owners.items()]
        self.sizes = sorted({min(SHINGLE, len(w)) for w, _ in self.windows})
        self.wanted = {s: {x for w, _ in self.windows if min(SHINGLE, len(w)) == s for x in shingles_of(list(w), s)} for s in self.sizes}

    def ranked(self, counts: Counter) -> dict[int, dict]:
        """size of shingle -> prefix -> [(offset of the prefix in the window, window, items)]"""
        index: dict[int, dict] = {s: defaultdict(list) for s in self.sizes}
        for w, ids in self.windows:
            s = min(SHINGLE, len(w))
            own = shingles_of(list(w), s)
            offset = min(range(len(own)), key=lambda i: (counts[_key(own[i])], _key(own[i]), i))
            index[s][own[offset]].append((offset, list(w), ids))
        return {s: dict(x) for s, x in index.items()}


def _key(shingle) -> bytes:
    return shingle if isinstance(shingle, bytes) else b" ".join(shingle)


def find(words: list[bytes], index: dict[int, dict]) -> tuple[list[tuple[int, int]], set[str]]:
    """The stretches of words that are occurrences of windows, and the items they come from."""
    spans: set[tuple[int, int]] = set()
    items: set[str] = set()
    n = len(words)
    for size, prefixes in index.items():
        own = shingles_of(words, size)
        if prefixes.keys().isdisjoint(own):
            continue
        for at, shingle in enumerate(own):
            for offset, w, ids in prefixes.get(shingle, ()):
                start = at - offset
                if start >= 0 and start + len(w) <= n and words[start : start + len(w)] == w:
                    spans.add((start, start + len(w)))
                    items |= ids
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged, items


def _count(batches: Iterator[pa.RecordBatch], wanted_by_size: dict[int, set]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for raw in batch["raw"]:
            words = words_of(raw.as_py())
            for size, wanted in wanted_by_size.items():
                total.update(_key(x) for x in shingles_of(words, size) if x in wanted)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["shingle", "n"])


def rarity(docs: DataFrame, block: Block) -> Counter:
    """How often each of the block's shingles occurs in all documents; the block bounds the result."""
    shared = docs.sparkSession.sparkContext.broadcast(block.wanted)
    rows = docs.select(utf8("text").alias("raw")).mapInArrow(lambda it: _count(it, shared.value), "shingle binary, n long")
    return Counter({bytes(r["shingle"]): r["n"] for r in rows.groupBy("shingle").agg(F.sum("n").alias("n")).toLocalIterator()})


def _digest(n_words: int, spans: list[tuple[int, int]], items: Iterable[str]) -> tuple:
    hit, own = sum(b - a for a, b in spans), sorted(items)
    return n_words, hit, len(own), hashlib.sha256(",".join(own).encode()).hexdigest(), hit > 0


DIGEST = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
          T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType())]


def _scan(batches: Iterator[pa.RecordBatch], index: dict[int, dict]) -> Iterator[pa.RecordBatch]:
    """Each document's id and its digest columns."""
    for batch in batches:
        rows = []
        for raw in batch["raw"]:
            words = words_of(raw.as_py())
            rows.append(_digest(len(words), *find(words, index)))
        own = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True)] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *own], names=["doc_id", *(f.name for f in DIGEST)])


def _bytes_of(benchmark: DataFrame) -> int:
    return benchmark.agg(F.sum(F.octet_length(utf8("text")))).first()[0] or 0


def _small_index(docs: DataFrame, benchmark: DataFrame, window: int) -> dict[int, dict]:
    """The windows of a benchmark of bounded size by prefix."""
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), utf8("text").alias("raw"))
    block = Block(((r["item_id"], bytes(r["raw"])) for r in items.toLocalIterator()), window)
    return block.ranked(rarity(docs, block)) if block.windows else {}


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """window (its words, a sign a byte), n, item_id, and the hashes of its shingles in order."""
    for batch in batches:
        rows = []
        for item, raw in zip(batch["item_id"].to_pylist(), batch["raw"], strict=True):
            for w in windows_of(words_of(raw.as_py()), window):
                rows.append((b" ".join(w).decode("latin-1"), len(w), item, rolled(list(w), min(SHINGLE, len(w))).view(np.int64).tolist()))
        cols = zip(*rows, strict=True) if rows else ([], [], [], [])
        types = (pa.string(), pa.int32(), pa.string(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["window", "n", "item_id", "shingles"])


def _count_held(batches: Iterator[pa.RecordBatch], sizes: list[int], bitmap: bytes) -> Iterator[pa.RecordBatch]:
    """How often shingles occur whose bits are set, partly added up."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    for batch in batches:
        for raw in batch["raw"]:
            words = words_of(raw.as_py())
            for size in sizes:
                h = rolled(words, size)
                held.append(h[in_bitmap(h, bitmap)])
        if sum(map(len, held)) > HELD:
            yield flush()
    if held:
        yield flush()


def _places(batches: Iterator[pa.RecordBatch], sizes: list[int], bitmaps: list[bytes], window: int) -> Iterator[pa.RecordBatch]:
    """Where prefixes may be: the text's key, the shingle's hash, how many words of it come before in
    ``words``, the place of the first of these, and the words around it, a sign a byte: so bytes of any
    kind are compared as they are. A prefix of fewer than ``SHINGLE`` words is its whole window."""
    names = ["key", "h", "ahead", "first", "words"]
    types = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()))
    for batch in batches:
        rows = []
        for raw in batch["raw"]:
            text = raw.as_py()
            words = words_of(text)
            key = None
            for size in sizes:
                h = rolled(words, size)
                around = window if size == SHINGLE else 0
                for at in np.flatnonzero(np.logical_and.reduce([in_bitmap(h, x) for x in bitmaps])).tolist():
                    key = key or hashlib.sha256(text).hexdigest()
                    first = max(0, at - around)
                    rows.append((key, int(h[at].view(np.int64)), at - first, first, [w.decode("latin-1") for w in words[first : at + max(around, size)]]))
            if len(rows) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _joined(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """key (the text's SHA-256), spans and items of every contaminated text, by joins of tables."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    texts = docs.select(utf8("text").alias("raw"))
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), utf8("text").alias("raw"))
    owned = written(items.mapInArrow(lambda it: _windows(it, window), "window string, n int, item_id string, shingles array<long>").distinct(), "decontam-windows")
    windows = written(owned.select("window", "n", "shingles").distinct(), "decontam-distinct")
    sizes = sorted(r["s"] for r in windows.select(F.least(F.col("n"), F.lit(SHINGLE)).alias("s")).distinct().collect())  # SHINGLE rows at most
    own = windows.select("window", "n", F.posexplode("shingles").alias("offset", "h"))
    held = broadcast(bitmap_of(own.select("h").distinct()))
    counts = texts.mapInArrow(lambda it: _count_held(it, sizes, held.value), "h long, n long").groupBy("h").agg(F.sum("n").alias("c"))
    counts = written(counts, "decontam-counts")
    rarest = F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "h", "offset")).alias("p")
    prefix = own.join(counts, "h", "left").groupBy("window", "n").agg(rarest).select("p.h", "p.offset", "window", "n")
    prefix = written(prefix, "decontam-prefixes")
    wanted = broadcast(bitmap_of(prefix.select("h").distinct()))
    kind = "key string, h long, ahead int, first int, words array<string>"
    places = texts.mapInArrow(lambda it: _places(it, sizes, [held.value, wanted.value], window), kind).distinct()  # equal texts count once
    # whatever has its bits set in both bitmaps has been counted: prefixes, and what has their bits by chance
    count = counts.select("h", F.col("c").alias("n"))
    chance = frequent(count.join(prefix, "h", "left_anti"), "h")
    places = places.join(F.broadcast(chance), "h", "left_anti")
    start = F.col("ahead") - F.col("offset")
    placed = joined_in_parts(places, prefix, "h", count.join(prefix, "h", "left_semi"), ["key", "first", "ahead"])
    found = placed.where(start >= 0).where(F.array_join(F.slice("words", start + 1, F.col("n")), " ") == F.col("window"))
    span = F.struct((F.col("first") + start).cast("long").alias("a"), (F.col("first") + start + F.col("n")).cast("long").alias("b"))
    found = written(found.select("key", F.sha2("window", 256).alias("window"), span.alias("span")).distinct(), "decontam-found")
    spans = found.groupBy("key").agg(F.collect_set("span").alias("spans"))  # as many as the text has words, at most
    held_by = written(found.select("key", "window").distinct(), "decontam-texts")
    owners = owned.where(F.col("item_id").isNotNull()).select(F.sha2("window", 256).alias("window"), "item_id")
    named_by = joined_in_parts(held_by, owners, "window", held_by.groupBy("window").agg(F.count(F.lit(1)).alias("n")), ["key"])
    listed = named_by.select("key", "item_id").distinct().groupBy("key").agg(F.collect_list("item_id").alias("items"))
    return written(spans.join(listed, "key", "left"), "decontam-hits")


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    rows = docs.select("doc_id", utf8("text").alias("raw"))
    if _bytes_of(benchmark) <= block_bytes:
        return _with_index(rows, _scan, _small_index(docs, benchmark, window), T.StructType([docs.schema["doc_id"], *DIGEST]))
    hits = _joined(docs, benchmark, window)
    narrow = written(rows.select("doc_id", F.sha2("raw", 256).alias("key"), _word_count(F.col("raw")).alias("n_words")), "decontam-rows")
    copies = narrow.join(hits.select("key"), "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    digests = hits.select(
        "key",
        _covered(F.col("spans")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join(F.array_sort("items"), ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
    )
    digests = written(digests.join(copies, "key"), "decontam-digests")
    out = joined_by_share(narrow, F.col("key"), digests, "key", "copies", narrow.count())
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("n_hit").isNull(), F.lit(0)).otherwise(F.col("n_items")).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def _with_index(rows: DataFrame, step, index: dict[int, dict], schema: T.StructType | str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(index)
    return rows.mapInArrow(lambda it: step(it, shared.value), schema)


def _word_count(raw: Column) -> Column:
    return F.coalesce(F.regexp_count(raw.cast("string"), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)).cast("long")


def _covered(spans: Column) -> Column:
    """Length of the union of stretches."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum"))
    step = lambda s, x: F.struct(
        F.greatest(s["end"], x["b"]).alias("end"),
        (s["sum"] + F.greatest(x["b"] - F.greatest(s["end"], x["a"]), F.lit(0).cast("long"))).alias("sum"),
    )
    return F.coalesce(F.aggregate(F.array_sort(spans), start, step, lambda s: s["sum"]), F.lit(0).cast("long"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without those that hold a window of an item, all columns kept. Only texts go to Python, only verdicts return."""
    own = docs.columns
    if _bytes_of(benchmark) > block_bytes:
        # the keys of contaminated texts; whole rows only move if these are too many to be broadcast
        hit = _joined(docs, benchmark, window).select(F.col("key").alias("_hit"))
        return docs.join(hit, F.sha2(utf8("text"), 256) == F.col("_hit"), "left_anti").select(*[named(c) for c in own])
    index = _small_index(docs, benchmark, window)
    if not index:
        return docs.select(*[named(c) for c in own])
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("boolean")
    def contaminated(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for raws in texts:
            yield pa.array([bool(find(words_of(raw.as_py()), shared.value)[0]) for raw in raws], pa.bool_())

    return docs.where(~contaminated(utf8("text"))).select(*[named(c) for c in own])
