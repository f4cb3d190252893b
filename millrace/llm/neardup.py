"""Near-duplicate groups by b-bit MinHash, confirmed on full shingle sets.

1. Sketch: each text becomes its set of distinct ``size``-word shingles (64-bit hashes), minima
   of ``BANDS * ROWS`` permutations, the minima's low ``BITS`` bits packed into a signature, and
   one hash for each band of ``ROWS`` minima. Equal word sequences form one class.
2. Candidates: classes that share a band's hash meet in a bucket. There, similarity is estimated
   from the signatures by bit counts, corrected for chance collisions of the kept bits. Pairs far
   enough below the threshold (``MARGIN`` standard errors) are passed over.
3. Confirmation: pairs are dealt to blocks by one end. A block holds the full sets of about
   ``BLOCK`` ends, and of about ``HELD`` shingles at most, takes every other set that it needs once, and links a pair if
   100 * |intersection| >= percent * |union|.
4. Components: links are contracted by hooking to the smallest neighbour and pointer jumping.

Large groups never become all their pairs. At first a bucket is cut into chunks of ``FIRST`` members,
all of which hold one common member. A chunk offers each member's pair with the chunk's hub (the
member that most others resemble) and its few best partners. Once those are confirmed and contracted,
a bucket whose members all belong together is done. In the others, members are cut into chunks by
component, and every two chunks that are not of one component are compared once, by signatures of
``LONG`` one-bit values; all pairs between different components that may be similar are confirmed.
A bucket that still holds more than ``WIDE`` such members isn't cut into all its pairs of chunks: its
members meet again by the rarest shingles of their sets (the prefixes below), which lose no link.

What can be missed: a link at exactly the threshold shares no band once in 300,000 cases, a more
similar one more rarely; each estimate passes over a link with the chance of a deviation of ``MARGIN``
standard errors, about 1 in 3 million. ``exact=True`` takes neither risk: buckets are then the
shingles of a prefix (all but so many of a set's most frequent shingles that two similar sets must
share one of the others), and no estimate rules out a pair. That costs a count of all shingles.

Null and odd cases: a text that is null or has no words has an empty set and links with nothing;
one of fewer words than a shingle is a single shingle; texts of any length count whole; rows that
share an id are one node; a null id, and one that is no integer, links with nothing and has a null
component; repeated rows give repeated rows; an empty table gives an empty result; other columns, of
any name, are ignored by ``groups`` and pass through ``near_duplicates``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import STEP, bitmap_of, in_bitmap, mixed, rolled, utf8, written

BANDS, ROWS, BITS = 32, 5, 4
HASHES = BANDS * ROWS
WORDS = HASHES * BITS // 64
MARGIN = 5.0
#: Members of a chunk in the first round, and in the second.
FIRST, CHUNK = 256, 1024
#: Ends whose full sets a block holds; an end of more than ``LARGE`` shingles has a block of its own.
BLOCK, LARGE = 256, 1 << 16
#: Shingles of the sets that a block holds.
HELD = 1 << 21
#: Members, not all of one component, beyond which a bucket is replaced by buckets of rare shingles.
WIDE = 1 << 15
#: Partners that a member offers at first.
PARTNERS = 3
#: One-bit values of the second signature.
LONG = 4096
#: Stands for the chunks that hold several components.
MIXED = -(1 << 63)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _constants(name: str, n: int, dtype) -> np.ndarray:
    raw = b"".join(hashlib.sha256(f"{name}:{i}".encode()).digest()[: np.dtype(dtype).itemsize] for i in range(n))
    return np.frombuffer(raw, dtype=dtype).copy()


FACTOR = _constants("factor", HASHES, np.uint32) | np.uint32(1)
SHIFT = _constants("shift", HASHES, np.uint32)
LONG_FACTOR = _constants("long factor", LONG, np.uint32) | np.uint32(1)
LONG_SHIFT = _constants("long shift", LONG, np.uint32)


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(LOWER).split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    from xxhash import xxh3_64_intdigest as h

    if len(words) < size:
        return np.array([h(b" ".join(words), 1)] if words else [], dtype=np.uint64)
    return np.unique(rolled(words, size))


def minima(shingles: np.ndarray, factor: np.ndarray = FACTOR, shift: np.ndarray = SHIFT) -> np.ndarray:
    """Minima of a linear permutation for each factor, then mixed, so that their low bits depend on all."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factor), 0xFFFFFFFF, dtype=np.uint32)
    step = max(1, (1 << 18) // len(factor))
    for i in range(0, len(h), step):
        np.minimum(best, (h[i : i + step, None] * factor + shift).min(axis=0), out=best)
    best = (best ^ (best >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    best = (best ^ (best >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return best ^ (best >> np.uint32(16))


def packed(mins: np.ndarray, bits: int = BITS) -> bytes:
    """The low bits of each minimum: four (two minima in a byte) or one."""
    if bits == 1:
        return np.packbits((mins & np.uint32(1)).astype(np.uint8)).tobytes()
    low = (mins & np.uint32(15)).astype(np.uint8)
    return (low[0::2] | (low[1::2] << 4)).tobytes()


def band_hashes(mins: np.ndarray) -> np.ndarray:
    m = mins.reshape(BANDS, ROWS).astype(np.uint64)
    x = np.arange(1, BANDS + 1, dtype=np.uint64) * STEP[0]
    for i in range(ROWS):
        x = mixed(x * STEP[1] + m[:, i])
    return x.view(np.int64)


def matches(one: np.ndarray, many: np.ndarray, bits: int = BITS) -> np.ndarray:
    """How many of the packed values agree, by bit counts. one: (words,), many: (n, words)."""
    x = one ^ many
    if bits > 1:
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        x &= np.uint64(0x1111111111111111)
    return many.shape[-1] * 64 // bits - np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def least_matches(percent: int, hashes: int = HASHES, bits: int = BITS) -> int:
    """Fewer agreeing values than this mean, beyond doubt, less than ``percent`` similarity."""
    chance = 2.0**-bits
    j = percent / 100
    q = j + (1 - j) * chance
    return max(0, math.floor(hashes * (q - MARGIN * math.sqrt(q * (1 - q) / hashes))))


def similarity(agreeing: np.ndarray, hashes: int = HASHES, bits: int = BITS) -> np.ndarray:
    """Collision-corrected estimate of the Jaccard similarity."""
    chance = 2.0**-bits
    return (np.asarray(agreeing) / hashes - chance) / (1 - chance)


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, sigs, bands = [], [], [], []
        for raw in batch["raw"]:
            words = words_of(raw.as_py())
            s = shingle_hashes(words, size)
            counts.append(len(s))
            if not len(s):
                digests.append(None), sigs.append(None), bands.append(None)
                continue
            m = minima(s)
            digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
            sigs.append(packed(m))
            bands.append(band_hashes(m))
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["id", "n", "digest", "sig", "bands"],
        )


def sketches(docs: DataFrame, size: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").try_cast("long").alias("id"), utf8("text").alias("raw"))
    return rows.mapInArrow(lambda it: _sketch(it, size), "id long, n long, digest binary, sig binary, bands array<long>")


def _alike(i: int, others: np.ndarray, label: np.ndarray, n: np.ndarray, sig: np.ndarray, percent: int, bits: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Agreeing values with the others, and those of them that may be linked with i and are of another component."""
    fits = others[(100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])) & (label[others] != label[i])]
    got = matches(sig[i], sig[fits], bits)
    return got[got >= least], fits[got >= least]


def _some_pairs(cid: np.ndarray, n: np.ndarray, sig: np.ndarray, percent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of each member's pairs with its best partners and with the hub."""
    size = len(cid)
    first, second = [], []
    degree = np.zeros(size, dtype=np.int64)
    everyone = np.arange(size)
    for i in range(size):
        got, js = _alike(i, everyone, cid, n, sig, percent, BITS, least)
        degree[i] = len(js)
        js = js[np.lexsort((cid[js], -got))][:PARTNERS]
        first.append(np.full(len(js), i))
        second.append(js)
    if size > PARTNERS + 1:
        hub = int(np.lexsort((cid, -degree))[0])
        _, js = _alike(hub, everyone, cid, n, sig, percent, BITS, least)
        first.append(np.full(len(js), hub))
        second.append(js)
    return np.concatenate(first), np.concatenate(second)


def _all_pairs(label: np.ndarray, n: np.ndarray, sig: np.ndarray, side: np.ndarray, percent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs between the two sides, or, if there is one side, of all pairs."""
    first, second = [], []
    cut = int(np.searchsorted(side, 1))
    for i in range(cut if cut < len(side) else len(side) - 1):
        others = np.arange(cut if cut < len(side) else i + 1, len(side))
        _, js = _alike(i, others, label, n, sig, percent, 1, least)
        first.append(np.full(len(js), i))
        second.append(js)
    return (np.concatenate(first), np.concatenate(second)) if first else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _pair_stream(batches: Iterator[pa.RecordBatch], percent: int, least: int, first_round: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit of work; a unit may span batches."""
    held: list[tuple] = []
    now: int | None = None
    shared: list[set[int]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        bucket, cid, label, n, sig, side = (np.concatenate(c) for c in zip(*held, strict=True))
        i, j = _some_pairs(cid, n, sig, percent, least) if first_round else _all_pairs(label, n, sig, side, percent, least)
        if not first_round:  # of all buckets that a pair shares, the least one gives it
            keep = np.array([min(shared[x] & shared[y]) == bucket[0] for x, y in zip(i.tolist(), j.tolist(), strict=True)], dtype=bool)
            i, j = i[keep], j[keep]
        partners = np.bincount(i, minlength=len(cid)) + np.bincount(j, minlength=len(cid))
        swap = (partners[i] < partners[j]) | ((partners[i] == partners[j]) & (cid[i] > cid[j]))
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(cid[i]), pa.array(cid[j]), pa.array(n[j])], names=["hub", "end", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        unit, *cols = (batch[c].to_numpy() for c in ("unit", "bucket", "cid", "label", "n", "side"))
        sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), dtype=np.uint64).reshape(len(unit), -1)
        cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1), len(unit)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if unit[s] != now:
                yield from flush()
                held, now, shared = [], unit[s], []
            held.append((*(c[s:e] for c in cols[:4]), sig[s:e], cols[4][s:e]))
            if not first_round:
                shared += map(set, batch["buckets"].slice(s, e - s).to_pylist())
    yield from flush()


def _compared(units: DataFrame, percent: int, least: int, first_round: bool) -> DataFrame:
    """hub, end, n: pairs of the rows that share a unit, the end with fewer partners there second, with its shingles."""
    stream = units.repartition("unit").sortWithinPartitions("unit", "side", "cid")
    pairs = stream.mapInArrow(lambda it: _pair_stream(it, percent, least, first_round), "hub long, end long, n long")
    return pairs.distinct() if first_round else pairs


def _first_units(members: DataFrame) -> DataFrame:
    """Chunks of the buckets in ``members`` (bucket, size, anchor, cid, n, sig). The anchor is in every chunk."""
    chunks = F.ceil(F.col("size") / FIRST)
    mine = F.array(F.pmod(F.xxhash64("cid", "bucket"), chunks))
    places = F.when((F.col("cid") == F.col("anchor")) & (chunks > 1), F.sequence(F.lit(0).cast("long"), chunks - 1)).otherwise(mine)
    dealt = members.withColumn("chunk", F.explode(places))
    return dealt.select(F.xxhash64("bucket", "chunk").alias("unit"), "bucket", "cid", F.col("cid").alias("label"), "n", F.lit(0).alias("side"), "sig")


def _second_units(members: DataFrame) -> DataFrame:
    """Every two chunks that may hold pairs of different components, from ``members`` (bucket, cid, label,
    n, sig, buckets). A component of many members in a bucket has chunks of its own; the rest are mixed."""
    per = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("m"))
    own = per.withColumn("of", F.when(F.col("m") * 4 >= CHUNK, F.col("label")).otherwise(F.lit(MIXED)))
    cut = written(own.groupBy("bucket", "of").agg(F.ceil(F.sum("m") / CHUNK).alias("chunks")), "dup-chunks")
    chunk = cut.select("bucket", "of", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("i"))
    one, two = (chunk.select("bucket", F.struct("of", "i").alias(c)) for c in ("c1", "c2"))
    tiles = one.join(two, "bucket").where((F.col("c1") <= F.col("c2")) & ((F.col("c1.of") != F.col("c2.of")) | (F.col("c1.of") == MIXED)))
    tiles = tiles.withColumn("unit", F.xxhash64("bucket", "c1", "c2"))
    at = F.explode(F.when(F.col("c1") == F.col("c2"), F.array(F.struct(F.col("c1").alias("c"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("c1").alias("c"), F.lit(0).alias("side")), F.struct(F.col("c2").alias("c"), F.lit(1).alias("side")))))
    tiles = tiles.select("bucket", "unit", at.alias("at")).select("bucket", "unit", "at.side", F.col("at.c.of").alias("of"), F.col("at.c.i").alias("i"))
    placed = members.join(own.drop("m"), ["bucket", "label"]).join(cut, ["bucket", "of"]).withColumn("i", F.pmod(F.xxhash64("cid"), F.col("chunks")))
    return placed.join(tiles, ["bucket", "of", "i"]).select("unit", "bucket", "cid", "label", "n", "side", "sig", "buckets")


def _shingle_sets(batches: Iterator[pa.RecordBatch], size: int, wanted: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.flatnonzero(in_bitmap(batch["at"].to_numpy(), wanted))
        part = batch.take(pa.array(keep))
        sets = [shingle_hashes(words_of(raw.as_py()), size).view(np.int64) for raw in part["raw"]]
        yield pa.RecordBatch.from_arrays([part["id"], pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])


def full_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """cid, shingles of the classes in ``nodes`` (cid).

    A bitmap of the candidates' hashed ids lets other texts fall away where they are read; what slips
    through falls away in the join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(nodes.select(F.xxhash64("cid"))))
    named = F.col("doc_id").try_cast("long")
    rows = docs.where(named.isNotNull()).select(named.alias("id"), F.xxhash64(named).alias("at"), utf8("text").alias("raw"))
    sets = rows.mapInArrow(lambda it: _shingle_sets(it, size, shared.value), "id long, shingles array<long>")
    return sets.join(nodes.select(F.col("cid").alias("id")), "id", "left_semi").select(F.col("id").alias("cid"), "shingles")


def _long_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in batch["shingles"])
        sigs = [packed(minima(x, LONG_FACTOR, LONG_SHIFT), 1) for x in sets]
        yield pa.RecordBatch.from_arrays([batch["cid"], pa.array(sigs, pa.binary())], names=["cid", "sig"])


def _set(value: pa.ListScalar) -> np.ndarray:
    """The shingles of one set, in order."""
    return np.sort(value.values.to_numpy(zero_copy_only=False))


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block and kind: the ends held by the block, then the others with their partners.
    An id whose rows have several texts has several sets; a pair is linked if any two of them are."""
    ends: dict[int, list[np.ndarray]] = {}
    now: int | None = None
    for batch in batches:
        a, b = [], []
        for block, kind, cid, shingles, partners in zip(batch["block"].to_pylist(), batch["kind"].to_pylist(), batch["cid"].to_pylist(), batch["shingles"], batch["partners"].to_pylist(), strict=True):
            if block != now:
                ends, now = {}, block
            own = _set(shingles)
            if kind == 0:
                ends.setdefault(cid, []).append(own)
                continue
            for other in partners:
                for two in ends[other]:
                    small, large = (own, two) if len(own) <= len(two) else (two, own)
                    at = np.searchsorted(large, small)
                    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                    if both * 100 >= (len(own) + len(two) - both) * percent:
                        a.append(min(cid, other))
                        b.append(max(cid, other))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b of the ``pairs`` (hub, end, n) whose full sets are similar enough.

    The end names the block, so a hub's pairs spread and its set goes to each block once. A task holds
    one block's ends, and one other set at a time.
    """
    small = F.sum(F.when(F.col("n") <= LARGE, F.col("n")))
    sizes = pairs.agg(F.count(F.lit(1)).alias("pairs"), small.alias("shingles")).first()
    blocks = max(1, math.ceil(sizes["pairs"] / BLOCK), math.ceil((sizes["shingles"] or 0) / HELD))  # there are no more ends than pairs
    block = F.when(F.col("n") > LARGE, F.pmod(F.xxhash64("end"), F.lit(1 << 40)) + blocks).otherwise(F.pmod(F.xxhash64("end"), F.lit(blocks)))
    turned = written(pairs.withColumn("block", block), "dup-blocks")
    none = F.lit(None).cast("array<long>")
    held = turned.select("block", F.col("end").alias("cid")).distinct().select("*", F.lit(0).alias("kind"), none.alias("partners"))
    asked = turned.groupBy("block", F.col("hub").alias("cid")).agg(F.collect_list("end").alias("partners")).select("block", "cid", F.lit(1).alias("kind"), "partners")
    stream = held.unionByName(asked).join(sets, "cid").repartition("block").sortWithinPartitions("block", "kind", "cid")
    found = stream.select("block", "kind", "cid", "shingles", "partners").mapInArrow(lambda it: _verify(it, percent), "a long, b long")
    return found.distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of the nodes in ``links`` (a, b).

    Each node hooks to its smallest neighbour, chains are flattened by pointer jumping, links are
    rewritten to the roots, and so on until no link joins two roots.
    """
    edges = written(links.where("a <> b").distinct(), "cc-edges")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("p")), "cc-up")
        while True:
            above = up.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            jumped = written(up.join(above, "p").select("node", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "cc-jump")
            moved = not jumped.where("moved").isEmpty()
            up = jumped.select("node", "p")
            if not moved:
                break
        if labels is None:
            labels = up.select("node", F.col("p").alias("component"))
        else:
            step = up.select(F.col("node").alias("component"), "p")
            labels = labels.join(step, "component", "left").select("node", F.coalesce("p", "component").alias("component"))
        labels = written(labels, "cc-labels")
        to_a, to_b = up.select(F.col("node").alias("a"), F.col("p").alias("pa")), up.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        edges = edges.join(to_a, "a").join(to_b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).where("a <> b")
        edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).where(F.lit(False))
    return labels


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """cid, bucket: the rarest shingles of each of the ``sets`` (cid, shingles), so many that two similar sets
    share one of them. An id of several texts has the prefixes of each.

    Of n shingles, n - ceil(n * percent / 100) + 1 are the prefix. Those that no other class has come
    first and join with nothing, so they only count.
    """
    whole = sets.select("cid", F.xxhash64(F.array_sort("shingles")).alias("of"), "shingles")
    each = written(whole.select("cid", "of", F.explode("shingles").alias("s")).distinct(), "dup-shingles")
    common = each.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    ordered = each.join(common, "s").groupBy("cid", "of").agg(F.array_sort(F.collect_list(F.struct("c", "s"))).alias("common"))
    n = each.groupBy("cid", "of").agg(F.count(F.lit(1)).alias("n"))
    alone = F.col("n") - F.size("common")
    least = F.floor((F.col("n") * percent + 99) / 100)
    left = F.greatest(F.lit(0), F.col("n") - least + 1 - alone).cast("int")
    first = ordered.join(n, ["cid", "of"]).select("cid", F.explode(F.slice("common", F.lit(1), left)).alias("x"))
    return first.select("cid", F.col("x.s").alias("bucket")).distinct()


def _narrowed(unsettled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The members that are ``unsettled`` (bucket, cid, n, label), those of wide buckets in buckets of rare shingles."""
    wide = written(unsettled.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > WIDE).select("bucket"), "dup-wide")
    if wide.isEmpty():
        return unsettled
    members = written(unsettled.join(wide, "bucket", "left_semi").select("cid", "n", "label").distinct(), "dup-wide-members")
    rare = written(prefixes(sets.join(members, "cid", "left_semi"), percent).join(members, "cid"), "dup-rare")
    mixed = rare.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")
    again = unsettled.join(wide, "bucket", "left_anti").unionByName(rare.join(mixed, "bucket", "left_semi"))
    return written(again, "dup-narrowed")


def link_classes(docs: DataFrame, classes: DataFrame, size: int, percent: int, joined: DataFrame | None = None, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(links, components) between classes (cid, n, sig, bands). ``joined``: links (a, b) from the start."""
    spread = prefixes(full_sets(docs, classes.select("cid").distinct(), size), percent) if exact else classes.select("cid", F.explode("bands").alias("bucket"))
    crowded = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min_by("cid", F.xxhash64("cid", "bucket")).alias("anchor")).where("size > 1")
    members = spread.join(crowded, "bucket").join(classes.select("cid", "n", "sig"), "cid")
    members = written(members.select("bucket", F.col("size").cast("int").alias("size"), "anchor", "cid", "n", "sig"), "dup-members")
    least = 0 if exact else least_matches(percent)
    pairs = written(_compared(_first_units(members), percent, least, True), "dup-pairs")
    # whoever has any partner in a chunk is in a pair now; those who had none there may have one in another chunk
    nodes = pairs.select(F.col("hub").alias("cid")).union(pairs.select(F.col("end").alias("cid"))).union(members.where(F.col("size") > FIRST).select("cid")).distinct()
    sets = written(full_sets(docs, nodes, size), "dup-sets")
    links = written(confirmed(pairs, sets, percent), "dup-links")
    if joined is not None:
        links = links.unionByName(joined)
    labels = components(links)
    label = labels.select(F.col("node").alias("cid"), F.col("component").alias("label"))
    there = members.where(F.col("size") > PARTNERS + 1).select("bucket", "cid", "n").join(nodes, "cid", "left_semi")
    named = written(there.join(label, "cid", "left").withColumn("label", F.coalesce("label", "cid")), "dup-open")
    mixed = named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")
    unsettled = written(named.join(mixed, "bucket", "left_semi"), "dup-mixed")
    if unsettled.isEmpty():
        return links, labels
    unsettled = _narrowed(unsettled, sets, percent)
    long = sets.join(unsettled.select("cid").distinct(), "cid", "left_semi").mapInArrow(_long_signatures, "cid long, sig binary")
    shared = unsettled.groupBy("cid").agg(F.collect_set("bucket").alias("buckets"))  # as many as bands, or as the prefix is long
    long = written(long.join(shared, "cid"), "dup-long")
    least = 0 if exact else least_matches(percent, LONG, 1)
    more = written(_compared(_second_units(unsettled.join(long, "cid")), percent, least, False), "dup-pairs")
    found = written(confirmed(more, sets, percent), "dup-links")
    if found.isEmpty():
        return links, labels
    links = links.unionByName(found)
    return links, components(links)


def groups(docs: DataFrame, size: int, percent: int = 80, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document. ``exact``: no link is left to chance."""
    rows = written(sketches(docs, size), "dup-sketch")
    real = rows.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    classes = real.groupBy("digest").agg(F.min("id").alias("cid"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes, "dup-classes")
    own = real.select("digest", "id", "n", "sig", "bands")
    single = own.join(classes, (own["digest"] == classes["digest"]) & (own["id"] == classes["cid"])).select("cid", "n", "sig", "bands")
    single = single.dropDuplicates(["cid", "sig"])
    shared = real.groupBy("id").agg(F.min(F.xxhash64("digest")).alias("lo"), F.max(F.xxhash64("digest")).alias("hi")).where("lo <> hi").select("id")
    shared = written(shared, "dup-shared-ids")
    joined = None
    if not shared.isEmpty():  # an id with several texts joins their classes
        joined = real.join(shared, "id", "left_semi").join(classes, "digest").select(F.col("id").alias("a"), F.col("cid").alias("b")).distinct()
    _, labels = link_classes(docs, single, size, percent, joined, exact)
    named = classes.join(labels, classes["cid"] == labels["node"], "left").select("digest", "copies", F.coalesce("component", "cid").alias("component_id"))
    return _named(rows, written(named, "dup-named"))


#: A class with at least this share of all rows is joined apart; there are at most its inverse many.
HOT = 0.001


def _named(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Give every row its class's component. Classes of many copies, of which the share bounds the
    number, go by broadcast, so that their rows need not meet in one task."""
    total = rows.count()
    bound = max(100, math.ceil(total * HOT))
    hot = F.broadcast(named.where(F.col("copies") >= bound).select(F.col("digest").alias("hot"), F.col("component_id").alias("hot_id")))
    marked = rows.select("id", "n", "digest").join(hot, F.col("digest") == F.col("hot"), "left").drop("hot")
    cold = named.where(F.col("copies") < bound).select(F.col("digest").alias("cold"), F.col("component_id").alias("cold_id"))
    key = F.when(F.col("hot_id").isNull() & F.col("id").isNotNull() & F.col("digest").isNotNull(), F.col("digest")).otherwise(F.encode(F.concat(F.lit("-"), F.coalesce(F.col("id"), F.lit(0))), "UTF-8"))
    joined = marked.withColumn("key", key).join(cold, F.col("key") == F.col("cold"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("hot_id", "cold_id", "id"))
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id")
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, exact: bool = False) -> DataFrame:
    """The documents without those of a group other than the group's smallest id; all columns kept.

    Rows that repeat the kept id are all kept, as are rows with a null id.
    """
    gone = groups(docs, size, percent, exact).where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    gone = written(gone, "dup-gone")
    return docs.join(gone, docs["doc_id"].try_cast("long") == gone["gone"], "left_anti")
