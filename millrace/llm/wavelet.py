"""Token ids of a corpus in shards, each one compressed file: a wavelet matrix with rank and select.

Documents stand in ascending order of id and are dealt by range; a task encodes its texts in turn, appends the end id
to each, and closes a shard whenever enough ids are held. The first id of every document is known from the shards
before it, so no count of all ids passes through one place.

A shard's ids are numbered by rank among the distinct ids that it holds, which takes as few bits as possible. The matrix has a
plane for each bit, highest first: the plane holds that bit of all ids in their present order, and the order for the next plane has
those with a 0 before those with a 1. A plane is cut into blocks, compressed one by one, with the number of ones
before each. Reading one id, counting an id up to a place (rank) and finding its n-th place (select) touch one or two blocks a
plane; ``decode`` gives all ids back, from the last plane up. The file ends with a directory of blocks, the documents and
a checksum of the directory; every block has a checksum as well. A file is written under a name of its
attempt, and the rows that the task returns name the files that count, so repeated tasks neither replace nor mix files.

The library encodes: a text as a whole if it holds characters on which Python and the library could differ, else each of the
tokenizer's pieces that a worker's memo doesn't hold: no token crosses the ends of a piece. Where the tokenizer file cuts texts by
kinds of characters (``BY_KIND``), a group of texts is cut as an array of code points, Arrow numbers the distinct pieces, and
only these are looked up. With another pattern, Arrow cuts at white space and the pattern cuts the distinct runs. A memo is
bounded and keeps what it meets most often.

Null and odd cases: a null text is empty and has the end id alone; special strings inside a text are handled as
the library does by default; a null id comes before all others; rows that share an id stand by a checksum of their
text, and equal rows are rows of their own, whose order among themselves shows nowhere; a hot id is dealt over ranges by that
checksum and by place of the row in its file; a text of any length stays in one shard, which may then be larger; an empty table
writes no file; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import scratch, utf8, written
from millrace.llm.tokens import LONG_CHUNK, UNSURE, byte_symbols
from millrace.llm.warc import _filesystem

MAGIC = b"WVLT0001"
#: Ids in a shard, about; places in a block of a plane (a multiple of 8).
SHARD_IDS, BLOCK = 1 << 24, 1 << 18
#: Documents in a range, about.
RANGE_ROWS = 200_000
#: Pieces in a worker's memo (some 120 MB when full); the memo of chunks, which cost less to learn and which cutting by kind
#: leaves empty, holds half as many.
MEMO = 800_000
#: Bytes of text encoded together, about, and new pieces that go to the library as one text.
TOGETHER, JOINED = 4 << 20, 1000
#: Normalizer and pre-tokenizer of a tokenizer file that folds case and cuts texts by kinds of characters, but for the contractions.
BY_KIND = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
#: Characters cut together, about.
CUT = 1 << 18
SHARD = "part long, seq long, name string, n_docs long, n_ids long"
DOC = "part long, seq long, place long, doc_id long, offset long, n_tokens long, ids binary"


class WaveletError(ValueError):
    """A file that doesn't follow the format, or whose checksums don't hold."""


# ---- the matrix


def planes_of(values: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of each plane, highest first."""
    for b in range(bits - 1, -1, -1):
        ones = (values & values.dtype.type(1 << b)) != 0
        yield ones
        if b:
            after = np.empty_like(values)
            for here, at, to in _moves(ones):
                after[to] = values[here][at]
            values = after


def _moves(ones: np.ndarray) -> Iterator[tuple[slice, np.ndarray, slice]]:
    """How a plane reorders: block by block, the places of its zeros and of its ones within the block, and where these go. Places
    are several times as fast as masks where bits alternate, and those of one block stay in the cache."""
    ends = [0, len(ones) - int(np.count_nonzero(ones))]
    for start in range(0, len(ones), BLOCK):
        here = slice(start, start + BLOCK)
        for bit in (0, 1):
            at = np.flatnonzero(ones[here] if bit else ~ones[here])
            yield here, at, slice(ends[bit], ends[bit] + len(at))
            ends[bit] += len(at)


def restored(planes: Iterator[np.ndarray], n: int, kind: np.dtype) -> np.ndarray:
    """All n values from their planes, lowest first: each plane undoes its own reordering. One plane is held at a time."""
    values = np.zeros(n, dtype=kind)
    for b, ones in enumerate(planes):
        before = np.empty_like(values)
        for here, at, to in _moves(ones):
            before[here][at] = values[to]
        before |= ones.astype(kind) << kind.type(b)
        values = before
    return values


def shard_bytes(doc_ids: Sequence[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: compressed blocks of all planes, then the directory, its length and checksum."""
    present = np.bincount(ids) if len(ids) else np.zeros(0, dtype=np.int64)
    alphabet = np.flatnonzero(present)
    number = np.zeros(len(present), dtype=np.uint32)
    number[alphabet] = np.arange(len(alphabet))
    bits = max(1, (len(alphabet) - 1).bit_length()) if len(ids) else 0
    values = number[ids].astype(np.uint16 if bits <= 16 else np.uint32)
    out, at, blocks, zeros = [MAGIC], len(MAGIC), [], []
    for ones in planes_of(values, bits):
        before, mine = 0, []
        for start in range(0, len(ones), BLOCK):
            piece = ones[start : start + BLOCK]
            packed = zlib.compress(np.packbits(piece).tobytes(), 1)
            mine.append((at, len(packed), zlib.crc32(packed), before))
            before += int(np.count_nonzero(piece))
            at += len(packed)
            out.append(packed)
        blocks.append(mine)
        zeros.append(len(ones) - before)
    head = {"n": len(ids), "bits": bits, "block": BLOCK, "alphabet": alphabet.tolist(), "zeros": zeros, "blocks": blocks, "docs": list(doc_ids), "lengths": lengths.tolist()}
    packed = zlib.compress(json.dumps(head, separators=(",", ":")).encode(), 6)
    return b"".join([*out, packed, len(packed).to_bytes(8, "little"), zlib.crc32(packed).to_bytes(4, "little"), MAGIC])


class Shard:
    """A shard read in place: ``read(at, n)`` gives bytes of the file, of which only the blocks asked for are read."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        tail = read(size - 20, 20) if size >= 20 + len(MAGIC) else b""
        if tail[12:] != MAGIC or read(0, len(MAGIC)) != MAGIC:
            raise WaveletError("no shard of token ids")
        n = int.from_bytes(tail[:8], "little")
        packed = read(size - 20 - n, n)
        if zlib.crc32(packed) != int.from_bytes(tail[8:12], "little"):
            raise WaveletError("the directory's checksum doesn't hold")
        head = json.loads(zlib.decompress(packed))
        self.read, self.n, self.bits, self.block = read, head["n"], head["bits"], head["block"]
        self.alphabet, self.zeros, self.blocks = np.array(head["alphabet"], dtype=np.int64), head["zeros"], head["blocks"]
        self.docs, self.lengths = head["docs"], np.array(head["lengths"], dtype=np.int64)
        self.starts = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(self.lengths)))
        self._piece = functools.lru_cache(maxsize=256)(self._load)

    def _load(self, plane: int, block: int) -> np.ndarray:
        at, size, crc, _ = self.blocks[plane][block]
        packed = self.read(at, size)
        if zlib.crc32(packed) != crc:
            raise WaveletError("a block's checksum doesn't hold")
        return np.frombuffer(zlib.decompress(packed), dtype=np.uint8)

    def _ones(self, plane: int, i: int) -> int:
        """Ones before place i of a plane."""
        if i >= self.n:
            return self.n - self.zeros[plane]
        block, within = divmod(i, self.block)
        packed = self._piece(plane, block)
        full, rest = divmod(within, 8)
        ones = int(np.bitwise_count(packed[:full]).sum())
        return self.blocks[plane][block][3] + ones + (int(packed[full] >> (8 - rest)).bit_count() if rest else 0)

    def _bit(self, plane: int, i: int) -> int:
        block, within = divmod(i, self.block)
        return int(self._piece(plane, block)[within >> 3] >> (7 - (within & 7))) & 1

    def _place(self, plane: int, bit: int, n: int) -> int:
        """The place of the n-th one (or zero) of a plane, from 0."""
        held = [b[3] if bit else k * self.block - b[3] for k, b in enumerate(self.blocks[plane])]
        block = int(np.searchsorted(held, n, side="right")) - 1
        width = min(self.block, self.n - block * self.block)
        found = np.flatnonzero(np.unpackbits(self._piece(plane, block), count=width) == bit)
        return block * self.block + int(found[n - held[block]])

    def _number(self, token: int) -> int | None:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p in range(self.bits):
            bit, ones = self._bit(p, i), self._ones(p, i)
            value = value << 1 | bit
            i = self.zeros[p] + ones if bit else i - ones
        return int(self.alphabet[value])

    def _run(self, number: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of a value among places lo to hi stand below the last plane."""
        for p in range(self.bits):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if number >> (self.bits - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """How often an id stands before place i."""
        number = self._number(token)
        if number is None:
            return 0
        lo, hi = self._run(number, 0, min(max(i, 0), self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, n: int) -> int:
        """The place of the n-th occurrence of an id, from 0."""
        number = self._number(token)
        if number is None or not 0 <= n < self.count(token):
            raise IndexError(n)
        i = self._run(number, 0, 0)[0] + n
        for p in range(self.bits - 1, -1, -1):
            bit = number >> (self.bits - 1 - p) & 1
            i = self._place(p, bit, i - self.zeros[p] if bit else i)
        return i

    def places(self, token: int) -> Iterator[int]:
        """All places of an id, ascending."""
        return (self.select(token, n) for n in range(self.count(token)))

    def document_at(self, i: int) -> tuple[int | None, int]:
        """(id of the document that holds place i, place within it)."""
        k = int(np.searchsorted(self.starts, i, side="right")) - 1
        return self.docs[k], i - int(self.starts[k])

    def decode(self) -> np.ndarray:
        """All ids."""
        if not self.bits:
            return np.zeros(0, dtype=np.uint32)
        blocks = ([self._load(p, b) for b in range(len(self.blocks[p]))] for p in reversed(range(self.bits)))
        planes = (np.unpackbits(np.concatenate(x), count=self.n).view(bool) for x in blocks)
        return self.alphabet.astype(np.uint32)[restored(planes, self.n, np.dtype(np.uint16 if self.bits <= 16 else np.uint32))]


# ---- encoding


def _gathered(pool: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``pool[ends[k] : ends[k + 1]]`` for each k in ``at``, one after another, and the ends of each among them."""
    starts = ends[at]
    lengths = ends[at + 1] - starts
    upto = np.cumsum(lengths)
    return pool[np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(starts - upto + lengths, lengths)], upto


SPACE, LETTER, DIGIT, SIGN = range(4)


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of each code point that sure characters or their small letters have."""
    kinds = {"L": LETTER, "N": DIGIT}
    return np.array([SPACE if chr(c).isspace() else kinds.get(unicodedata.category(chr(c))[0], SIGN) for c in range(0x3000)], dtype=np.uint8)


def _cut(text: str) -> tuple[pa.Array, np.ndarray]:
    """The pieces of a text that ends in white space, and the places where they begin."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kinds = _kinds()[points]
    starts = kinds == DIGIT
    starts[0] = True
    starts[1:] |= kinds[1:] != kinds[:-1]
    # an apostrophe that begins a piece takes the letters of a contraction, which end before the last place
    at = np.flatnonzero(starts & (points == ord("'")))
    one, two = points[at + 1], points[np.minimum(at + 2, len(points) - 1)]
    taken = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
    taken[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))] = 2
    at, taken = at[taken > 0], taken[taken > 0]
    starts[at + 1] = False
    starts[at + 1 + taken] = True
    inside = kinds != SPACE
    kept, begins = points[inside], np.flatnonzero(starts[inside])
    more = (kept >= 0x80).view(np.uint8) + (kept >= 0x800).view(np.uint8)  # bytes beyond the first
    data = kept.tobytes().decode("utf-32-le").encode()
    offsets = np.append(begins + np.cumsum(more, dtype=np.int64)[begins] - more[begins], len(data))
    return pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(data)), np.flatnonzero(starts & inside)


def pieces_by_kind(texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
    """The pieces of small-letter texts of sure characters, as the pattern of ``BY_KIND`` cuts them, and how many each text has.
    The texts are met in blocks that end in white space, so that arrays of code points stay small however long a text is."""
    text = "".join([t + "\n" for t in texts])
    pieces, places, at = [], [], 0
    while at < len(text):
        end = max(text.rfind(" ", at, at + CUT), text.rfind("\n", at, at + CUT)) + 1 or re.compile("[ \n]").search(text, at).end()
        some, begins = _cut(text[at:end])
        pieces.append(some)
        places.append(begins + at)
        at = end
    upto = np.searchsorted(np.concatenate(places), np.cumsum([len(t) + 1 for t in texts]))
    return pa.concat_arrays(pieces), np.diff(upto, prepend=0)


class Memo:
    """The ids of strings: a number for each string, the ids of number k at ``pool[ends[k] : ends[k + 1]]``, and how often
    it was met."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], share: int = 1):
        self.learn, self.at, self.share = learn, {}, share
        self.pool, self.ends, self.uses, self.known = np.zeros(1 << 16, dtype=np.uint16), np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64), 0

    def _add(self, new: list[str]) -> None:
        """Learn strings; the pool grows by doubling."""
        ids, lengths = self.learn(new)
        used, k = int(self.ends[self.known]), self.known + len(new)
        end = used + len(ids)
        kind = np.uint32 if len(ids) and int(ids.max()) >= 1 << 16 else self.pool.dtype
        if end > len(self.pool) or kind != self.pool.dtype:
            self.pool = np.concatenate((self.pool[:used], np.zeros(max(end, 2 * used) - used, dtype=kind)), dtype=kind)
        if k >= len(self.ends):
            more = np.zeros(max(k + 1, 2 * len(self.ends)) - len(self.ends), dtype=np.int64)
            self.ends, self.uses = np.concatenate((self.ends, more)), np.concatenate((self.uses, more))
        self.pool[used:end] = ids
        self.ends[self.known + 1 : k + 1] = used + np.cumsum(lengths)
        self.at.update(zip(new, range(self.known, k), strict=True))
        self.known = k

    def _forget(self) -> None:
        """Keep the strings met most often, half of the memo at most."""
        uses = self.uses[: self.known]
        kept = np.sort(np.argsort(-uses, kind="stable")[: min(MEMO // self.share // 2, int((uses > 1).sum()))])
        number = np.full(self.known, -1)
        number[kept] = np.arange(len(kept))
        self.pool, upto = _gathered(self.pool, self.ends, kept)
        self.ends = np.concatenate((np.zeros(1, dtype=np.int64), upto, np.zeros(1, dtype=np.int64)))
        self.uses = np.concatenate((uses[kept] // 2, np.zeros(2, dtype=np.int64)))
        self.known = len(kept)
        self.at = {c: k for c, i in self.at.items() if (k := int(number[i])) >= 0}

    def numbers(self, strings: list[str]) -> np.ndarray:
        """The number of each string, which holds until the next call."""
        if self.known > MEMO // self.share:
            self._forget()
        at = np.fromiter(map(self.at.get, strings, itertools.repeat(-1)), dtype=np.int64, count=len(strings))
        missed = np.flatnonzero(at < 0)
        if len(missed):
            asked = [strings[i] for i in missed.tolist()]
            new = list(dict.fromkeys(asked))
            self._add(new)
            at[missed] = np.fromiter(map(self.at.__getitem__, asked), dtype=np.int64, count=len(asked))
            for c in [c for c in new if len(c) > LONG_CHUNK]:  # not remembered
                del self.at[c]
        return at

    def ids(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the strings of these numbers, which stand in groups of so many, and where each group ends among them."""
        self.uses[: self.known] += np.bincount(at, minlength=self.known)
        every, upto = _gathered(self.pool, self.ends, at)
        return every, np.concatenate((np.zeros(1, dtype=np.int64), upto))[np.cumsum(counts)]


class Encoder:
    """Token ids as the tokenizer file's library gives them, without begin, end or added special tokens. The pieces that the
    tokenizer cuts texts into are remembered, and where it doesn't cut them by kind, chunks without white space as well; the
    library gets new pieces."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel part; threads of each would only wait for cores
        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special, self.mark = re.compile("|".join(map(re.escape, specials)), re.IGNORECASE), os.path.commonprefix(specials)
        self.specials, self.cased = bool(specials), self.mark.lower() != self.mark.upper()
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + r"|\n").findall
        end, vocabulary = spec["model"].get("end_of_word_suffix") or "", spec["model"]["vocab"]
        #: Which ids end a piece.
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_piece[[i for t, i in vocabulary.items() if end and t.endswith(end)]] = True
        self.pieces, self.chunks = Memo(self._pieces), Memo(self._chunks, 2)
        self.by_kind = (spec["normalizer"], spec["pre_tokenizer"]) == BY_KIND
        if self.by_kind:  # the same model for pieces in small letters and as symbols of bytes already, which are only to be merged
            self.merging = Tokenizer(self.library.model)
            self.merging.pre_tokenizer = WhitespaceSplit()
            self.symbols = {i: c for i, c in enumerate(byte_symbols()) if i != ord(" ")}

    def _library(self, texts: list[str], library=None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each has."""
        ids = [e.ids for e in (library or self.library).encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), dtype=np.uint32, count=int(lengths.sum())), lengths

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces. Many go to the library as one text, and the ids that end a piece tell where; if these aren't as
        many as the pieces, each goes alone."""
        joined = [" ".join(pieces[i : i + JOINED]) for i in range(0, len(pieces), JOINED)]
        ids, _ = self._library([t.encode().decode("latin-1").translate(self.symbols) for t in joined], self.merging) if self.by_kind else self._library(joined)
        stops = np.flatnonzero(self.ends_piece[ids]) + 1
        return (ids, np.diff(stops, prepend=0)) if len(stops) == len(pieces) and stops[-1] == len(ids) else self._library(pieces)

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks, which are cut as lines of one text."""
        pieces = self.cut("\n".join(chunks))
        counts = np.diff(np.array([i for i, p in enumerate(pieces) if p == "\n"] + [len(pieces)], dtype=np.int64), prepend=-1) - 1
        ids, upto = self.pieces.ids(self.pieces.numbers([p for p in pieces if p != "\n"]), counts)
        return ids, np.diff(upto, prepend=0)

    def _unsure(self, text: str) -> bool:
        """Whether the library is to see the text as a whole."""
        return bool(UNSURE.search(text) or (self.specials and (self.mark in text or (self.cased and self.mark.lower() in text.lower())) and self.special.search(text)))

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts of sure characters, and where each text ends among them."""
        if self.by_kind:
            pieces, counts = pieces_by_kind([t.lower() for t in texts])
            coded = pieces.dictionary_encode()
            return self.pieces.ids(self.pieces.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()], counts)
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))  # sure characters have no other white space
        coded = words.flatten().dictionary_encode()
        numbers = self.chunks.numbers("\n".join(coded.dictionary.to_numpy(zero_copy_only=False)).lower().split("\n") if len(coded) else [])
        return self.chunks.ids(numbers[coded.indices.to_numpy()], np.diff(words.offsets.to_numpy()))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Texts are met in groups, so that pieces are looked up once and new ones go to the library together."""
        out: list[np.ndarray | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if self._unsure(t)]
        if whole:
            ids, lengths = self._library([texts[i] for i in whole])
            for i, part in zip(whole, np.split(ids, np.cumsum(lengths)[:-1]), strict=True):
                out[i] = part
        plain = [i for i in range(len(texts)) if out[i] is None]
        if plain:
            every, upto = self._plain([texts[i] for i in plain])
            for i, part in zip(plain, np.split(every.astype(np.uint32), upto[:-1]), strict=True):
                out[i] = part
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# ---- shards by Spark


def _write(batches: Iterator[pa.RecordBatch], uri: str, tokenizer: str, end_id: int, shard_ids: int) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    context = TaskContext.get()
    code = encoder(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
    fs, folder = _filesystem(uri)
    docs: list[int | None] = []
    parts: list[np.ndarray] = []
    held, seq, done = 0, 0, []

    def close() -> None:
        nonlocal held, seq
        name = f"ids-{context.partitionId():06d}-{seq:04d}-{context.taskAttemptId()}.wvlt"
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            out.write(shard_bytes(docs, lengths, np.concatenate(parts)))
        done.append((context.partitionId(), seq, name, len(docs), held))
        docs.clear()
        parts.clear()
        held, seq = 0, seq + 1

    for batch in batches:
        upto = np.cumsum(pc.binary_length(batch["raw"]).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(upto // TOGETHER)) + 1).tolist(), batch.num_rows]
        for start, end in itertools.pairwise(cuts):
            piece = batch.slice(start, end - start)
            texts = [t.as_py().decode("utf-8", "replace") for t in piece["raw"]]
            for doc_id, ids in zip(piece["doc_id"].to_pylist(), code.encode(texts), strict=True):
                if parts and held + len(ids) + 1 > shard_ids:
                    close()
                docs.append(doc_id)
                parts.append(np.append(ids, np.uint32(end_id)).astype(np.uint32))
                held += len(ids) + 1
    if parts:
        close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[x.split()[0] for x in SHARD.split(", ")])


def write_shards(docs: DataFrame, uri: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write all documents below ``uri``; part, seq (the shards' order), name, n_docs, n_ids and first (ids before) of each shard."""
    spark = docs.sparkSession
    fs, folder = _filesystem(uri)
    fs.create_dir(folder, recursive=True)
    rows = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), utf8("text").alias("raw"), F.monotonically_increasing_id().alias("at"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(docs.count() / RANGE_ROWS))
    order = [F.col("doc_id").asc_nulls_first(), F.col("sum").asc(), F.col("at").asc()]
    ranged = rows.withColumn("sum", F.crc32("raw")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    shards = written(ranged.select("doc_id", "raw").mapInArrow(lambda it: _write(it, uri, tokenizer, end_id, shard_ids), SHARD), "wavelet-shards")
    # ids before a part, from one row a part, and before a shard within its part
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts_first = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", before.alias("ahead"))
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return written(shards.withColumn("within", within).join(parts_first, "part").withColumn("first", F.col("ahead") + F.col("within")).drop("ahead", "within"), "wavelet-manifest")


def _open(fs, path: str) -> tuple[Shard, object]:
    f = fs.open_input_file(path)
    return Shard(lambda at, n: f.read_at(n, at), f.size()), f


def _shards(batches: Iterator[pa.RecordBatch], uri: str) -> Iterator[tuple[int, int, Shard]]:
    fs, folder = _filesystem(uri)
    for batch in batches:
        for part, seq, name in zip(*(batch[c].to_pylist() for c in ("part", "seq", "name")), strict=True):
            shard, f = _open(fs, f"{folder}/{name}")
            try:
                yield part, seq, shard
            finally:
                f.close()


def _packed(rows: list[tuple], spec: str) -> pa.RecordBatch:
    made = {"long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in spec.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, made[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


def _read(batches: Iterator[pa.RecordBatch], uri: str, digest: bool) -> Iterator[pa.RecordBatch]:
    spec = DOC.replace("ids binary", "ids_crc32 long") if digest else DOC
    for part, seq, shard in _shards(batches, uri):
        ids = shard.decode().astype("<u4", copy=False)
        rows = (
            (part, seq, i, d, int(a), int(b - a), zlib.crc32(ids[a:b]) if digest else ids[a:b].tobytes())
            for i, (d, a, b) in enumerate(zip(shard.docs, shard.starts[:-1].tolist(), shard.starts[1:].tolist(), strict=True))
        )
        while some := list(itertools.islice(rows, 4096 if digest else 256)):
            yield _packed(some, spec)


def _spread(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """The shards, dealt out evenly: a shard is a task's unit of work."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards.count())
    return shards.repartition(parts, F.xxhash64("name")).select("part", "seq", "name")


def read_shards(shards: DataFrame, uri: str, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian, four bytes each) of every document in the shards of ``write_shards``;
    with ``digest``, ids_crc32 for ids."""
    spec = DOC.replace("ids binary", "ids_crc32 long") if digest else DOC
    docs = _spread(shards.sparkSession, shards).mapInArrow(lambda it: _read(it, uri, digest), spec)
    firsts = shards.select("part", "seq", "first")
    placed = docs.join(F.broadcast(firsts), ["part", "seq"]) if shards.count() <= BROADCAST_SHARDS else docs.join(firsts, ["part", "seq"])
    return placed.select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32" if digest else "ids")


#: Shards up to which their first places are broadcast, a few MB.
BROADCAST_SHARDS = 100_000


def _count(batches: Iterator[pa.RecordBatch], uri: str, tokens: Sequence[int]) -> Iterator[pa.RecordBatch]:
    for part, seq, shard in _shards(batches, uri):
        yield _packed([(part, seq, t, n) for t in tokens if (n := shard.count(t))] or [(part, seq, -1, 0)], "part long, seq long, token long, n long")


def count_ids(shards: DataFrame, uri: str, tokens: Sequence[int]) -> DataFrame:
    """token, n: how often each of the tokens stands in all shards, from rank alone."""
    own = _spread(shards.sparkSession, shards).mapInArrow(lambda it: _count(it, uri, tokens), "part long, seq long, token long, n long")
    return own.where("n > 0").groupBy("token").agg(F.sum("n").alias("n"))


def _find(batches: Iterator[pa.RecordBatch], uri: str, tokens: Sequence[int]) -> Iterator[pa.RecordBatch]:
    spec = "token long, doc_id long, place long"
    for _, _, shard in _shards(batches, uri):
        rows = ((t, *shard.document_at(i)) for t in tokens for i in shard.places(t))
        while some := list(itertools.islice(rows, 4096)):
            yield _packed(some, spec)


def find_ids(shards: DataFrame, uri: str, tokens: Sequence[int]) -> DataFrame:
    """token, doc_id, place within the document of every occurrence, by select."""
    return _spread(shards.sparkSession, shards).mapInArrow(lambda it: _find(it, uri, tokens), "token long, doc_id long, place long")


def round_trip(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, shard_ids: int = SHARD_IDS) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from files in the shared folder."""
    uri = scratch(docs.sparkSession, "wavelet")
    return read_shards(write_shards(docs, uri, tokenizer, end_id, shard_ids), uri, digest=True)
