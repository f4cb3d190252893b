"""Token counts by byte-pair merging with a heap and a linked list.

A piece of text starts as one symbol a byte. A heap holds every adjacent pair that has a merge,
lowest rank first and leftmost among equals; popping a pair whose symbols have changed since is
skipped; merging relinks the neighbours and pushes the two new pairs. The count is the number
of initial symbols less the merges: no identifiers are made.

White space never lies inside a piece, so a text is the sum of its space-separated chunks and
equal chunks count once per worker (the memo is bounded). Texts with characters for which
Python's Unicode tables might differ from the tokenizer library's are normalized and cut by the
library itself, all others by the same rules here.

Null and odd cases: a null text counts as empty, 0 bytes and 0 tokens; special strings inside a
text are one token each, as the library has it by default; very long texts and very long chunks
take time n log n and memory in proportion; repeated rows and null ids pass through; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import utf8

#: Entries of a worker's memo of chunks, and of pieces.
MEMO = 400_000
#: Chunks longer than this are counted without being remembered.
LONG_CHUNK = 64
#: Characters on which Python and the tokenizer library agree: ASCII text, Latin letters, common punctuation.
UNSURE = re.compile("[^\t-\r -~\xa1-\xac\xae-ɏ‐-‧€]")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code point from 256 on."""
    table, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            table.append(chr(b))
        else:
            table.append(chr(spare))
            spare += 1
    return table


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols stay after all merges."""
    n = len(symbols)
    if n < 2:
        return n
    sym: list[str | None] = list(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j >= n or sym[i] != a or sym[j] != b:
            continue
        merged = a + b
        sym[i], sym[j] = merged, None
        k = after[i] = after[j]
        left -= 1
        if k < n:
            before[k] = i
            if (r := ranks.get((merged, sym[k]))) is not None:
                heapq.heappush(heap, (r, i, merged, sym[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get((sym[h], merged))) is not None:
            heapq.heappush(heap, (r, h, sym[h], merged))
    return left


class TokenCounter:
    """Counts tokens as the tokenizer file's library does, without encoding anything."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.ranks = {pair: i for i, pair in enumerate(pairs)}
        self.end = model.get("end_of_word_suffix") or ""
        self.bytes = byte_symbols()
        self.library = Tokenizer.from_file(path)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split).findall
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self.by_chunk: dict[str, int] = {}
        self.by_piece: dict[str, int] = {}

    def piece(self, symbols: list[str]) -> int:
        symbols[-1] += self.end
        return merge_count(symbols, self.ranks)

    def chunk(self, chunk: str) -> int:
        """A chunk without white space, lower case, of sure characters."""
        total = 0
        for p in self.pieces(chunk):
            n = self.by_piece.get(p)
            if n is None:
                n = self.piece([self.bytes[b] for b in p.encode()])
                if len(p) <= LONG_CHUNK:
                    if len(self.by_piece) >= MEMO:
                        self.by_piece.clear()
                    self.by_piece[p] = n
            total += n
        return total

    def plain(self, text: str) -> int:
        """A text that holds no special string."""
        if UNSURE.search(text):
            return sum(self.piece(list(p)) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text)) if p)
        memo, total = self.by_chunk, 0
        for c in text.lower().split():
            n = memo.get(c)
            if n is None:
                n = self.chunk(c)
                if len(c) <= LONG_CHUNK:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[c] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return sum(1 if i % 2 else self.plain(part) for i, part in enumerate(self.special.split(text)) if part)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def _count_batches(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    c = counter(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
    for batch in batches:
        tokens = pa.array([c.count(t.as_py().decode("utf-8", "replace")) for t in batch["raw"]], pa.int64())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], tokens], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document. ``tokenizer``: a path, or a name among the public ones."""
    raw = docs.select("doc_id", utf8("text").alias("raw"))
    narrow = raw.select("doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), "raw")
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return narrow.mapInArrow(lambda it: _count_batches(it, tokenizer), schema).withColumn("over_limit", F.col("n_tokens") > limit)
