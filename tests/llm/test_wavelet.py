import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import queries, wavelet

NAME = "word_bpe_49k.json"
TEXTS = [None, "", " \n", "hello world", "x" * 5000, "<|endoftext|>", "a<|startoftext|>B <|ENDOFTEXT|>", "only <|ENDOFTEXT|> in capitals", "İ ΣΑΣ ß é é", "'S 're 12²½ don't", "日本語 😀", "\x1c\x85\xa0  ​", "word " * 50_000, "Naïve café — “quoted”"]


def library(texts):
    t = Tokenizer.from_file(public_tokenizers.path(NAME))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def brute(rows):
    """[(doc_id, text)] -> sorted (doc_id, start, n_tokens, crc)"""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))):
        ids = np.array([*library([text])[0], 1], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=str)


def opened(data):
    return wavelet.Shard(lambda at, n: data[at : at + n], len(data))


@pytest.mark.parametrize(("n", "distinct"), [(0, 1), (1, 1), (9, 1), (1000, 2), (5000, 37), (3000, 70_000), (4096, 65_536)])
def test_matrix_against_arrays(n, distinct, monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK", 256)
    rnd = np.random.default_rng(n)
    ids = rnd.integers(0, distinct, n).astype(np.uint32) * 3 + 5
    cuts = np.sort(rnd.integers(0, n + 1, 6))
    lengths = np.diff(np.concatenate(([0], cuts, [n])))
    shard = opened(wavelet.shard_bytes([None, 3, 3, 4, 5, 6, 9], lengths, ids))
    assert shard.decode().tolist() == ids.tolist() and shard.docs == [None, 3, 3, 4, 5, 6, 9] and shard.lengths.tolist() == lengths.tolist()
    for i in range(0, n, 97):
        assert shard.access(i) == ids[i]
        assert shard.rank(int(ids[i]), i) == int((ids[:i] == ids[i]).sum())
        doc, place = shard.document_at(i)
        k = int(np.searchsorted(np.cumsum(lengths), i, side="right"))
        assert (doc, place) == (shard.docs[k], i - int(lengths[:k].sum()))
    for token in {int(x) for x in ids[:20]}:
        assert list(shard.places(token)) == np.flatnonzero(ids == token).tolist()
    assert shard.count(4) == 0 and shard.count(10**9) == 0
    with pytest.raises(IndexError):
        shard.access(n)
    with pytest.raises(IndexError):
        shard.select(4, 0)


def test_few_blocks_are_read():
    ids = np.random.default_rng(1).integers(0, 1000, 2_000_000).astype(np.uint32)
    data, seen = wavelet.shard_bytes([1], np.array([len(ids)]), ids), []
    shard = wavelet.Shard(lambda at, n: seen.append(n) or data[at : at + n], len(data))
    seen.clear()
    assert shard.access(1_234_567) == ids[1_234_567] and len(seen) == 10  # one block a plane
    assert len(data) < len(ids) * 10 / 8 * 1.05


def test_damage_is_noticed():
    data = wavelet.shard_bytes([1], np.array([3000]), np.arange(3000, dtype=np.uint32))
    for at in (20, len(data) - 40, len(data) - 10, len(data) - 2):
        with pytest.raises((wavelet.WaveletError, zlib.error)):
            opened(data[:at] + bytes([data[at] ^ 255]) + data[at + 1 :]).decode()
    with pytest.raises(wavelet.WaveletError):
        opened(data[:-5])


def test_encoder_equals_library(monkeypatch):
    rnd = random.Random(5)
    signs = ["a", "b", "É", "ß", " ", "'", "s", "T", "\n", "1", "²", "Σ", ",", "<|endoftext|>", "日", "́", "\x1c", "\x85", "😀", "İ", "ſ", " ", "-"]
    texts = ["".join(rnd.choice(signs[: rnd.choice([14, 23])]) for _ in range(rnd.randrange(40))) for _ in range(3000)] + [t or "" for t in TEXTS]
    code = wavelet.Encoder(public_tokenizers.path(NAME))
    for start in range(0, len(texts), 500):
        assert [x.tolist() for x in code.encode(texts[start : start + 500])] == library(texts[start : start + 500])
    assert max(map(len, [*code.chunks.at, *code.pieces.at])) <= wavelet.LONG_CHUNK
    monkeypatch.setattr(wavelet, "MEMO", 300)  # the memo forgets, again and again
    for start in range(0, len(texts), 100):
        assert [x.tolist() for x in code.encode(texts[start : start + 100])] == library(texts[start : start + 100])
    code = wavelet.Encoder(public_tokenizers.path(NAME))
    code.ends_piece[:] = False  # a vocabulary that doesn't mark ends
    assert [x.tolist() for x in code.encode(["some chunks, never met before"])] == library(["some chunks, never met before"])


def test_a_group_looks_up_its_distinct_words():
    seen = []

    class Counted(dict):
        def __getitem__(self, key):
            seen.append(key)
            return super().__getitem__(key)

    code = wavelet.Encoder(public_tokenizers.path(NAME))
    code.chunks.at, texts = Counted(), ["word Word, " * 5000, "", "word\x0bother\x0c \r\n"]
    assert [x.tolist() for x in code.encode(texts)] == library(texts)
    assert len(seen) < 10  # 10,002 before


def test_a_group_looks_up_its_distinct_pieces(monkeypatch):
    seen, numbers = [], wavelet.Memo.numbers
    monkeypatch.setattr(wavelet.Memo, "numbers", lambda self, strings: seen.extend(strings) or numbers(self, strings))
    words, signs = ["alpha", "Beta", "gÀmma", "delta", "é"], [".", ",", ";", "!", "?", ")", "...", "?!", "×", "€"]
    texts = [" ".join(w + s for w in words for s in signs)] * 3 + [""]
    assert [x.tolist() for x in wavelet.Encoder(public_tokenizers.path(NAME)).encode(texts)] == library(texts)
    assert sorted(seen) == sorted([w.lower() for w in words] + signs)  # before, all 50 runs without white space and their 100 pieces


def test_cut_by_kind_equals_pattern():
    rnd = random.Random(7)
    cut = regex.compile(wavelet.BY_KIND[1]["pretokenizers"][0]["pattern"]["Regex"]).findall
    signs = ["'", "'", "s", "t", "r", "e", "v", "m", "l", "d", "a", "1", "²", "-", " ", "\n", "é", "×", "–", "€", "i\u0307", "ⱥ"]
    texts = ["", "'", "'s", "it's's", "''s", "1'll", "we'revs", "'l", "'r", "a'd", "\n"] + ["".join(rnd.choices(signs, k=rnd.randrange(12))) for _ in range(20_000)]
    pieces, counts = wavelet.pieces_by_kind(texts)
    assert pieces.to_pylist() == [p for t in texts for p in cut(t)] and counts.tolist() == [len(cut(t)) for t in texts]


def test_blocks_of_a_long_text(monkeypatch):
    text = "some words, " * 200_000
    tracemalloc.start()
    pieces, counts = wavelet.pieces_by_kind([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pieces) == counts[0] == 600_000
    assert peak < 12 * len(text)  # arrays of code points over the whole text took more
    monkeypatch.setattr(wavelet, "CUT", 8)
    texts = ["hello world, this is", "it's a", "", "  ", "\t" * 20, "loooooooooooooooong'll  x", "\t a\tbbbbbbbbbbbbbbbbbbb\tc's", ""]
    pieces, counts = wavelet.pieces_by_kind(texts)
    assert pieces.to_pylist() == ["hello", "world", ",", "this", "is", "it", "'s", "a", "loooooooooooooooong", "'ll", "x", "a", "bbbbbbbbbbbbbbbbbbb", "c", "'s"]
    assert counts.tolist() == [5, 3, 0, 0, 0, 3, 4, 0]
    code = wavelet.Encoder(public_tokenizers.path(NAME))
    assert [x.tolist() for x in code.encode([*texts, *(t or "" for t in TEXTS)])] == library([*texts, *TEXTS])


def test_encoder_by_pattern_equals_library():
    texts = [t or "" for t in TEXTS] + ["it's we'll İ Ⱥ don'ts 12a", "", "Naïve, naïve. (naïve)"]
    code = wavelet.Encoder(public_tokenizers.path(NAME))
    assert code.by_kind
    code.by_kind = False  # a file with another pattern
    assert [x.tolist() for x in code.encode(texts)] == library(texts)
    assert code.chunks.known and code.encode([]) == []


def test_sure_characters_equal_library():
    sure = [c for c in map(chr, range(1 << 16)) if not wavelet.UNSURE.search(c) and not c.isspace()]
    texts = [f"{c} a{c}b {c}'s \t{c}{c}1{c}" for c in sure] + ["".join(sure)]
    assert [x.tolist() for x in wavelet.Encoder(public_tokenizers.path(NAME)).encode(texts)] == library(texts)


@pytest.mark.parametrize("shard_ids", [1, 300, 1 << 24])
def test_round_trip(spark, shard_ids):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(6, "hello world")] * 40 + [(None, "none"), (None, None), (None, "none"), (-(1 << 62), "first"), (7, TEXTS[3]), (7, "other")]
    frame = spark.createDataFrame([(*r, "s", "p") for r in rows], "doc_id long, text string, seq string, part string").repartition(6)
    out = wavelet.round_trip(frame, NAME, 1, shard_ids)
    assert got(out) == brute(rows)


def test_ids_counts_and_places(spark):
    rows = [(i, f"hello number {i} hello" + " again" * (i % 5)) for i in range(60)] + [(None, "hello")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    uri = wavelet.scratch(spark, "wavelet-test")
    shards = wavelet.write_shards(frame, uri, NAME, 1, 100)
    assert shards.count() > 3
    docs = {r["doc_id"]: np.frombuffer(r["ids"], dtype="<u4").tolist() for r in wavelet.read_shards(shards, uri).collect()}
    assert docs == {d: [*library([t])[0], 1] for d, t in rows}
    hello, again = library(["hello"])[0][0], library(["again"])[0][0]
    assert {r["token"]: r["n"] for r in wavelet.count_ids(shards, uri, [hello, again, 999]).collect()} == {t: sum(ids.count(t) for ids in docs.values()) for t in (hello, again)}
    found = wavelet.find_ids(shards, uri, [again]).collect()
    assert sorted((r["doc_id"], r["place"]) for r in found) == [(d, i) for d, ids in sorted((x for x in docs.items() if x[0] is not None)) for i, t in enumerate(ids) if t == again]


def test_empty_table(spark):
    assert wavelet.round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    out = queries.op11_tokenids(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == dict.fromkeys(("doc_id", "start", "n_tokens", "ids_crc32"), "bigint")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert got(out) == brute(rows)
    assert out.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == sum(len(x) + 1 for x in library([t for _, t in rows]))
