import random

import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import tokens

NAME = "word_bpe_49k.json"
TEXTS = [None, "", " \n", "hello world", "x" * 5000, "<|endoftext|>", "a<|startoftext|>B <|ENDOFTEXT|>", "İ ΣΑΣ ß é é", "'S 're 12²½", "日本語 😀", "\x1c\x85\xa0  ​", "word " * 5000]


def library(texts):
    t = Tokenizer.from_file(public_tokenizers.path(NAME))
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_counter_equals_library():
    rnd = random.Random(5)
    signs = ["a", "b", "É", "ß", " ", "'", "s", "T", "\n", "1", "²", "Σ", ",", "<|endoftext|>", "日", "́", "\x1c", "\x85", "😀", "İ", "ſ", " ", "-"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    counter = tokens.TokenCounter(public_tokenizers.path(NAME))
    assert [counter.count(t) for t in texts] == library(texts)


def test_merges_lowest_rank_first():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("aa", "aa"): 4, ("a", "a"): 3}
    assert tokens.merge_count(list("abc"), ranks) == 1
    assert tokens.merge_count(list("aaaaa"), ranks) == 2
    assert tokens.merge_count([], ranks) == 0 and tokens.merge_count(["z"], ranks) == 1


def test_query(spark):
    rows = [(i, t, "e") for i, t in enumerate(TEXTS)] + [(3, "hello world", "e"), (None, "x", None)]
    got = tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), NAME, limit=10).collect()
    want = library([t for _, t, _ in rows])
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(((i, len((t or "").encode()), n, n > 10) for (i, t, _), n in zip(rows, want, strict=True)), key=key)
    assert tokens.count_tokens(spark.createDataFrame([], "doc_id long, text string")).count() == 0
