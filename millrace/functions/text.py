"""Text normalization as columns: exact Unicode case folding, white space, prompt hashes.

Spark's ``lower`` and ``\\s`` differ from full case folding and from the Unicode white-space set,
so both are built here from plain columns; no Python runs on the executors.
"""

from __future__ import annotations

import functools
import hashlib
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode-aware text processing splits on it; U+200B is not part of it.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

#: Texts of these characters only (Latin, Latin-1 and Extended-A without U+00B5, U+0130, U+0149 and
#: U+017F) fold as ``lower`` does, but for U+00DF.
PLAIN = r"\A[\x00-\xb4\xb6-\u012f\u0131-\u0148\u014a-\u017e]*+\z"


#: Fixed value: SHA-256 of the folding table that all prompt hashes are made with.
FOLD_SHA256 = "6b5c0c485c5e7fd5707eec56af54a443a1651dc16e37ca22184985b72d142c42"


@functools.lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(characters that fold to one, what they fold to, pairs that fold to several), by rule.

    The rule is the interpreter's, so its outcome is held against a fixed digest: under another Unicode
    version prompt hashes would change unseen, and this raises instead."""
    one, to, several = [], [], []
    for cp in range(sys.maxunicode + 1):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        f = c.casefold()
        if f == c:
            continue
        if len(f) == 1:
            one.append(c)
            to.append(f)
        else:
            several.append((c, f))
    made = "".join(one), "".join(to), tuple(several)
    if (got := hashlib.sha256(repr(made).encode("utf-8", "surrogatepass")).hexdigest()) != FOLD_SHA256:
        raise RuntimeError(f"case folding differs from the one that hashes are made with: {got}")
    return made


def casefold(text: Column) -> Column:
    """Full, context-free case folding. Folding is per character, so the one-to-one part is one
    ``translate``; the characters that grow are replaced only in texts that hold any."""
    one, to, several = fold_tables()
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(f).alias("f")) for c, f in several])
    holds = "[" + "".join(c for c, _ in several) + "]"
    grow = lambda t: F.aggregate(pairs, t, lambda acc, p: F.replace(acc, p["c"], p["f"]))
    # a one-element transform binds the translated text, so that it is made once
    full = F.transform(F.array(F.translate(text, one, to)), lambda t: F.when(t.rlike(holds), grow(t)).otherwise(t))[0]
    return F.when(text.rlike(PLAIN), F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))).otherwise(full)


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, rf"\A{SPACE}++", ""), rf"{SPACE}++\z", "")


def collapse(text: Column) -> Column:
    """Runs of white space become one space; none stays at the ends."""
    return F.trim(F.regexp_replace(text, rf"{SPACE}++", " "))


def normalized_prompt(text: Column) -> Column:
    return collapse(casefold(text))


def prompt_hash(language: Column, prompt: Column) -> Column:
    """SHA-256 of language, a zero byte and the normalized prompt; the language scopes duplicates."""
    return F.sha2(F.concat(language, F.char(F.lit(0)), normalized_prompt(prompt)).cast("binary"), 256)


def row_language(value: Column, present: bool = True) -> Column:
    """A language taken from the row: stripped; null reads as the text None, blank or absent as unknown."""
    if not present:
        return F.lit("unknown")
    named = strip(F.coalesce(value.cast("string"), F.lit("None")))
    return F.when(named == "", F.lit("unknown")).otherwise(named)


def is_commit(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\A[0-9a-f]{40}\z"), F.lit(False))


def looks_like_sha256(text: Column) -> Column:
    return F.coalesce(F.char_length(text) == 64, F.lit(False))


def repo_folder(repo_id: Column) -> Column:
    return F.replace(repo_id, F.lit("/"), F.lit("--"))
