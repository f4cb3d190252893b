"""Token counters behind one interface: a default by pattern, and one by a local tokenizer file."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of letters, digits and underscores, or single other signs.
PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


class TokenCounter(Protocol):
    """``name`` goes into manifests: quotas and length limits depend on the counter."""

    name: str

    def count(self, text: Column) -> Column: ...


@dataclass(frozen=True)
class PatternCounter:
    """Counts matches of a pattern inside the JVM."""

    pattern: str = PATTERN

    @property
    def name(self) -> str:
        return f"pattern:{self.pattern}"

    def count(self, text: Column) -> Column:
        return F.regexp_count(text, F.lit(self.pattern)).cast("long")


@dataclass(frozen=True)
class FileCounter:
    """Counts the ids of a tokenizer file (.json of ``tokenizers``), in Arrow batches. A text that the
    tokenizer fails on has no count, which normalization gives as the row's reason."""

    path: str

    @property
    def name(self) -> str:
        return f"file:{self.path}"

    def count(self, text: Column) -> Column:
        path = self.path

        @F.pandas_udf("long")
        def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            for batch in batches:
                known = batch.notna()
                counts = pd.Series([None] * len(batch), dtype="Int64", index=batch.index)
                counts[known] = _lengths(tokenizer, list(batch[known]))
                yield counts

        return lengths(text)


def _lengths(tokenizer, texts: list[str]) -> list[int | None]:
    try:
        return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    except Exception:  # noqa: BLE001  the library raises plain exceptions; find the texts that it fails on
        if len(texts) == 1:
            return [None]
        half = len(texts) // 2
        return _lengths(tokenizer, texts[:half]) + _lengths(tokenizer, texts[half:])
