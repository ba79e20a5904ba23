"""Sizes of texts in tokens of a public byte-level tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file (ranks) of the tokenizer; a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed pattern: how the tokenizer cuts a text into words before merging bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A text is handed to the tokenizer in pieces of about so many characters, cut before a space, as its time per piece grows
#: with the longest run without one.
PIECE = 100_000


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str | None, path: str = VOCABULARY) -> int:
    """Number of tokens of the whole text; 0 for null."""
    if not text:
        return 0
    total, at = 0, 0
    while at < len(text):
        end = len(text) if len(text) - at <= PIECE else text.rfind(" ", at + 1, at + PIECE)
        end = at + PIECE if end <= at else end
        total += len(encoder(path).encode_ordinary(text[at:end]))
        at = end
    return total


def with_tokens(df: DataFrame, text: str, path: str = VOCABULARY) -> DataFrame:
    """``df`` without ``text`` and with ``n_tokens``."""
    keep = [c for c in df.columns if c not in (text, "n_tokens")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["n_tokens"] = [count(t, path) for t in batch.pop("_text")]
            yield batch

    rows = df.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "_text")
    return rows.mapInPandas(run, f"{kinds}, n_tokens bigint")
