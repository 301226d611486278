"""Counting and cutting text by a public tokenizer's tokens; the vocabulary is a file of ranks whose path is a setting."""

from __future__ import annotations

import base64
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how that tokenizer cuts a text before it merges bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoding(path: str):
    """The encoding of a rank file (a token in base 64 and its rank per line)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(c: Column, path: str) -> Column:
    """Number of tokens; NULL for NULL."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else len(encoding(path).encode_ordinary(t)) for t in texts], dtype="Int64")

    return F.pandas_udf(run, "bigint")(c)


def token_budget(c: Column, most: int, path: str) -> Column:
    """Text of at most so many tokens: unchanged where it already fits, else its first tokens, without a character cut in two."""

    def cut(text: str | None) -> str | None:
        if text is None or len(text) <= most:  # a token has at least one byte, and a character too
            return text
        ids = encoding(path).encode_ordinary(text)
        return text if len(ids) <= most else encoding(path).decode_bytes(ids[:most]).decode("utf-8", "ignore")

    return F.pandas_udf(lambda texts: texts.map(cut, na_action=None), "string")(c)
