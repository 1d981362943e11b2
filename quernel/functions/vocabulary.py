"""Counting and cutting texts by the tokens of a public byte-level vocabulary.

The vocabulary file's path is a parameter (``$QUERNEL_TOKENIZERS`` by default); it is broadcast, so executors need no
file. Where there is none, the word estimates of ``functions.text`` are the fallback.
"""

from __future__ import annotations

import base64
import os

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Where the public vocabularies lie; a parameter of each operator.
TOKENIZERS = os.environ.get("QUERNEL_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = "byte_bpe_50k.tiktoken"

# Fixed value: the pre-token pattern of byte-level BPE, as it is published.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranks(path: str) -> dict[bytes, int]:
    """Bytes of each token and its id; as many entries as the vocabulary has, whatever the corpus."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def vocabulary_path(name: str = BYTE_BPE_50K, folder: str | None = None) -> str:
    return os.path.join(folder or TOKENIZERS, name)


class Encoder:
    """Encodes on executors. It carries the vocabulary as a broadcast, so no executor needs the file."""

    _made: dict = {}

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.path = path or vocabulary_path()
        self.ranks = spark.sparkContext.broadcast(ranks(self.path))

    def __getstate__(self) -> dict:
        return {"path": self.path, "ranks": self.ranks}

    @property
    def encoding(self):
        if self.path not in Encoder._made:
            import tiktoken

            Encoder._made[self.path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks.value, special_tokens={})
        return Encoder._made[self.path]

    def ids(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def head(self, text: str, n: int) -> str:
        """The text of the first ``n`` tokens; a sign cut within becomes U+FFFD, as decoding has it."""
        ids = self.ids(text)
        return text if len(ids) <= n else self.encoding.decode(ids[:n])


def token_count(encoder: Encoder, text: Column | str) -> Column:
    """How many tokens ``text`` has; 0 for null and empty texts."""

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(encoder.ids(t)) if t else 0).astype("int32")

    return count(text)


def truncate_tokens(encoder: Encoder, text: Column | str, n: int) -> Column:
    """The first ``n`` tokens of ``text``; empty for null and for ``n`` of 0 or less, unchanged if it has no more."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: encoder.head(t, n) if t and n > 0 else "")

    return cut(text)
