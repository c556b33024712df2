"""Byte-level BPE: texts to token ids and back.

`encode` splits very long texts where the pattern always splits: before white
space that follows another character. No match of the pattern goes over such a
place and none looks back, so the parts together give the ids of the whole. A
part without such a place stays whole, as it may be one match.

Nulls and empty texts have no ids. A decoded id list gives its raw bytes, which
need not be whole characters; null ids give empty bytes, an id that the ranks
lack raises an error. Equal texts have equal ids; rows are neither merged nor
dropped, an empty table stays empty, and other columns pass through.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from razonete.llm.common import add_columns

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PART_CHARS = 1 << 16
BEFORE_SPACE = regex.compile(r"\S(?=\s)")


@functools.cache
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: lines of a token in base64 and its rank."""
    with open(ranks_path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS) -> list[str]:
    """The text cut at safe places, the first at or after every `size` characters."""
    cuts, at = [0], 0
    while len(text) - at > size and (found := BEFORE_SPACE.search(text, at + size - 1)):
        at = found.end()
        cuts.append(at)
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


def encode_text(text: str | None, of: tiktoken.Encoding, size: int = PART_CHARS) -> list[int]:
    if not text:
        return []
    if len(text) <= size:
        return of.encode_ordinary(text)
    return [i for part in parts(text, size) for i in of.encode_ordinary(part)]


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", ranks: str = RANKS,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add the token ids of each text as array<int>; special tokens are ordinary text."""
    def run(column: pa.Array) -> list[pa.Array]:
        of = encoding(ranks, pattern)
        lists = [np.array(encode_text(t, of), np.int32) for t in column.to_pylist()]
        ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
        values = np.concatenate([np.zeros(0, np.int32), *lists])
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]

    return add_columns(docs, text, f"`{ids}` array<int>", run)


def decode(docs: DataFrame, ids: str = "ids", decoded: str = "decoded", ranks: str = RANKS,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add the bytes that the ids of each row stand for."""
    def run(column: pa.Array) -> list[pa.Array]:
        of = encoding(ranks, pattern)
        return [pa.array([of.decode_bytes(i or []) for i in column.to_pylist()], pa.binary())]

    return add_columns(docs, ids, f"`{decoded}` binary", run)
