"""Helpers of the operators: row-wise Arrow functions, tables between jobs, words and their hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from razonete.session import configure, work_dir

# Bytes that are part of a word: all but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

# Digits, lower-case letters and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/documents.parquet").select(*columns or "*")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: later jobs read them instead of computing them again."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(column: str, by: int) -> Column:
    """crc32 of an id as text, modulo `by`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % by


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it (in either case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def larger(batches: Iterator[pa.RecordBatch], rows: int, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `rows`, or of `size` bytes where that is less."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def add_columns(df: DataFrame, source: str, fields: str, function: Callable[[pa.Array], list[pa.Array]],
                rows: int = 1) -> DataFrame:
    """Append the columns `fields` (DDL), made from column `source` batch by batch in Python workers.

    `function` gets an Arrow array and returns an array for each field. All other
    columns pass through unseen. `fields` must not clash; see `free_name`.
    Batches are put together to `rows` rows where a function works better on more.
    """
    added = T.StructType.fromDDL(fields)
    at = df.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in larger(batches, rows):
            columns = [*batch.columns, *function(batch.column(at))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *added.names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added.fields]))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins and the last ends; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """The words of a batch of texts; word i is data[start[i]:end[i]], text t has the words first[t]:first[t + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def join(self, start: int, end: int) -> bytes:
        """The words start to end - 1, with a space between."""
        data = self.data
        return b" ".join(data[a:b].tobytes() for a, b in zip(self.start[start:end], self.end[start:end]))


def find_words(column: pa.Array, kind: np.ndarray = NOT_SPACE, fold: np.ndarray = AS_IS) -> Words:
    """Longest runs of the bytes `kind` in each text, after `fold`."""
    data, offsets = text_buffers(column)
    data = fold[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = kind[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    begins[edges] |= inside[edges]
    start = np.flatnonzero(begins)
    stops = ~inside
    stops[edges] = True
    stops[1:] &= inside[:-1]
    stops[0] = False
    return Words(data, start, np.flatnonzero(stops), np.searchsorted(start, offsets))


BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, np.uint64)


_known_powers = [np.ones(1, np.uint64)] * 2


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2^64, and of its inverse, for exponents up to n at least. The longest ones are kept."""
    if len(_known_powers[0]) <= n:
        size = max(1 << 12, n + n // 4 + 1)
        for i, base in enumerate((BASE, pow(BASE, -1, 2**64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _known_powers[i] = np.multiply.accumulate(out)
    return _known_powers[0], _known_powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread each value over all 64 bits, one to one."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Hashes:
    """64-bit polynomial hashes of ranges of `values`; equal ranges have equal hashes."""

    def __init__(self, values: np.ndarray) -> None:
        power, self.inverse = powers(len(values))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[:len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of values[start[i]:end[i]] for each i."""
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Hashes(values).of(start, end)


def word_hashes(words: Words) -> np.ndarray:
    return range_hashes(BYTE_VALUES[words.data], words.start, words.end)


def spell(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word the number of its spelling; all spellings with a space around each, and their bounds."""
    _, example, number = np.unique(word_hashes(words), return_index=True, return_inverse=True)
    size = words.end[example] - words.start[example]
    bounds = np.concatenate([[0], np.cumsum(size + 2)])
    spelled = np.full(bounds[-1], 32, np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    spelled[np.repeat(bounds[:-1] + 1, size) + inside] = words.data[np.repeat(words.start[example], size) + inside]
    return number, spelled, bounds


def char_begins(spelled: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of all characters of spelled words and the end of the last one, and the word of each."""
    begins = np.append(np.flatnonzero((spelled & 0xC0) != 0x80), len(spelled))
    chars = np.diff(np.searchsorted(begins, bounds))
    return begins, np.append(np.repeat(np.arange(len(chars)), chars), len(chars))


def windows(words: Words, length: int) -> np.ndarray:
    """First words of all runs of `length` words within one text."""
    n = len(words.start) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    text = words.texts()
    return np.flatnonzero(text[:n] == text[length - 1:])


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed number, as Spark's long holds them."""
    return h.view(np.int64)
