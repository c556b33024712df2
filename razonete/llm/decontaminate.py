"""Benchmark passages in documents, by a prefix-filtered set join.

Words are runs of ASCII letters (lower-cased), digits and all characters beyond
ASCII. A window is `WINDOW` consecutive words of an item, or all its words if
it has fewer. A window is seen as the set of its shingles (`SHINGLE` words, or
the whole window if that is shorter). Shingles are ordered by rarity over all
documents. A document holds a window only if it holds all its shingles, so the
prefix that must be joined is the rarest one; where that one occurs in no
document, the window is out. A shared shingle fixes where the window would
begin: candidates that would not lie within the document are dropped, the
others are compared word by word.

Items are taken in blocks of bounded size, one broadcast index for each, and
all documents meet every block; hits are carried along in a column.

Null and empty texts, and items without words, give no hits. Repeated documents
are rows of their own, items with equal ids count as one, a null item id counts
as empty text. Without items, no document has hits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from razonete.llm.common import (
    ALNUM, LOWER, Words, add_columns, find_words, free_name, range_hashes, saved, windows, word_hashes)

WINDOW = 13
SHINGLE = 5
BLOCK_CHARS = 8_000_000

HITS = "array<struct<item: string, start: bigint, end: bigint>>"
HITS_ARROW = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@dataclass
class Index:
    """Windows of items, and the shingles by which documents find them.

    Shingle s has size[s] words and hash[s]; sorted by both. Window w has
    length[w] words and text[w], and is in the items items[w]. Entries say that
    shingle entry_shingle[e] is in window entry_window[e], entry_offset[e] words
    from its begin; sorted by shingle.
    """

    size: np.ndarray
    hash: np.ndarray
    length: np.ndarray
    text: list[bytes]
    items: list[list[str]]
    entry_shingle: np.ndarray
    entry_window: np.ndarray
    entry_offset: np.ndarray

    def lookup(self, words: Words, hashes: np.ndarray):
        """First words of all shingles in a batch that the index holds, and which they are."""
        for size in np.unique(self.size):
            a, b = np.searchsorted(self.size, [size, size + 1])
            at = windows(words, size)
            of = range_hashes(hashes, at, at + size)
            found = np.minimum(a + np.searchsorted(self.hash[a:b], of), b - 1)
            same = self.hash[found] == of
            yield at[same], found[same]


def build_index(rows: list[tuple[str, str | None]], window: int = WINDOW, shingle: int = SHINGLE) -> Index:
    """All shingles of all windows of the items (id, text)."""
    words = find_words(pa.array([text for _, text in rows], pa.string()), ALNUM, LOWER)
    hashes = word_hashes(words)
    numbers: dict[bytes, int] = {}
    items: list[set[str]] = []
    at: list[tuple[int, int]] = []
    for (item, _), a, b in zip(rows, words.first, words.first[1:]):
        length = min(window, b - a)
        for start in range(a, b - length + 1) if length else ():
            text = words.join(start, start + length)
            if (number := numbers.setdefault(text, len(items))) == len(items):
                items.append(set())
                at.append((start, length))
            items[number].add(item)
    start, length = np.array(at, np.int64).reshape(-1, 2).T
    size = np.minimum(length, shingle)
    per_window = length - size + 1
    of = np.repeat(np.arange(len(at)), per_window)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(per_window) - per_window, per_window)
    first = start[of] + offset
    keys = np.rec.fromarrays([size[of], range_hashes(hashes, first, first + size[of])], names="size,hash")
    shingles, entry = np.unique(keys, return_inverse=True)
    order = np.argsort(entry, kind="stable")
    return Index(shingles["size"], shingles["hash"], length, list(numbers),
                 [sorted(i) for i in items], entry[order], of[order], offset[order])


def keep_prefixes(index: Index, counts: np.ndarray) -> Index:
    """The index with only the rarest shingle of each window, given how often documents hold each shingle."""
    order = np.lexsort((index.entry_offset, index.entry_shingle, counts[index.entry_shingle], index.entry_window))
    _, first = np.unique(index.entry_window[order], return_index=True)
    kept = order[first]
    kept = np.sort(kept[counts[index.entry_shingle[kept]] > 0])
    used, entry = np.unique(index.entry_shingle[kept], return_inverse=True)
    return Index(index.size[used], index.hash[used], index.length, index.text, index.items,
                 entry, index.entry_window[kept], index.entry_offset[kept])


def occurrences(words: Words, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """First words and numbers of all windows that occur in a batch of texts."""
    hashes, text_of = word_hashes(words), words.texts()
    starts, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, shingle in index.lookup(words, hashes):
        a = np.searchsorted(index.entry_shingle, shingle)
        n = np.searchsorted(index.entry_shingle, shingle, side="right") - a
        entry = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = np.repeat(at, n)
        window = index.entry_window[entry]
        start = at - index.entry_offset[entry]
        end = start + index.length[window]
        text = text_of[at]
        fits = (start >= words.first[text]) & (end <= words.first[text + 1])
        same = [words.join(s, e) == index.text[w] for s, e, w in zip(start[fits], end[fits], window[fits])]
        starts.append(start[fits][np.array(same, bool)])
        numbers.append(window[fits][np.array(same, bool)])
    return np.concatenate(starts), np.concatenate(numbers)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def hits_of(words: Words, index: Index) -> list[list[dict]]:
    """For each text, spans of words that are in windows of an item, by item."""
    spans: list[dict[str, list[tuple[int, int]]]] = [{} for _ in range(len(words.first) - 1)]
    start, window = occurrences(words, index)
    text = np.searchsorted(words.first, start, side="right") - 1
    for s, t, w in zip((start - words.first[text]).tolist(), text.tolist(), window.tolist()):
        for item in index.items[w]:
            spans[t].setdefault(item, []).append((s, s + int(index.length[w])))
    return [[{"item": i, "start": a, "end": b} for i in sorted(of) for a, b in merged(of[i])] for of in spans]


def shingle_counts(docs: DataFrame, text: str, index: Index) -> np.ndarray:
    """How often all documents hold each shingle of the index."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for batch in batches:
            words = find_words(batch.column(0), ALNUM, LOWER)
            found = [np.zeros(0, np.int64), *(s for _, s in sent.value.lookup(words, word_hashes(words)))]
            shingle, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(n)], ["shingle", "n"])

    rows = docs.select(text).mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(index.hash), np.int64)
    for row in rows.collect():  # one row for each shingle of a bounded block at most
        counts[row["shingle"]] = row["n"]
    return counts


def find(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         hits: str = "hits", n_words: str = "n_words", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Add the spans of words (start, end exclusive) that each document shares with windows of each item, and how many
    words it has."""
    items = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                         F.coalesce(item_text, F.lit("")).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        index = build_index([tuple(r) for r in rows], window)
        index = keep_prefixes(index, shingle_counts(docs, text, index))
        if not block:
            docs = _add_hits(docs, text, hits, n_words, index)
        else:
            found, counted = free_name(docs, "_found"), free_name(docs, "_counted")
            docs = _add_hits(docs, text, found, counted, index)
            docs = docs.withColumn(hits, F.concat(hits, found)).drop(found, counted)
        if blocks > 1:
            docs = saved(docs, "hits")
    return docs


def _add_hits(docs: DataFrame, text: str, hits: str, n_words: str, index: Index) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(column: pa.Array) -> list[pa.Array]:
        words = find_words(column, ALNUM, LOWER)
        return [pa.array(hits_of(words, sent.value), HITS_ARROW), pa.array(words.counts())]

    return add_columns(docs, text, f"`{hits}` {HITS}, `{n_words}` bigint", run)


def covered(hits: str) -> Column:
    """How many words are within any of the spans."""
    spans = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"))))
    nothing = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(0).cast("bigint").alias("n"))

    def add(sum_: Column, span: Column) -> Column:
        more = F.greatest(span["end"] - F.greatest(span["start"], sum_["upto"]), F.lit(0).cast("bigint"))
        return F.struct(F.greatest(sum_["upto"], span["end"]).alias("upto"), (sum_["n"] + more).alias("n"))

    return F.aggregate(spans, nothing, add, lambda sum_: sum_["n"])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more, and at least one, is from the benchmark."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
