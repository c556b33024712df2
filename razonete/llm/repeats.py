"""Passages that repeat between documents, by difference-cover anchors.

A window is `WINDOW` consecutive words. It is removed from a document if the
same words also begin somewhere in a document with a smaller id.

Anchors are shorter runs of words that begin at cover positions: those whose
number modulo `PERIOD` is in a difference cover, a set in which every shift
occurs as a difference of two members. However two copies of a window lie, some
of the first PERIOD places in them is a cover position in both, and the anchor
of WINDOW - PERIOD + 1 words there lies within the window. So only anchors are
matched over all documents, a fifth of all positions. Where an anchor is shared,
the match is extended: the windows that hold it are matched whole, all 50 words.
Equal runs are found by equal 64-bit hashes; n different windows have a chance
of about n^2 / 2^65 that any two are taken for equal.

Documents are placed by id once, and that placement serves the anchors, the
windows and the removal. Matching goes by hash in two steps: within a task, and
then with one row of each task for each document of the smallest id, so that a
passage which a third of all documents hold is as many rows in its last step as
there are tasks, and no list grows with a group.

Ids are whole numbers; a null id is smaller than all others. Rows that share an
id (up to 2^23) do not remove each other's words, each keeps its own result.
Null and empty texts have no words. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from razonete.llm.common import Words, find_words, range_hashes, signed, windows, word_hashes

WINDOW = 50
PERIOD = 31

# Positions are numbered within a document; the rows of an id take turns of this size.
TURN = 1 << 40
# Rows matched within a task at a time.
TASK_ROWS = 1 << 21

ROWS = "hash bigint, doc bigint, start bigint, n bigint"
RUNS = "doc bigint, start bigint, n bigint"
LIST = "array<struct<start: bigint, n: bigint>>"


def difference_cover(period: int) -> list[int]:
    """A small set of residues such that every residue is a difference of two of them.

    The smallest of the sets that depth-first search finds, by growing size.
    """
    def extend(chosen: list[int], size: int) -> list[int] | None:
        shifts = {(a - b) % period for a in chosen for b in chosen}
        if len(shifts) == period:
            return chosen
        left = size - len(chosen)
        if left == 0 or len(shifts) + left * (2 * len(chosen) + left - 1) < period:
            return None
        for residue in range(chosen[-1] + 1, period):
            if found := extend([*chosen, residue], size):
                return found
        return None

    return next(found for size in range(1, period + 1) if (found := extend([0], size)))


COVER = np.isin(np.arange(PERIOD), difference_cover(PERIOD))


def groups(hash: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by hash, doc and place; where each group of equal hashes begins there, and the group of each row."""
    order = np.lexsort((start, doc, hash))
    first = np.ones(len(order), bool)
    first[1:] = np.diff(hash[order]) != 0
    return order, np.flatnonzero(first), np.cumsum(first) - 1


def runs(doc: np.ndarray, start: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (doc, start, n) that cover start to start + reach - 1 of every row; a run stays within its turn."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    first = np.ones(len(doc), bool)
    first[1:] = (np.diff(doc) != 0) | (np.diff(start) > reach)
    begin = np.flatnonzero(first)
    last = np.append(begin[1:], len(doc)) - 1 if len(doc) else begin
    return doc[begin], start[begin], start[last] + reach - start[begin]


def batch_of(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def in_task(rows: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], every: bool, reach: int) -> Iterator[pa.RecordBatch]:
    """Match rows (hash, doc, start) within a task.

    Rows found to match become runs, with n > 0. What other tasks need to know
    goes on with n = 0. If `every`, all rows of a hash in two documents match, and
    one row with start -1 goes on for it; else those of all but the smallest id
    match, and of the others the first one goes on: what holds for a window of a
    document holds for the same words elsewhere in it (see `same_windows`).
    """
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        hash, doc, start = (np.concatenate(c) for c in zip(*held))
        order, first, group = groups(hash, doc, start)
        hash, doc, start = hash[order], doc[order], start[order]
        later = doc != doc[first][group]
        shared = np.zeros(len(first), bool)
        shared[group[later]] = True
        if every:
            found = shared[group]
            on = ~found
            on[first[shared]] = True
            told = np.where(found, -1, start)
        else:
            again = np.zeros(len(hash), bool)
            again[1:] = (np.diff(hash) == 0) & (np.diff(doc) == 0) & (np.diff(start // TURN) == 0)
            found, on, told = later, ~later & ~again, start
        run_doc, run_start, run_n = runs(doc[found], start[found], reach)
        spread = signed(range_hashes(run_start.astype(np.uint64) ^ run_doc.view(np.uint64),
                                     np.arange(len(run_doc)), np.arange(len(run_doc)) + 1))
        yield batch_of([np.append(hash[on], spread), np.append(doc[on], run_doc), np.append(told[on], run_start),
                        np.append(np.zeros(on.sum(), np.int64), run_n)], ["hash", "doc", "start", "n"])
        held.clear()

    for part in rows:
        held.append(part)
        if sum(len(h) for h, _, _ in held) >= TASK_ROWS:
            yield from flush()
    if held:
        yield from flush()


def between_tasks(rows: DataFrame, every: bool, reach: int) -> DataFrame:
    """Match what tasks have passed on, and give all runs found. Sorted by hash and id, a group begins with its smallest id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((4, 0), np.int64)
        for batch in batches:
            kept = np.hstack([kept, np.array([c.to_numpy() for c in batch.columns])])
            last = np.searchsorted(kept[0], kept[0, -1]) if kept.size else 0
            if last:
                yield matched(kept[:, :last])
                kept = kept[:, last:]
        yield matched(kept)

    def matched(kept: np.ndarray) -> pa.RecordBatch:
        known = kept[3] > 0
        hash, doc, start, _ = kept[:, ~known]
        _, first, group = groups(hash, doc, np.arange(len(hash)))
        later = doc != doc[first][group]
        if every:
            shared = np.zeros(len(first), bool)
            shared[group[later]] = True
            later = shared[group] & (start >= 0)
        found = runs(doc[later], start[later], reach)
        return batch_of([np.append(a, b) for a, b in zip(kept[1:, known], found)], ["doc", "start", "n"])

    return rows.repartition("hash").sortWithinPartitions("hash", "doc").mapInArrow(run, RUNS)


def anchors(batch: pa.RecordBatch, window: int, period: int, cover: np.ndarray):
    """Hash, document and first window to look at for each anchor of the texts of a batch."""
    words = find_words(batch.column("text"))
    length = window - period + 1
    at = windows(words, length)
    text = np.searchsorted(words.first, at, side="right") - 1
    place = at - words.first[text]
    chosen = cover[place % period]
    at, text, place = at[chosen], text[chosen], place[chosen]
    hashes = range_hashes(word_hashes(words), at, at + length)
    doc, turn = batch.column("doc").to_numpy(), batch.column("turn").to_numpy()
    return signed(hashes), doc[text], turn[text] * TURN + np.maximum(place - period + 1, 0)


def spread_runs(lists: pa.Array, turn: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words of a batch are in the runs listed for their text (and turn)."""
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
    flat = lists.flatten()
    start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
    own = start // TURN == turn[row]
    row, n = row[own], n[own]
    begin = first[row] + start[own] % TURN
    change = np.zeros(first[-1] + 1, np.int64)
    np.add.at(change, np.minimum(begin, first[row + 1]), 1)
    np.add.at(change, np.minimum(begin + n, first[row + 1]), -1)
    return np.cumsum(change)[:-1] > 0


def candidate_windows(batch: pa.RecordBatch, window: int):
    """Hash, document and start of the windows that are in the listed runs."""
    words = find_words(batch.column("text"))
    turn = batch.column("turn").to_numpy()
    at = windows(words, window)
    at = at[spread_runs(batch.column("runs"), turn, words.first)[at]]
    text = np.searchsorted(words.first, at, side="right") - 1
    hashes = range_hashes(word_hashes(words), at, at + window)
    return signed(hashes), batch.column("doc").to_numpy()[text], turn[text] * TURN + at - words.first[text]


def same_windows(words: Words, found: np.ndarray, window: int) -> np.ndarray:
    """Which words begin a window that is found, or the same words as one found in the same text."""
    text = words.texts()
    at = windows(words, window)
    at = at[np.isin(text[at], text[found])]
    _, number = np.unique(range_hashes(word_hashes(words), at, at + window), return_inverse=True)
    key = text[at] * len(words.start) + number
    out = np.zeros(len(words.start) + 1, np.int64)
    out[at[np.isin(key, key[found[at]])]] = 1
    return out


def placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (doc, text, turn), all of an id in one place; turn numbers the rows of an id."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-2**63).cast("bigint")).alias("doc"),
                       F.col(text).alias("text"))
    by_text = Window.partitionBy("doc").orderBy(F.xxhash64("text"))
    return rows.repartition(n, "doc").withColumn("turn", (F.row_number().over(by_text) - 1).cast("bigint"))


def listed(found: DataFrame) -> DataFrame:
    """One row for each document that has runs; a document's runs are bounded by its words."""
    return found.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("runs"))


def repeated_runs(rows: DataFrame, window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """Rows (doc, runs) of the windows to remove from placed rows: starts and how many follow each other."""
    cover = COVER if period == PERIOD else np.isin(np.arange(period), difference_cover(period))

    def match(df: DataFrame, of: Callable, every: bool, reach: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return in_task((of(batch) for batch in batches), every, reach)

        return listed(between_tasks(df.mapInArrow(run, ROWS), every, reach))

    shared = match(rows, lambda batch: anchors(batch, window, period, cover), True, period)
    candidates = rows.join(shared, "doc")
    return match(candidates, lambda batch: candidate_windows(batch, window), False, 1)


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
           period: int = PERIOD) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept): the words that stay, one space between."""
    if not 0 < period < window:
        raise ValueError("the period must be shorter than the window")
    rows = placed(docs, doc_id, text)
    joined = rows.join(repeated_runs(rows, window, period), "doc", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = find_words(batch.column("text"))
            found = spread_runs(batch.column("runs"), batch.column("turn").to_numpy(), words.first)
            begins = same_windows(words, found, window) if found.any() else np.zeros(len(found) + 1, np.int64)
            so_far = np.concatenate([np.zeros(window, np.int64), np.cumsum(begins[:-1])])
            gone = so_far[window:] > so_far[:-window]  # a window begins at the word or one of those before it
            kept = []
            for value, a, b in zip(batch.column("text").to_pylist(), words.first, words.first[1:]):
                split = (value or "").encode().split()
                kept.append(b" ".join(compress(split, ~gone[a:b]) if gone[a:b].any() else split).decode())
            sums = np.concatenate([[0], np.cumsum(gone)])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(words.counts()), pa.array(np.diff(sums[words.first])),
                pa.array(kept, pa.string())], ["doc", "n_words", "n_removed", "kept"])

    out = joined.mapInArrow(run, "doc bigint, n_words bigint, n_removed bigint, kept string")
    id_type = docs.schema[doc_id].dataType
    return out.select(F.expr("nullif(doc, -9223372036854775808L)").cast(id_type).alias(doc_id),
                      "n_words", "n_removed", "kept")
