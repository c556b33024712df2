"""Near-duplicate documents: SimHash fingerprints linked by anchor-point covering.

A fingerprint has 64 bits: bit i is 1 if it is set in over half of the hashes of
the text's shingles, repeats included. Shingles are `SHINGLE` words with a space
between (or all words, if there are fewer), hashed with XXH64.

Anchors are a covering code: the Hamming code of length 63 beside one free bit.
Its covering radius is `RADIUS` = 1: every 64-bit value lies within 1 bit of an
anchor. Two fingerprints that differ in at most t bits have a value between them
that is within ceil(t / 2) of both, and the anchor that covers this value is
within RADIUS + ceil(t / 2) of both. So each fingerprint is replicated to all
anchors within that distance (33 for t = 2), and only fingerprints that share an
anchor are compared. No group can grow with the data: whatever the texts, an
anchor has at most 2,081 distinct fingerprints within 2 bits. Within a group,
links are given as a forest with the same components, not as all pairs.

Equal fingerprints are one node from the start, however many documents have it.
Nulls and texts without words have fingerprint 0 and are linked like any other.
Repeated documents are rows of their own with the same result; an empty table
gives an empty one; a null id is no component's smallest unless it is alone.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from razonete.llm.common import add_columns, free_name, saved, signed
from razonete.llm.components import components
from razonete.operators.joins import join_unique

SHINGLE = 3
SEED = 42
THRESHOLD = 2
RADIUS = 1

_hash = functools.partial(xxhash.xxh64_intdigest, seed=SEED)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased (A-Z) words, in order; words end at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = zip(*(words[i:] for i in range(min(size, len(words)))))
    return np.fromiter(map(_hash, map(b" ".join, shingles)), np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes; 0 for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", fingerprint: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each text, as the long with the same bits."""
    def run(column: pa.Array) -> list[pa.Array]:
        values = [majority_bits(shingle_hashes(t)) for t in column.to_pylist()]
        return [pa.array(signed(np.array(values, np.uint64)))]

    return add_columns(docs, text, f"`{fingerprint}` bigint", run)


def _positions() -> np.ndarray:
    """Column s, up to 63: pairs i < j of the bits 1 to 63 with i ^ j = s, as masks; rows are the 31 pairs."""
    masks = np.zeros((31, 64), np.uint64)
    for s in range(1, 64):
        pairs = [(i, i ^ s) for i in range(1, 64) if i < i ^ s]
        masks[:, s] = [(1 << i) | (1 << j) for i, j in pairs]
    return masks


PAIRS = _positions()
# Bits whose number, 1 to 63, has bit k set. Bit 0 is the free one.
CHECKS = [np.uint64(sum(1 << i for i in range(1, 64) if i >> k & 1)) for k in range(6)]


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within 2 bits of each value: positions in `values`, and the anchors."""
    syndrome = np.zeros(len(values), np.int64)
    for k, check in enumerate(CHECKS):
        syndrome |= (np.bitwise_count(values & check).astype(np.int64) & 1) << k
    at = np.flatnonzero(syndrome)
    on = np.flatnonzero(syndrome == 0)
    one = np.uint64(1)
    nearest = values[at] ^ (one << syndrome[at].astype(np.uint64))
    further = (values[at] ^ PAIRS[:, syndrome[at]]).ravel()
    of = np.concatenate([at, at, np.tile(at, len(PAIRS)), on, on])
    return of, np.concatenate([nearest, nearest ^ one, further, values[on], values[on] ^ one])


def forest(values: np.ndarray, threshold: int) -> Iterator[tuple[int, int]]:
    """Links (from, to) between distinct values with the components of all links within the threshold."""
    left = np.sort(values)
    while len(left):
        reached, left, at = [left[0]], left[1:], 0
        while at < len(reached) and len(left):
            near = np.bitwise_count(left ^ reached[at]) <= threshold
            for v in left[near]:
                yield reached[at], v
            reached += list(left[near])
            left, at = left[~near], at + 1


def links(nodes: DataFrame, fingerprint: str = "fingerprint", threshold: int = THRESHOLD) -> DataFrame:
    """Edges (a, b) between distinct fingerprints; reachable by them is what is reachable by all links."""
    if not 0 <= threshold <= 2:
        raise ValueError("the anchors cover thresholds up to 2")

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            of, anchor = anchors(values)
            yield pa.RecordBatch.from_arrays([pa.array(signed(anchor)), pa.array(signed(values[of]))], ["anchor", "value"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((2, 0), np.int64)
        for batch in batches:
            kept = np.hstack([kept, [batch.column(0).to_numpy(), batch.column(1).to_numpy()]])
            last = np.searchsorted(kept[0], kept[0, -1]) if kept.size else 0
            yield edges(kept[:, :last], threshold)
            kept = kept[:, last:]  # the last group may go on in the next batch; a group is bounded
        yield edges(kept, threshold)

    replicas = nodes.select(fingerprint).mapInArrow(replicate, "anchor bigint, value bigint")
    grouped = replicas.repartition("anchor").sortWithinPartitions("anchor", "value")
    return grouped.mapInArrow(compare, "a bigint, b bigint").distinct()


def edges(rows: np.ndarray, threshold: int) -> pa.RecordBatch:
    """Edges within groups: rows[0] has the anchors in order, rows[1] the distinct values of each."""
    anchor, value = rows[0], rows[1].view(np.uint64)
    begin = np.flatnonzero(np.diff(anchor, prepend=anchor[:1] - 1)) if len(anchor) else np.zeros(0, np.int64)
    size = np.diff(begin, append=len(anchor))
    two = begin[size == 2]
    near = two[np.bitwise_count(value[two] ^ value[two + 1]) <= threshold]
    a, b = [value[near]], [value[near + 1]]
    for start, n in zip(begin[size > 2], size[size > 2]):
        found = np.array(list(forest(value[start:start + n], threshold)), np.uint64).reshape(-1, 2)
        a.append(found[:, 0])
        b.append(found[:, 1])
    return pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(c))) for c in (a, b)], ["a", "b"])


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id): component_id is the smallest id reachable over links, itself included."""
    rows = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).drop("text")
    rows = saved(rows, "fingerprints")
    nodes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes, threshold=threshold))
    rooted = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = join_unique(rooted.select("fingerprint", "root"), least, "root", "inner").drop("root")
    return join_unique(rows, named, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row of each component, that of the smallest id (nulls last), all columns as they are.

    It is chosen row by row: of a component's rows with that id, the one whose text has the smallest hash stays, and one
    of equal ones. Another component's row under the id of a dropped one stays. Rows without words are one component.
    """
    fingerprint, row = free_name(docs, "_fingerprint"), free_name(docs, "_row")
    # Written once, so that a row has its number for good.
    rows = saved(fingerprints(docs, text, fingerprint).withColumn(row, F.monotonically_increasing_id()), "numbered")
    first = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"),
                     F.xxhash64(F.coalesce(text, F.lit(""))).alias("text"), F.col(row).alias("row"))
    nodes = saved(rows.groupBy(fingerprint).agg(F.min(first).alias("first")), "nodes")
    roots = components(links(nodes, fingerprint, threshold))
    rooted = nodes.join(roots, nodes[fingerprint] == roots["node"], "left")
    chosen = rooted.groupBy(F.coalesce("root", fingerprint)).agg(F.min("first").alias("first"))
    return rows.join(chosen.select(F.col("first.row").alias(row)), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
