"""Document fingerprints: MinHash signatures, joined by bands, and Jaccard similarity verified.

Shingles are `SHINGLE` words (lower-cased A-Z, ended by ASCII white space), or
all words if there are fewer. A signature has `SIZE` values: the least value of
each of as many universal hash functions (a * x + b modulo 2^64) over the
shingles' 64-bit hashes, mixed and cut to 16 bits. The share of equal values in
two signatures estimates the Jaccard similarity of their shingle sets, with a standard error of
0.045 at most. As text it is four hex digits for each value.

Near-duplicates are found among different texts: texts that share a band of
`ROWS` values are candidates, so a pair of similarity 0.8 is missed with a chance
of 1 in 20 million. Signatures and shingle sets of the texts that share any are
written to files in the shared folder, and a group's task reads those of its
texts: each text is compared with the first, and the texts that this leaves apart
with all others, by signature and where that makes it likely by their sets, unless
they are connected by then. A pair is compared in the group of the first band
that it shares. So tasks give out a forest of verified links, however large a
group is, and no texts are shuffled. Where a group leaves apart so many texts that
more remains to compare than `HOT` texts with as many, it is split by each further
band: a pair whose first common band is hot needs two then, and is missed with a
chance of 1 in 900,000. Texts that are not reachable by links are
not similar but for these chances. Different texts are told apart by 64 bits,
different shingles of a text or a pair by `BITS`.

Null and empty texts, and texts without words, share the signature of no
shingles; they are like each other (1) and unlike all others (0). Equal texts
have equal fingerprints. Repeated rows keep rows of their own; an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from razonete.llm.common import LOWER, NOT_SPACE, Hashes, add_columns, find_words, free_name, mix, saved, signed, word_hashes
from razonete.llm.components import components
from razonete.llm.lm import write_level
from razonete.llm.trie import EliasFano, Level, read_arrays, write_arrays
from razonete.operators.joins import join_unique
from razonete.session import work_dir

SHINGLE = 5
SIZE = 128
ROWS = 4
SIMILARITY = 0.8
# Signatures of a pair of similarity 0.8 agree in less than this with a chance of 1 in 10 million.
LIKELY = 0.6
# Groups where more is left to compare than so many texts with as many are split by further bands.
HOT = 1000
# In larger groups so many texts are compared with all others first.
HUBS = 16
# All pairs of a group of so few texts are looked at together with those of other such groups.
SMALL = 16
# Bits of a shingle's hash that are kept to compare sets.
BITS = 40
# Shingles of a file, rows of a task, and rows looked up, pairs and texts compared at a time.
FILE_SIZE = 1 << 22
TASK_ROWS = 20_000
LOOKED_UP = 1 << 13
PAIRS = 1 << 15
BLOCK_TEXTS = 1000
LINK = ["a", "b", "similarity", "band", "file", "rank"]

_random = np.random.Generator(np.random.PCG64(11))
FACTORS = _random.integers(0, 2**63, SIZE, np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _random.integers(0, 2**64, SIZE, np.uint64)
# Shingles hashed at a time, so that a long text needs no large matrix.
BLOCK = 1 << 13


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text, one text after the other, and where each text's begin and end."""
    words = find_words(column, NOT_SPACE, LOWER)
    counts = words.counts()
    n = np.where(counts, np.maximum(counts - size + 1, 1), 0)
    first = np.concatenate([[0], np.cumsum(n)])
    start = np.repeat(words.first[:-1] - first[:-1], n) + np.arange(first[-1])
    end = np.minimum(start + size, np.repeat(words.first[1:], n))
    return Hashes(word_hashes(words)).of(start, end), first


def signatures(column: pa.Array) -> np.ndarray:
    """The signature of each text, as a row of 16-bit values."""
    hashes, first = shingles(column)
    return least_values(hashes, first)


def least_values(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.full((SIZE, len(first) - 1), np.uint64(2**64 - 1))
    filled = np.flatnonzero(np.diff(first))
    for at in range(0, len(hashes), BLOCK):
        to = min(at + BLOCK, len(hashes))
        a, b = np.searchsorted(first[filled + 1], at, side="right"), np.searchsorted(first[filled], to)
        texts = filled[a:b]
        begin = np.maximum(first[texts] - at, 0)
        for k in range(SIZE):
            values = np.minimum.reduceat(hashes[at:to] * FACTORS[k] + TERMS[k], begin)
            out[k, texts] = np.minimum(out[k, texts], values)
    return (mix(out) >> np.uint64(48)).astype(np.uint16).T


def to_text(signature: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in np.ascontiguousarray(signature.astype(">u2"))]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal values, row by row."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of another."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (part, own, id, text): each partition holds a part of the documents in the order of ids and texts, then,
    with `own` false, a copy of what comes next; the first document comes next after the last.

    Bounds between parts are quantiles of the ids, as many as there are shuffle partitions.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank = F.coalesce(F.col(doc_id).cast("double"), F.lit(float("-inf")))
    ids = docs.select(rank.alias("rank")).where("rank > double('-infinity')")
    bounds = np.unique(ids.approxQuantile("rank", [i / n for i in range(1, n)], 0.2 / n)) if n > 1 else np.zeros(0)

    @F.arrow_udf("int")
    def part_of(ranks: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, ranks.to_numpy(zero_copy_only=False)).astype(np.int32))

    rows = docs.select(rank.alias("rank"), F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("part", part_of("rank"))
    firsts = sorted(tuple(r) for r in rows.groupBy("part").agg(F.min("rank")).collect())  # one for each part
    before = [(firsts[i - 1][0], first) for i, (_, first) in enumerate(firsts)]
    ends = F.broadcast(spark.createDataFrame(before, "end_of int, rank double"))
    copies = rows.join(ends, "rank").select(F.col("end_of").alias("part"), F.lit(False).alias("own"), "id", "text")
    owned = rows.select("part", F.lit(True).alias("own"), "id", "text")
    return owned.union(copies).repartitionById(n, F.col("part")).sortWithinPartitions("part", F.desc("own"), "id", "text")


def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids of documents of a partition of `in_order`, and their texts with that of the next one at the end."""
    last: list[tuple] = []
    for batch in batches:
        rows = last + list(zip(*(batch.column(c).to_pylist() for c in ("part", "own", "id", "text"))))
        last = rows[-1:]
        ids, texts = [], []
        for (part, own, doc, text), (next_part, _, _, following) in zip(rows, rows[1:]):
            if own and part == next_part:
                ids.append(doc)
                texts += [text, following] if not texts else [following]
            elif ids:
                yield ids, texts
                ids, texts = [], []
        if ids:
            yield ids, texts


def compare_in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next, node).

    `edited` is the text whose last quarter of characters is replaced by the beginning of the next document's text,
    in the order of ids (nulls first); the first document comes next after the last. `node` is as by `node_of`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in with_next(batches):
            edits = [edited(a, b) for a, b in zip(texts, texts[1:])]
            of = signatures(pa.array(texts, pa.string()))
            of_edits = signatures(pa.array(edits, pa.string()))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array(edits, pa.string()),
                pa.array(to_text(of[:-1])), pa.array(to_text(of_edits)), pa.array(likeness(of[:-1], of_edits)),
                pa.array(likeness(of[:-1], of[1:])), pa.array([int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "big", signed=True)
                                                               for t in texts[:-1]], pa.int64())],
                ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "node"])

    kind = ("id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double, node bigint")
    rows = in_order(docs.withColumn(doc_id, F.col(doc_id).cast("bigint")), doc_id, text)
    return rows.mapInArrow(run, kind).withColumnRenamed("id", doc_id)


def fingerprints(docs: DataFrame, text: str = "text", fingerprint: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each text."""
    return add_columns(docs, text, f"`{fingerprint}` string", lambda column: [pa.array(to_text(signatures(column)))])


def node_of(text: Column) -> Column:
    """The first 64 bits of the SHA-256 of a text; null counts as empty."""
    return F.conv(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 16), 16, -10).cast("bigint")


def band_values(signature: np.ndarray) -> np.ndarray:
    """A number for each text and band: equal where a band has the same values."""
    packed = np.ascontiguousarray(signature.astype("<u2")).view("<u8")  # ROWS values of 16 bits
    return mix(packed + np.arange(SIZE // ROWS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)


def distinct_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, text) of a task, each node once."""
    seen: set[int] = set()
    for batch in batches:
        nodes = batch.column("node").to_pylist()
        new = [i for i, node in enumerate(nodes) if node not in seen and not seen.add(node)]
        if new:
            yield batch.take(pa.array(new))


def groups(rows: DataFrame) -> DataFrame:
    """Rows (band, node) from rows (node, text): the texts of every band's group that has several."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in distinct_nodes(batches):
            bands = band_values(signatures(batch.column("text")))
            nodes = np.repeat(batch.column("node").to_numpy(), bands.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(signed(bands.ravel())), pa.array(nodes)], ["band", "node"])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, nodes, shared = np.zeros(0, np.int64), np.zeros(0, np.int64), False  # the last row, and if one before shares its band
        for batch in batches:
            bands, nodes = np.append(bands, batch.column(0).to_numpy()), np.append(nodes, batch.column(1).to_numpy())
            new = np.append(True, (bands[1:] != bands[:-1]) | (nodes[1:] != nodes[:-1]))[:len(bands)]
            bands, nodes = bands[new], nodes[new]
            same = bands[1:] == bands[:-1]
            kept = np.append(shared, same) | np.append(same, False)
            if len(bands):
                yield pa.RecordBatch.from_arrays([pa.array(c[:-1][kept[:-1]]) for c in (bands, nodes)], ["band", "node"])
                bands, nodes, shared = bands[-1:], nodes[-1:], bool(kept[-1])
        if shared:
            yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(nodes)], ["band", "node"])

    exploded = rows.mapInArrow(explode, "band bigint, node bigint").repartition("band").sortWithinPartitions("band", "node")
    return exploded.mapInArrow(several, "band bigint, node bigint")


class NodeSegment:
    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.node, self.value = arrays["node"], arrays.get("value")


def look_up(level: Level, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes a level has, and their values if it has any."""
    order = np.argsort(nodes)
    asked, known, values = nodes[order], np.zeros(len(nodes), bool), np.zeros(len(nodes), np.int64)
    for segment, _, part in level.parts(asked, np.zeros(len(asked), np.int64)):
        at = np.minimum(np.searchsorted(segment.node, asked[part]), len(segment.node) - 1)
        known[order[part]] = segment.node[at] == asked[part]
        if segment.value is not None:
            values[order[part]] = segment.value[at]
    return known, values


def shelve(rows: DataFrame, wanted: list[tuple], folder: str) -> DataFrame:
    """Write signatures and shingles of the texts whose nodes are in the segments `wanted`, from rows (node, text), to
    files below `folder`; rows (node, file, rank) say where. Tasks write what they read, so no text is shuffled."""
    sent = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, part, files, held, size = Level(sent.value, NodeSegment), TaskContext.get().partitionId(), 0, [], 0

        def write() -> pa.RecordBatch:
            nodes, signature, keys, counts = (np.concatenate(c) for c in zip(*held))
            first = np.concatenate([[0], np.cumsum(counts)])
            keys |= np.repeat(np.arange(len(nodes), dtype=np.uint64), counts) << np.uint64(BITS)
            file = part << 20 | files
            write_arrays(folder, f"{file:012d}", {"signature": signature.ravel(), "first": first, **EliasFano.encode(keys)})
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.full(len(nodes), file)), pa.array(np.arange(len(nodes)))], ["node", "file", "rank"])

        for batch in distinct_nodes(batches):
            known, _ = look_up(level, batch.column("node").to_numpy())
            if not known.any():
                continue
            batch = batch.filter(pa.array(known))
            hashes, first = shingles(batch.column("text"))
            text = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
            keys = np.unique(text << np.uint64(BITS) | hashes >> np.uint64(64 - BITS))
            counts = np.bincount((keys >> np.uint64(BITS)).astype(np.int64), minlength=len(first) - 1)
            held.append((batch.column("node").to_numpy(), least_values(hashes, first), keys & np.uint64((1 << BITS) - 1), counts))
            size += len(keys) + batch.num_rows
            if size >= FILE_SIZE:
                yield write()
                files, held, size = files + 1, [], 0
        if held:
            yield write()

    return rows.mapInArrow(run, "node bigint, file bigint, rank bigint")


class Shelf:
    """The files of `shelve`, opened where they are first needed."""

    def __init__(self, folder: str) -> None:
        self.folder, self.open = folder, {}

    def file(self, number: int) -> tuple[np.ndarray, np.ndarray, EliasFano]:
        if number not in self.open:
            arrays = read_arrays(f"{self.folder}/{number:012d}")
            self.open[number] = arrays["signature"].reshape(-1, SIZE), arrays["first"], EliasFano.of(arrays)
        return self.open[number]

    def signatures(self, files: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        out = np.zeros((len(files), SIZE), np.uint16)
        for number in np.unique(files):
            at = np.flatnonzero(files == number)
            out[at] = self.file(int(number))[0][ranks[at]]
        return out

    def shingles(self, number: int, rank: int) -> np.ndarray:
        """The set of a text's shingles, as `BITS` bits of their hashes."""
        _, first, keys = self.file(number)
        return keys.get(np.arange(first[rank], first[rank + 1])) & np.uint64((1 << BITS) - 1)


class Sets:
    """Several sets, compared many at a time."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.size = np.array([len(s) for s in sets])
        self.first = np.cumsum(self.size) - self.size
        different, self.of = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(different), bool)

    def similarity(self, one: int, others: np.ndarray) -> np.ndarray:
        """Jaccard similarity; of two empty sets it is 1."""
        own = self.of[self.first[one]:self.first[one] + self.size[one]]
        self.mark[own] = True
        size = self.size[others]
        end = np.cumsum(size)
        found = self.mark[self.of[np.repeat(self.first[others] - (end - size), size) + np.arange(size.sum())]]
        self.mark[own] = False
        upto = np.concatenate([[0], np.cumsum(found)])
        both = upto[end] - upto[end - size]
        either = self.size[one] + size - both
        return np.where(either, both / np.maximum(either, 1), 1.0)


def two_bands(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return mix(one * np.uint64(0x9E3779B97F4A7C15) + other)


def group_of(a: np.ndarray, b: np.ndarray, split: bool) -> np.ndarray:
    """The one group in which pairs of texts with these bands are compared: that of the first band they share, or where
    groups are split of the first two. A pair that has none gets any number."""
    same, row = a == b, np.arange(len(a))
    at = same.argmax(axis=1)
    first = np.broadcast_to(a, same.shape)[row, at] if len(row) else np.zeros(0, np.uint64)
    if not split:
        return first
    same[row, at] = False
    at = same.argmax(axis=1)
    return np.where(same[row, at], two_bands(first, b[row, at]), ~first)


class Linker:
    """Links similar texts of the groups of a task; `texts` are numbers of the different nodes.

    A pair is passed over if links found before connect its texts, so the links of a task are a forest.
    """

    def __init__(self, shelf: Shelf, file: np.ndarray, rank: np.ndarray, similarity: float, split: bool) -> None:
        self.shelf, self.file, self.rank, self.similarity, self.split = shelf, file, rank, similarity, split
        self.signature = shelf.signatures(file, rank)
        self.bands = band_values(self.signature)
        self.above = list(range(len(file)))
        self.links: list[tuple[int, int, float]] = []

    def root(self, text: int) -> int:
        while self.above[text] != text:
            self.above[text] = text = self.above[self.above[text]]
        return text

    def link(self, a: int, b: int, similarity: float) -> None:
        self.above[self.root(a)] = self.root(b)
        self.links.append((a, b, similarity))

    def shingles(self, text: int) -> np.ndarray:
        return self.shelf.shingles(int(self.file[text]), int(self.rank[text]))

    def likeness(self, a, b) -> np.ndarray:
        return (self.signature[a] == self.signature[b]).sum(axis=1)

    def pairs(self, a: np.ndarray, b: np.ndarray, group: np.ndarray) -> None:
        """Compare the pairs of small groups."""
        at, like = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(a), PAIRS):
            x, y = a[i:i + PAIRS], b[i:i + PAIRS]
            own = np.flatnonzero(group_of(self.bands[x], self.bands[y], self.split) == group[i:i + PAIRS])
            count = self.likeness(x[own], y[own])
            likely = count >= LIKELY * SIZE
            at.append(i + own[likely])
            like.append(count[likely])
        at = np.concatenate(at)[np.argsort(-np.concatenate(like), kind="stable")]
        for x, y in zip(a[at].tolist(), b[at].tolist()):
            if self.root(x) != self.root(y):
                found = jaccard(self.shingles(x), self.shingles(y))
                if found >= self.similarity:
                    self.link(x, y, found)

    def roots(self, texts: np.ndarray) -> np.ndarray:
        return np.array([self.root(t) for t in texts.tolist()])

    def left(self, texts: np.ndarray) -> int:
        """How many texts are outside the largest connected part."""
        return len(texts) - int(np.unique(self.roots(texts), return_counts=True)[1].max())

    def hub(self, texts: np.ndarray, one: int) -> None:
        """Compare one text of a group with all others."""
        others = texts[self.roots(texts) != self.root(one)]
        others = others[self.likeness(one, others) >= LIKELY * SIZE]
        for i in range(0, len(others), BLOCK_TEXTS):
            block = others[i:i + BLOCK_TEXTS]
            sets = Sets([self.shingles(t) for t in (one, *block)])
            for text, found in zip(block.tolist(), sets.similarity(0, np.arange(1, len(block) + 1)).tolist()):
                if found >= self.similarity and self.root(text) != self.root(one):
                    self.link(one, text, found)

    def all(self, texts: np.ndarray, group: int) -> None:
        """Compare all texts of a group that are not linked, each with all others that may be similar."""
        roots = self.roots(texts)
        kinds, counts = np.unique(roots, return_counts=True)
        outside = np.flatnonzero(roots != kinds[counts.argmax()])  # one text of every pair to be compared is among these
        if not len(outside):
            return
        sets, done = None, np.zeros(len(texts), bool)
        for one in outside.tolist():
            done[one] = True
            others = np.flatnonzero(~done & (roots != roots[one]))
            others = others[self.likeness(texts[one], texts[others]) >= LIKELY * SIZE]
            own = self.bands[texts[one]][None]
            others = others[group_of(np.broadcast_to(own, (len(others), own.shape[1])), self.bands[texts[others]], self.split) == group]
            if not len(others):
                continue
            sets = sets or Sets([self.shingles(t) for t in texts])
            found = sets.similarity(one, others)
            near = np.flatnonzero(found >= self.similarity)
            if len(near):
                joined, first = np.unique(roots[others[near]], return_index=True)
                for at in near[first]:
                    self.link(int(texts[one]), int(texts[others[at]]), float(found[at]))
                roots[np.isin(roots, joined)] = roots[one]

    def parts(self, texts: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Groups, texts and roots: a group split by each further band, as far as there are several roots in a part."""
        bands = self.bands[texts]
        same = bands == np.uint64(group)
        at, band = np.nonzero(np.cumsum(same, axis=1) - same)
        part = two_bands(np.uint64(group), bands[at, band])
        root = self.roots(texts)[at]
        order = np.lexsort((root, part))
        at, part, root = at[order], part[order], root[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)])
        size = np.diff(np.append(first, len(part)))
        kept = np.repeat(root[first] != root[first + size - 1], size)
        return part[kept], texts[at[kept]], root[kept]


def links(rows: DataFrame, folder: str, similarity: float, hot: int | None = None) -> DataFrame:
    """Rows (a, b, similarity, band, file, rank) from rows (band, node, root, file, rank): links of similar texts, without
    band, that connect what all similar pairs of each group connect; then, of groups where more is left to compare than
    `hot` texts with as many, rows of their parts, with the node as a and its root as b. Without `hot` groups are such parts.

    Texts are compared in the task of their group, so a row is made for each link found and not for each pair compared.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        band, node, root, file, rank = (whole[c].to_numpy() for c in ("band", "node", "root", "file", "rank"))
        nodes, example, text = np.unique(node, return_index=True, return_inverse=True)
        linker = Linker(Shelf(folder), file[example], rank[example], similarity, hot is None)
        _, least, kind = np.unique(root, return_index=True, return_inverse=True)
        for one, other in zip(text[least[kind]].tolist(), text.tolist()):  # texts of one root are linked already
            linker.above[linker.root(other)] = linker.root(one)
        first = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
        size = np.diff(np.append(first, len(band)))
        group = band.view(np.uint64)
        a, b, of = [], [], []
        for n in range(2, SMALL + 1):
            at = first[size == n]
            for i, j in zip(*np.triu_indices(n, 1)):
                a.append(text[at + i])
                b.append(text[at + j])
                of.append(group[at])
        linker.pairs(*(np.concatenate(c) for c in (a, b, of)))
        split = []
        for at, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
            texts = text[at:at + n]
            linker.hub(texts, int(texts[0]))
            # Few are left of a large group of near copies, however few of them the first is like.
            for one in texts[1:HUBS].tolist() if hot is not None else ():
                if linker.left(texts) * n > hot * hot:
                    linker.hub(texts, one)
            if hot is None or linker.left(texts) * n <= hot * hot:
                linker.all(texts, int(group[at]))
            else:
                split.append(linker.parts(texts, int(group[at])))
        if linker.links:
            x, y, found = (np.array(c) for c in zip(*linker.links))
            ends = nodes[x], nodes[y]
            none = pa.nulls(len(x), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends)), pa.array(found, pa.float64()),
                                              none, none, none], LINK)
        for part, texts, roots in split:
            yield pa.RecordBatch.from_arrays([
                pa.array(nodes[texts]), pa.array(nodes[roots]), pa.nulls(len(part), pa.float64()), pa.array(signed(part)),
                pa.array(file[example][texts]), pa.array(rank[example][texts])], LINK)

    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))
    ordered = rows.repartition(n, "band").sortWithinPartitions("band", "node")
    return saved(ordered.mapInArrow(run, "a bigint, b bigint, similarity double, band bigint, file bigint, rank bigint"), "links")


def near_texts(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY, hot: int = HOT) -> DataFrame:
    """Links (a, b, similarity) of different texts, a and b as by `node_of`, a below b.

    Reachable by them is what is reachable by all similar pairs that share a band (two where a group is hot).
    """
    rows = docs.select(node_of(F.col(text)).alias("node"), F.coalesce(text, F.lit("")).alias("text"))
    grouped = saved(groups(rows), "groups")
    folder = work_dir(docs.sparkSession, "shingles")
    wanted = write_level(grouped.select("node").distinct(), ["node"], folder, "wanted", lambda c: {"node": c["node"]})
    places = saved(shelve(rows, wanted, folder), "places").groupBy("node").agg(F.min(F.struct("file", "rank")).alias("at"))
    placed = join_unique(grouped, places, "node", "inner").select("band", "node", F.col("node").alias("root"), "at.file", "at.rank")
    found = links(saved(placed, "placed"), folder, similarity, hot)
    parts = found.where("band is not null").select("band", F.col("a").alias("node"), F.col("b").alias("root"), "file", "rank")
    return found.union(links(parts, folder, similarity)).where("band is null").select("a", "b", "similarity").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    similarity: float = SIMILARITY, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Near-duplicates among different texts: pairs (a, b, similarity), and membership (doc_id, key) of all documents.

    Keys are SHA-256 of the texts, so copies are one key. The similarity is that of the sets of shingles, exactly.
    """
    pairs = near_texts(docs, text, similarity, hot)
    key = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    keys = docs.select(node_of(F.col(text)).alias("node"), key.alias("key")).groupBy("node").agg(F.first("key").alias("key"))
    for end in ("a", "b"):
        pairs = join_unique(pairs, keys.select(F.col("node").alias(end), F.col("key").alias(f"key_{end}")), end, "inner")
    pairs = pairs.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"), "similarity")
    return pairs, docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
            hot: int = HOT) -> DataFrame:
    """Rows (node, class_id, class_node) for the texts of classes of more than one document: the smallest id reachable
    over copies and verified pairs (nulls last), and the text that has it, the smallest node if several have.
    """
    first = F.min(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("node").alias("node")))
    texts = docs.select(doc_id, node_of(F.col(text)).alias("node")).groupBy("node").agg(first.alias("first"), F.count("*").alias("n"))
    roots = components(near_texts(docs, text, similarity, hot))
    texts = texts.join(roots, "node", "left").where("n > 1 or root is not null")
    texts = saved(texts.withColumn("root", F.coalesce("root", "node")), "members")
    least = texts.groupBy("root").agg(F.min("first").alias("least"))
    named = join_unique(texts.select("node", "root"), least, "root", "inner")
    return saved(named.select("node", F.col("least.id").alias("class_id"), F.col("least.node").alias("class_node")), "classes")


def name_classes(docs: DataFrame, found: DataFrame, node: str = "node", class_id: str = "class_id") -> DataFrame:
    """Add the class ids (long) of `classes` to rows with nodes, null for those of no class of several documents.

    They are looked up in sorted segments in the shared folder, so that wide rows need not be shuffled for a join.
    """
    folder = work_dir(docs.sparkSession, "class_ids")
    known = found.where("class_id is not null").select("node", F.col("class_id").cast("bigint").alias("class_id"))
    segments = write_level(known, ["node"], folder, "class_ids", lambda c: {"node": c["node"], "value": c["class_id"]})
    sent = docs.sparkSession.sparkContext.broadcast(segments)

    def run(column: pa.Array) -> list[pa.Array]:
        known, ids = look_up(Level(sent.value, NodeSegment), column.to_numpy())
        return [pa.array(ids, mask=~known)]

    return add_columns(docs, node, f"`{class_id}` bigint", run, LOOKED_UP)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
             hot: int = HOT) -> DataFrame:
    """One row of each class of copies and near-duplicates, that of the smallest id (nulls last), all columns as they are.

    Rows are kept or not by id and text, so another text under a dropped row's id stays; of equal ids and texts one stays.
    """
    node, least, first = (free_name(docs, name) for name in ("_node", "_class_id", "_class_node"))
    found = classes(docs, doc_id, text, similarity, hot).toDF(node, least, first)
    rows = join_unique(docs.withColumn(node, node_of(F.col(text))), found, node, "left")
    alone = rows.where(F.col(first).isNull())
    kept = rows.where((F.col(first) == F.col(node)) & F.col(least).eqNullSafe(F.col(doc_id))).dropDuplicates([doc_id, node])
    return alone.select(docs.columns).union(kept.select(docs.columns))


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Similarity of two sets of shingles; of two empty ones it is 1."""
    x, y = np.unique(x), np.unique(y)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0
