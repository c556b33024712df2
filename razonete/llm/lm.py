"""Language-model scores from an n-gram trie in Elias-Fano levels.

Tokens are words (lower-cased A-Z, ended by ASCII white space) and one end after
the words of each text. Probabilities of single tokens are
(c + 0.1) / (N + 0.1 (V + 1)). Orders two and three interpolate with the order
below by absolute discounting: an n-gram keeps its count less `DISCOUNT`, and
what a context has left goes to the order below. N-grams are counted over all
training texts and all kept (`fit` can leave those out that are rarer than
`least`; their share goes to the order below, so that each context still sums to one).

Level by level, Spark counts, and tasks write the trie's segments:

- words: hashes in order beside counts; a word's rank is its id;
- n-grams: for each context the place of its first successor, as a monotone
  Elias-Fano sequence of pointers; the successors relative to their context
  (context's rank in the segment times V, plus word id), as another; quantised
  log probabilities and counts;
- contexts: the ids of nodes with successors, and their quantised back-off.

A lookup searches the successor of the word's relative key; the index found is
the node, the context of the next order. All successors of a segment's contexts
are listed by their pointers. An n-gram is counted only if its words, and for order three its pairs, are kept, as
it cannot be more frequent than they are. Logarithms are in steps of 1/2048.

Texts are read once for each order and once for scoring. Counts of n-grams are
shuffled once, to the segment they belong to; logarithms and contexts follow from
the segments. Nothing of a level goes through the driver but one line for each
segment, with the contexts of more tokens than a segment.

Null and empty texts have the end as their only token. Words are told apart by
64-bit hashes. Repeated rows count each time, equal texts have equal scores.
Without training texts every token has probability 1 (N = V = 0).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from razonete.llm.common import LOWER, NOT_SPACE, add_columns, find_words, larger, saved, signed, word_hashes
from razonete.llm.trie import EliasFano, Level, pack_counts, read_arrays, unique_keys, unpack_counts, write_arrays
from razonete.session import work_dir

ORDER = 3
ADDED = 0.1
DISCOUNT = 0.75
LEAST = 1
STEPS = 2048
END = 0  # the hash of the end
SEGMENT_ROWS = 1 << 21
TASK_ROWS = 1 << 20
BATCH_ROWS = 768  # lookups of many tokens at once find more of them equal or near

# What a task tells of a segment of n-grams.
SEGMENT = pa.schema([
    *((name, pa.int64()) for name in ("part", "major", "minor", "n")), ("place", pa.string()), ("last", pa.int64()),
    ("first_kept", pa.float64()), ("last_kept", pa.float64()), ("often", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


@dataclass
class Tokens:
    """Hashes of the tokens of a batch; text t has the tokens first[t] to first[t + 1] - 1, the last one its end."""

    hash: np.ndarray
    first: np.ndarray

    @cached_property
    def place(self) -> np.ndarray:
        """How many tokens each has before it in its text."""
        return np.arange(len(self.hash)) - np.repeat(self.first[:-1], np.diff(self.first))

    def context(self, order: int, nodes: np.ndarray) -> np.ndarray:
        """The node before each token, which is its context in n-grams of the order; -1 if its text has too few tokens there."""
        return np.where(self.place >= order - 1, np.roll(nodes, 1), -1)


def tokens(column: pa.Array) -> Tokens:
    words = find_words(column, NOT_SPACE, LOWER)
    first = words.first + np.arange(len(words.first))
    hashes = np.full(first[-1], END, np.int64)
    hashes[np.arange(len(words.start)) + words.texts()] = signed(word_hashes(words))
    return Tokens(hashes, first)


def to_codes(logs: np.ndarray) -> np.ndarray:
    return np.rint(-STEPS * logs).astype(np.uint16)


def from_codes(codes: np.ndarray) -> np.ndarray:
    return codes / -STEPS


class WordSegment:
    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.hash, self.count = arrays["hash"], arrays["count"]


class GramSegment:
    """Successors of a range of contexts."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.context, self.contexts, self.words = map(int, arrays["range"])
        self.pointers = EliasFano.of(arrays, "pointer_")
        self.keys = EliasFano.of(arrays, "key_")
        self.log, self.count = arrays.get("log"), arrays["count"]  # logarithms are added when all is counted

    @staticmethod
    def arrays(context: np.ndarray, word: np.ndarray, words: int, count: np.ndarray) -> dict[str, np.ndarray]:
        rank = context - context[0]
        contexts = int(rank[-1]) + 1
        pointers = EliasFano.encode(np.cumsum(np.bincount(rank + 1)))
        keys = EliasFano.encode(rank.astype(np.uint64) * np.uint64(words) + word.astype(np.uint64))
        return {"range": np.array([context[0], contexts, words], np.int64), **{f"pointer_{k}": v for k, v in pointers.items()},
                **{f"key_{k}": v for k, v in keys.items()}, "count": count}

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Index of each word among the successors of its context, or -1."""
        rank = (context - self.context).astype(np.uint64)
        index, same = self.keys.successor(rank * np.uint64(self.words) + word.astype(np.uint64))
        return np.where(same, index, -1)

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """Contexts and words of all n-grams."""
        rank = np.repeat(np.arange(self.contexts), np.diff(self.pointers.all().astype(np.int64)))
        return rank + self.context, self.keys.all().astype(np.int64) - rank * self.words

    def word(self, index: np.ndarray) -> np.ndarray:
        return (self.keys.get(index) % np.uint64(self.words)).astype(np.int64)


class ContextSegment:
    """Nodes with successors, counted from the first one."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.first, self.ids, self.log = int(arrays["first"][0]), EliasFano.of(arrays, "id_"), arrays["log"]

    def logs(self, ids: np.ndarray) -> np.ndarray:
        at, same = self.ids.successor((ids - self.first).astype(np.uint64))
        return np.where(same, from_codes(self.log[np.minimum(at, len(self.log) - 1)]), 0.0)


@dataclass
class Model:
    """Sizes, and segments of the words and of each order from two on. Levels are opened once in a process."""

    total: int
    words: int
    word_segments: list[tuple]
    gram_segments: list[list[tuple]] = field(default_factory=list)
    context_segments: list[list[tuple]] = field(default_factory=list)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_levels"}

    def level(self, kind: str, order: int = 0) -> Level:
        levels = self.__dict__.setdefault("_levels", {})
        if (kind, order) not in levels:
            if kind == "word":
                levels[kind, order] = Level(self.word_segments, WordSegment)
            elif kind == "gram":
                levels[kind, order] = Level(self.gram_segments[order - 2], GramSegment)
            else:
                levels[kind, order] = Level(self.context_segments[order - 2], ContextSegment)
        return levels[kind, order]

    def find_words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids (-1 if unknown) and counts of the different words, by hash, and the number of each word among them."""
        first, number = unique_keys(hashes)
        known = hashes[first]
        ids, counts = np.full(len(known), -1, np.int64), np.zeros(len(known), np.int64)
        for segment, before, part in self.level("word").parts(known, np.zeros(len(known), np.int64)):
            at = np.minimum(np.searchsorted(segment.hash, known[part]), len(segment.hash) - 1)
            same = segment.hash[at] == known[part]
            ids[part] = np.where(same, at + before, -1)
            counts[part] = np.where(same, segment.count[at], 0)
        return ids, counts, number

    def counts_of(self, order: int, nodes: np.ndarray) -> np.ndarray:
        """Counts of nodes of an order, in order of their ids."""
        out = np.zeros(len(nodes), np.int64)
        for segment, at, part in self.level("gram" if order > 1 else "word", order if order > 1 else 0).rows(nodes):
            out[part] = segment.count[at]
        return out

    def last_words(self, nodes: np.ndarray) -> np.ndarray:
        """The last word of nodes of order two, in order of their ids."""
        out = np.zeros(len(nodes), np.int64)
        for segment, at, part in self.level("gram", 2).rows(nodes):
            out[part] = segment.word(at)
        return out

    def find_grams(self, order: int, context: np.ndarray, word: np.ndarray, key: np.ndarray | None = None,
                   logs: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes (-1 if not kept) of words after contexts, which are nodes of the order below, with their log
        probabilities (0 if not `logs`), and the number of each among the different ones by context and word.

        `key` has smaller numbers, not negative, that tell known contexts and words apart in the same order.
        """
        nodes, direct, number = np.full(len(context), -1, np.int64), np.zeros(len(context)), np.full(len(context), -1, np.int64)
        asked = np.flatnonzero((context >= 0) & (word >= 0))
        if not len(asked):
            return nodes, direct, number
        first, back = unique_keys(context[asked] * self.words + word[asked] if key is None else key[asked])
        major, minor = context[asked[first]], word[asked[first]]
        found, codes = np.full(len(major), -1, np.int64), np.zeros(len(major), np.uint16)
        for segment, before, part in self.level("gram", order).parts(major, minor):
            at = segment.find(major[part], minor[part])
            found[part] = np.where(at >= 0, at + before, -1)
            if logs:
                codes[part] = np.where(at >= 0, segment.log[np.maximum(at, 0)], 0)
        nodes[asked], number[asked] = found[back], back
        if logs:
            direct[asked] = from_codes(codes)[back]
        return nodes, direct, number

    def left_of(self, order: int, contexts: np.ndarray) -> np.ndarray:
        """Log of what contexts leave to the order below: 0 for those without successors of this order."""
        first, back = unique_keys(contexts)
        known = contexts[first]
        logs = np.zeros(len(known))
        if order - 2 < len(self.context_segments):
            for segment, _, part in self.level("context", order).parts(known, np.zeros(len(known), np.int64)):
                logs[part] = segment.logs(known[part])
        return logs[back]

    def single(self, counts: np.ndarray) -> np.ndarray:
        """Log probabilities of single tokens, from their counts."""
        if not self.total:
            return np.zeros(len(counts))
        return np.log10((counts + ADDED) / (self.total + ADDED * (self.words + 1)))

    def log_probabilities(self, of: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: its count, and log10 probabilities by itself and after the tokens before it."""
        ids, counts, rank = self.find_words(of.hash)
        alone = self.single(counts)[rank]
        ids, counts = ids[rank], counts[rank]
        log, nodes, number = alone, ids, rank
        for order in range(2, len(self.gram_segments) + 2):
            context = of.context(order, nodes)
            nodes, direct, number = self.find_grams(order, context, ids, np.roll(number, 1) * len(rank) + rank)
            log = np.where(nodes >= 0, direct, log)
            missed = np.flatnonzero((nodes < 0) & (context >= 0))  # only these ask what their contexts leave
            log[missed] += self.left_of(order, context[missed])
        return counts, alone, log


def summed(batches: Iterator[tuple[np.ndarray, np.ndarray]], words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) as numbers a * words + b, in order, and their counts, added up within a task as far as `TASK_ROWS` allow;
    b is below `words`."""
    held: list[np.ndarray] = []
    for a, b in batches:
        held.append(a * words + b)
        if sum(map(len, held)) >= TASK_ROWS:
            yield np.unique(np.concatenate(held), return_counts=True)
            held = []
    if held:
        yield np.unique(np.concatenate(held), return_counts=True)


def count_pairs(docs: DataFrame, text: str, pairs: Callable[[Tokens], tuple[np.ndarray, np.ndarray]], words: int,
                least: int, name: str) -> DataFrame:
    """A saved table (a, b, n) of the pairs that texts give at least so often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair, n in summed((pairs(tokens(batch.column(0))) for batch in larger(batches, BATCH_ROWS)), words):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (pair // words, pair % words, n)], ["a", "b", "n"])

    counted = docs.select(text).mapInArrow(run, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return saved(counted.where(F.col("n") >= least), name)


def write_level(rows: DataFrame, keys: list[str], folder: str, name: str,
                arrays: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]) -> list[tuple]:
    """Write sorted ranges of the rows as segments: (first key, first minor key, rows before, place) of each."""
    n = max(1, -(-rows.count() // SEGMENT_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches))
        if whole.num_rows:
            columns = {c: whole[c].to_numpy() for c in whole.column_names}
            part = TaskContext.get().partitionId()
            place = write_arrays(folder, f"{name}-{part:06d}", arrays(columns))
            first = [int(columns[k][0]) for k in keys] + [0]
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "major": first[0], "minor": first[1], "n": whole.num_rows, "place": place}])

    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    written = ordered.mapInArrow(run, "part bigint, major bigint, minor bigint, n bigint, place string").collect()
    segments, before = [], 0
    for row in sorted(written):
        segments.append((row["major"], row["minor"], before, row["place"]))
        before += row["n"]
    return segments


def segments_for(spark: SparkSession, tokens: int) -> int:
    return max(1, -(-tokens // SEGMENT_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))


def fit(docs: DataFrame, text: str = "text", order: int = ORDER, least: int = LEAST) -> Model:
    """Count the texts and write their trie below the shared work folder."""
    if order not in (1, 2, 3):
        raise ValueError("orders up to three are kept")
    folder = work_dir(docs.sparkSession, "trie")
    counted = count_pairs(docs, text, lambda of: (of.hash, np.zeros(len(of.hash), np.int64)), 1, 1, "words")
    total, words = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    model = Model(total, words, write_level(
        counted.select("a", "n"), ["a"], folder, "words", lambda c: {"hash": c["a"], "count": c["n"]}))
    often = counted.where(F.col("n") > total // segments_for(docs.sparkSession, total)).select("a", "n").orderBy("a").collect()
    ids = model.find_words(np.array([row["a"] for row in often], np.int64))[0]  # by hash, as they are
    hot, nodes = [(int(i), row["n"]) for i, row in zip(ids, often)], words
    for level in range(2, order + 1):
        hot, nodes = add_order(model, docs, text, level, least, folder, hot, nodes)
    return model


def part_of(a: np.ndarray, b: np.ndarray, hot: list[tuple[int, int]], nodes: int, words: int, total: int, parts: int) -> np.ndarray:
    """The part of each pair of a context and a word, in the order of pairs; parts have about equal shares of the tokens.

    A context of more tokens than a part, in `hot` with its count, is spread by words; others share what is left.
    """
    ids, counts = np.array([i for i, _ in hot], np.int64), np.array([n for _, n in hot], np.int64)
    before = np.concatenate([[0], np.cumsum(counts)])
    at = np.searchsorted(ids, a)
    own = np.append(counts, 0)[at] * (np.append(ids, -1)[at] == a)
    place = before[at] + (total - before[-1]) * (a / nodes) + own * (b / words)
    return np.minimum(place * (parts / total), parts - 1).astype(np.int32)


def add_order(model: Model, docs: DataFrame, text: str, order: int, least: int, folder: str,
              hot: list[tuple[int, int]], nodes: int) -> tuple[list[tuple[int, int]], int]:
    """Count the n-grams of the next order under the nodes there are, and write their level.

    Counts go straight to the part of the level they belong to, packed in blocks, one for each part from so many tokens
    of a task; there they are added up and written as a segment;
    logarithms and contexts follow from the segments, as a context of very many tokens may have several. `hot` and
    `nodes` are the frequent contexts and the number of all; those of the next order are returned.
    """
    spark = docs.sparkSession
    below = spark.sparkContext.broadcast(model)
    total, words = model.total, model.words
    parts = segments_for(spark, total)
    if not nodes:
        model.context_segments.append([])
        model.gram_segments.append([])
        return [], 0

    def pairs(of: Tokens) -> tuple[np.ndarray, np.ndarray]:
        # An n-gram is as rare as its rarest part, so parts that are not kept need not be counted with others.
        model = below.value
        ids, counts, rank = model.find_words(of.hash)
        ids, kept = ids[rank], (counts >= least)[rank]
        context = of.context(2, np.where(kept, ids, -1))
        if order == 3:
            nodes, _, _ = model.find_grams(2, context, ids, np.roll(rank, 1) * len(rank) + rank, logs=False)
            kept = nodes >= 0
            context = of.context(3, nodes)
        kept &= context >= 0
        return context[kept], ids[kept]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair, n in summed((pairs(tokens(b.column(0))) for b in larger(batches, BATCH_ROWS)), words):
            if len(pair):
                part = part_of(pair // words, pair % words, hot, nodes, words, total, parts)
                first = np.flatnonzero(np.diff(part, prepend=-1))
                yield pa.RecordBatch.from_arrays([pa.array(part[first]), *pack_counts(pair, n, first)], ["part", "pairs", "counts"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        part = held[0].column("part")[0].as_py()
        pair, n = unpack_counts(*([block for batch in held for block in batch.column(c).to_pylist()] for c in ("pairs", "counts")))
        del held
        context, word = pair // words, pair % words
        if least > 1:
            context, word, n = context[n >= least], word[n >= least], n[n >= least]
        if len(n):
            often = np.flatnonzero(n > total // parts)
            arrays = GramSegment.arrays(context, word, words, n.astype(np.min_scalar_type(n.max())))
            ends = [(int(c), float((n[context == c] - DISCOUNT).sum())) for c in (context[0], context[-1])]
            yield pa.RecordBatch.from_pylist([{
                "part": part, "major": int(context[0]), "minor": int(word[0]), "n": len(n),
                "place": write_arrays(folder, f"grams{order}-{part:06d}", arrays), "last": ends[1][0],
                "first_kept": ends[0][1], "last_kept": ends[1][1], "often": often.tolist(), "counts": n[often].tolist()}], SEGMENT)

    counted = docs.select(text).mapInArrow(count, "part int, pairs binary, counts binary")
    dealt = counted.repartitionById(parts, F.col("part"))
    written = sorted(dealt.mapInArrow(write, (
        "part bigint, major bigint, minor bigint, n bigint, place string, last bigint, first_kept double, last_kept double, "
        "often array<bigint>, counts array<bigint>")).collect(), key=lambda row: row["part"])  # one row for each segment

    # What a context keeps is added up over its segments; the first of them has it among its contexts.
    kept: dict[int, float] = {}
    for row in written:
        kept[row["major"]] = kept.get(row["major"], 0.0) + row["first_kept"]
        if row["last"] != row["major"]:
            kept[row["last"]] = kept.get(row["last"], 0.0) + row["last_kept"]
    owned = [not i or written[i - 1]["last"] != row["major"] for i, row in enumerate(written)]

    def add_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = below.value
        for task in (row for batch in batches for row in batch.to_pylist()):
            grams = GramSegment(read_arrays(task["place"]))
            context, word = grams.all()
            n = grams.count.astype(np.int64)
            first = np.flatnonzero(np.diff(context, prepend=-1))
            size = np.diff(first, append=len(context))
            contexts, sums = context[first], np.add.reduceat(n - DISCOUNT, first)
            sums[[0, -1]] = task["first_kept"], task["last_kept"]
            seen = model.counts_of(order - 1, contexts)
            left = to_codes(np.log10(1 - sums / seen))
            direct = (n - DISCOUNT) / np.repeat(seen, size)
            missed, log = np.arange(len(n)), np.zeros(len(n))
            if order == 3:
                middle = np.repeat(model.last_words(contexts), size)
                found, log, _ = model.find_grams(2, middle, word)
                missed = np.flatnonzero(found < 0)
                log[missed] = model.left_of(2, middle[missed])
            known, back = np.unique(word[missed], return_inverse=True)
            log[missed] += model.single(model.counts_of(1, known))[back]
            of_context = np.repeat(from_codes(left), size)
            log = to_codes(np.log10(direct + 10 ** (of_context + log)))
            skip = 0 if task["owned"] else 1
            ids = EliasFano.encode(contexts[skip:] - contexts[min(skip, len(contexts) - 1)])
            of_contexts = {"first": contexts[skip:skip + 1], **{f"id_{k}": v for k, v in ids.items()}, "log": left[skip:]}
            yield pa.RecordBatch.from_pylist([{
                "part": task["part"], "first": int(contexts[min(skip, len(contexts) - 1)]), "n": len(contexts) - skip,
                "logs": write_arrays(folder, f"logs{order}-{task['part']:06d}", {"log": log}),
                "contexts": write_arrays(folder, f"contexts{order}-{task['part']:06d}", of_contexts)}])

    tasks = spark.createDataFrame([
        (i, row["part"], row["place"], own, kept[row["major"]], kept[row["last"]]) for i, (row, own) in enumerate(zip(written, owned))],
        "id int, part bigint, place string, owned boolean, first_kept double, last_kept double")
    added = tasks.repartitionById(max(1, len(written)), F.col("id")).mapInArrow(
        add_logs, "part bigint, first bigint, n bigint, logs string, contexts string")
    added = {row["part"]: row for row in added.collect()}  # one row for each segment
    grams, contexts, often, before, contexts_before = [], [], [], 0, 0
    for row in written:
        more = added[row["part"]]
        grams.append((row["major"], row["minor"], before, row["place"], more["logs"]))
        often += [(before + i, n) for i, n in zip(row["often"], row["counts"])]
        before += row["n"]
        if more["n"]:
            contexts.append((more["first"], 0, contexts_before, more["contexts"]))
            contexts_before += more["n"]
    model.context_segments.append(contexts)
    model.gram_segments.append(grams)
    return often, before


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add n_tokens, n_known (in the training texts), base_score and score: log10 probabilities of each text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> list[pa.Array]:
        of = tokens(column)
        counts, alone, log = sent.value.log_probabilities(of)
        sums = [np.add.reduceat(v, of.first[:-1]) if len(column) else v for v in ((counts > 0).astype(np.int64), alone, log)]
        return [pa.array(np.diff(of.first)), *map(pa.array, sums)]

    return add_columns(docs, text, "n_tokens bigint, n_known bigint, base_score double, score double", run, BATCH_ROWS)
