"""Source divergence: how the sources of a language differ in their use of terms, and by which terms.

Terms are runs of letters (A-Z lower-cased; every character beyond ASCII counts
as one). A language keeps its V terms that are in `MIN_DOCUMENTS` of its
documents or more. A group (the documents of one language and source), and a
language as a whole, gives each kept term the share

    p = 1 + floor(10^9 * (count + 2) / (N + 2 V)),

N its count of all kept terms, and two shares differ by
floor((p - q)^2 / (p + q)). All of this is done in 64-bit whole numbers.

- `pairs`: for each group, the differences to each other source of the language,
  summed over all kept terms. A batch of terms is laid out as a matrix with a
  column for each source, so terms that a source lacks count too and nothing is
  joined; a task gives one sum for each pair of sources and block of terms.
- `terms`: the `TOP` terms of a group used more than in the language as a whole
  that differ most, equal ones by their UTF-8. They are found by a dominance
  skyband: a term of a higher or equal count in the group, a lower or equal one
  in the language, and earlier in UTF-8, is never behind. So partitions keep
  what fewer than `TOP` others dominate, whatever the totals turn out to be;
  what they keep is merged by group, again as a skyband, and ranked exactly. Both
  passes read rows sorted by Spark, and hold no more than the skyband.

Counts of terms are added up within a batch before they are shuffled, so a
group of any size arrives as one row for each term and batch. The list of
groups goes to the driver and to all tasks; the result has a row for every two
sources of a language, so it is about the root of the result's size.

Null texts, languages and sources count as empty. A group without terms is
compared like any other; without kept terms all its differences are 0. Repeated
rows count as documents of their own. No rows give none. Words are told apart by
64-bit hashes within a batch, and by their letters from there on.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from razonete.llm.common import LOWER, find_words, larger, saved, spell

MIN_DOCUMENTS = 10
TOP = 10
# Shares are in units of 1 / 1000^STEPS.
STEPS = 3
# Cells of the matrix of terms and sources that a task holds at a time.
CELLS = 1 << 21
# Counts of a language are below this.
LARGEST = 1 << 62

TERM = np.zeros(256, bool)
TERM[97:123] = TERM[128:] = True


def _texts_of(spelled: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The spelled words, without the spaces around them, as an Arrow array."""
    ends = (bounds - 2 * np.arange(len(bounds))).astype(np.int32)
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(ends), pa.py_buffer(spelled[spelled != 32]))


def term_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, term, source, n, docs) from (lang, source, text): occurrences and documents, added up by batch."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in larger(batches, 4096):
            lang, source = (batch.column(c).dictionary_encode() for c in (0, 1))
            sources = max(1, len(source.dictionary))
            group = lang.indices.to_numpy().astype(np.int64) * sources + source.indices.to_numpy()
            words = find_words(batch.column(2), TERM, LOWER)
            number, spelled, bounds = spell(words)
            size, of = max(1, len(bounds) - 1), words.texts()
            key, n = np.unique(group[of] * size + number, return_counts=True)
            once = np.unique(of * size + number)
            # The same keys in the same order, as every one has a document.
            n_docs = np.unique(group[once // size] * size + once % size, return_counts=True)[1]
            yield pa.RecordBatch.from_arrays([
                lang.dictionary.take(pa.array(key // size // sources)), _texts_of(spelled, bounds).take(pa.array(key % size)),
                source.dictionary.take(pa.array(key // size % sources)), pa.array(n), pa.array(n_docs)],
                ["lang", "term", "source", "n", "docs"])

    return docs.select("lang", "source", "text").mapInArrow(count, "lang string, term string, source string, n long, docs long")


def kept_terms(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Rows (lang, term, total, sources): kept terms with their counts in the language and in each source that has them."""
    by_term = term_counts(docs).repartition("lang", "term")  # one shuffle for both steps
    by_source = by_term.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return terms.where(F.col("docs") >= min_documents).drop("docs")


def group_totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows (lang, source, size, lang_size): N + 2 V of each group and of its language."""
    languages = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_n"))
    counts = terms.select("lang", F.inline("sources")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(counts, ["lang", "source"], "left").join(languages, "lang", "left")
    kept = 2 * F.coalesce("kept", F.lit(0))
    return groups.select("lang", "source", (F.coalesce("n", F.lit(0)) + kept).alias("size"),
                         (F.coalesce("lang_n", F.lit(0)) + kept).alias("lang_size"))


def shares(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """p of each count, by long division."""
    whole, rest = np.divmod(count + 2, size)
    for _ in range(STEPS):
        digits, rest = np.divmod(rest * 1000, size)
        whole = whole * 1000 + digits
    return whole + 1


def share(count: str, size: str) -> str:
    """SQL for the same."""
    whole, rest = f"({count} + 2) div {size}", f"({count} + 2) % {size}"
    for _ in range(STEPS):
        whole, rest = f"({whole}) * 1000 + (({rest}) * 1000) div {size}", f"(({rest}) * 1000) % {size}"
    return f"{whole} + 1"


def pair_sums(terms: DataFrame, groups: dict[str, tuple[list[str], list[int]]]) -> DataFrame:
    """Rows (lang, a, b, value) with a < b, from `kept_terms` and the sources and sizes of each language."""
    sent = terms.sparkSession.sparkContext.broadcast(groups)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in larger(batches, 1 << 16):
            for lang in pc.unique(batch.column("lang")).to_pylist():
                names, sizes = sent.value[lang]
                names, sizes = pa.array(names, pa.string()), np.array(sizes, np.int64)
                lists = batch.filter(pc.equal(batch.column("lang"), lang)).column("sources")
                block = max(1, CELLS // len(names))
                for at in range(0, len(lists), block):
                    yield from sums(lang, lists.slice(at, block), names, sizes)

    def sums(lang: str, lists: pa.Array, names: pa.Array, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        entries = lists.flatten()
        counts = np.zeros((len(lists), len(names)), np.int64)
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        counts[row, pc.index_in(entries.field("source"), value_set=names).to_numpy()] = entries.field("n").to_numpy()
        p = np.ascontiguousarray(shares(counts, sizes).T)
        for i in range(len(names) - 1):
            apart = p[i] - p[i + 1:]
            value = (apart * apart // (p[i] + p[i + 1:])).sum(axis=1)
            n = len(value)
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, n), pa.repeat(names[i].as_py(), n), names[i + 1:], pa.array(value)],
                                             ["lang", "a", "b", "value"])

    found = terms.select("lang", "sources").mapInArrow(compare, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


class Dominators:
    """Terms seen so far with their counts in the language, for questions in the order of falling counts in a group.

    A Fenwick tree over the counts in the language: each node has the first `most` terms of its range.
    """

    def __init__(self, most: int) -> None:
        self.most, self.nodes = most, {}

    def enough(self, total: int, term: str) -> bool:
        """Whether `most` terms or more have no higher count and are earlier."""
        found = 0
        while total:
            if node := self.nodes.get(total):
                found += bisect_left(node, term)
                if found >= self.most:
                    return True
            total &= total - 1
        return False

    def add(self, total: int, term: str) -> None:
        while total < LARGEST:
            node = self.nodes.setdefault(total, [])
            if len(node) < self.most or term < node[-1]:
                insort(node, term)
                del node[self.most:]
            total += total & -total


def skyband(rows: DataFrame, most: int = TOP) -> DataFrame:
    """Of the rows (lang, source, term, n, total) of each partition and group, those that fewer than `most` others dominate.

    In the order of falling n, then total, then term, whatever dominates a row comes before it; and of a row's
    dominators the first `most` are in the skyband themselves, so it is enough to ask those.
    """
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, seen = None, Dominators(most)
        for batch in batches:
            kept = []
            langs, sources, terms, totals = (batch.column(c).to_pylist() for c in ("lang", "source", "term", "total"))
            for i, (lang, source, term, total) in enumerate(zip(langs, sources, terms, totals)):
                if group != (lang, source):
                    group, seen = (lang, source), Dominators(most)
                if not seen.enough(total, term):
                    seen.add(total, term)
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int64()))

    ordered = rows.select("lang", "source", "term", "n", "total").sortWithinPartitions("lang", "source", F.desc("n"), "total", "term")
    return ordered.mapInArrow(keep, "lang string, source string, term string, n long, total long")


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value, rank): each group against each other source of its language."""
    by_lang: dict[str, tuple[list[str], list[int]]] = {}
    for row in groups.orderBy("lang", "source").collect():  # see above for their number
        for values, value in zip(by_lang.setdefault(row["lang"], ([], [])), (row["source"], row["size"])):
            values.append(value)
    sums = pair_sums(terms, by_lang)
    both = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    others = groups.select("lang", F.col("source").alias("item"))
    wanted = groups.select("lang", "source").join(others, "lang").where("source != item")  # rows of the result
    return _ranked(wanted.join(both, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long"))))


def top_terms(terms: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """Rows (lang, source, item, value, rank): the terms a group uses more than its language that differ most."""
    retained = skyband(terms.select("lang", "term", "total", F.inline("sources")), top)
    merged = skyband(retained.repartition("lang", "source"), top)
    found = merged.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), F.expr(share("n", "size")).alias("p"), F.expr(share("total", "lang_size")).alias("q"))
    value: Column = F.expr("((p - q) * (p - q)) div (p + q)")
    return _ranked(found.where("p > q").select("lang", "source", "item", value.alias("value"))).where(F.col("rank") <= top)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part is `pair` or `term`."""
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    terms = saved(kept_terms(rows, min_documents), "terms")
    groups = saved(group_totals(rows, terms), "groups")

    def part(name: str, found: DataFrame) -> DataFrame:
        return found.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part("pair", pairs(terms, groups)).union(part("term", top_terms(terms, groups, top)))
