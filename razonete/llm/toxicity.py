"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

Texts are lower-cased and cut into words (ASCII letters and digits, and all
characters beyond ASCII). A feature is a run of `ORDERS` characters of a word
with a space at either end, hashed to one of `BUCKETS`. Its value in a text is
how often the text's different words hold it, times the log-count ratio

    r = log((1 + toxic texts with it) / (1 + clean texts with it))
        - log((2 + toxic texts) / (2 + clean texts)),

over the square root of the text's number of different words. Logistic
regression with an L2 penalty gives the weights. A score adds up over the
different words of a text, so words are scored once per batch.

Learning takes `MAX_ROWS` labelled documents at most, those of the smallest hash
of their id, and of their features the `MAX_FEATURES` with the clearest ratio
among those in `MIN_TEXTS` texts or more. So what is sent to the driver, and the
model that is sent back to all tasks, are bounded. Scoring is for all rows.

Null and empty texts, and texts without words, get the score of a text without
features. Null labels, labels without a document and null ids are not learned
from; an id that is labelled repeatedly is toxic if any label says so, and one
with several texts counts with the first in order. With no labels, or only one
kind, all scores are about the smoothed share of toxic labels. Equal texts have
equal scores, repeated rows stay, other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from razonete.llm.common import (
    ALNUM, AS_IS, BYTE_VALUES, Hashes, add_columns, char_begins, find_words, saved, spell)

ORDERS = (3, 4, 5, 6)
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
MAX_ROWS = 6_000
MAX_FEATURES = 40_000
MIN_TEXTS = 3
PENALTY = 0.1
ROUNDS = 100
TOXIC = 0.7


def distinct_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts and numbers of their different words, and the words themselves: bytes with a space around each, and bounds."""
    words = find_words(pc.utf8_lower(pc.fill_null(column, "")), ALNUM, AS_IS)
    number, spelled, bounds = spell(words)
    n = max(1, len(bounds) - 1)
    pairs = np.unique(words.texts() * n + number)
    return pairs // n, pairs % n, spelled, bounds


def word_features(spelled: np.ndarray, bounds: np.ndarray, orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Words and buckets of all n-grams of characters."""
    begins, word = char_begins(spelled, bounds)
    hashes = Hashes(BYTE_VALUES[spelled])
    words, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in orders:
        at = np.flatnonzero(word[:-n] == word[n - 1:-1])
        words.append(word[at])
        buckets.append((hashes.of(begins[at], begins[at + n]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(words), np.concatenate(buckets)


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and value of all features of a batch, and the number of different words of each text."""
    text, word, spelled, bounds = distinct_words(column)
    of, bucket = word_features(spelled, bounds)
    order = np.argsort(of, kind="stable")
    of, bucket = of[order], bucket[order]
    begin = np.searchsorted(of, np.arange(len(bounds)))
    n = (begin[1:] - begin[:-1])[word]
    entry = np.repeat(begin[word] - np.cumsum(n) + n, n) + np.arange(n.sum())
    both, value = np.unique(np.repeat(text, n) << BUCKET_BITS | bucket[entry], return_counts=True)
    return both >> BUCKET_BITS, both & (BUCKETS - 1), value, np.bincount(text, minlength=len(column))


@dataclass
class Model:
    """The weight of each bucket (0 for most), ratio included, and the intercept."""

    weights: np.ndarray
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        text, word, spelled, bounds = distinct_words(column)
        of, bucket = word_features(spelled, bounds)
        by_word = np.bincount(of, self.weights[bucket], len(bounds) - 1)
        words = np.bincount(text, minlength=len(column))
        total = np.bincount(text, by_word[word], len(column)) / np.sqrt(np.maximum(words, 1))
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -500, 500)))


def log_count_ratios(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    return np.log((1 + toxic) / (1 + clean)) - np.log((2 + n_toxic) / (2 + n_clean))


def clearest(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int, most: int) -> np.ndarray:
    """Buckets in order, at most so many: those whose ratio stands out most against its standard error."""
    ratio = log_count_ratios(clean, toxic, n_clean, n_toxic)
    clear = np.abs(ratio) / np.sqrt(1 / (1 + clean) + 1 / (1 + toxic))
    often = np.flatnonzero(clean + toxic >= MIN_TEXTS)
    return np.sort(often[np.argsort(-clear[often], kind="stable")[:most]])


def fit_logistic(row: np.ndarray, column: np.ndarray, value: np.ndarray, labels: np.ndarray, columns: int,
                 penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-penalised logistic regression on sparse rows, by Adam over all of them."""
    n, rate = len(labels), 0.05
    weights = np.zeros(columns + 1)  # the last one is the intercept
    weights[-1] = np.log((1 + labels.sum()) / (1 + n - labels.sum()))
    first, second = np.zeros(columns + 1), np.zeros(columns + 1)
    for t in range(1, rounds + 1 if n else 1):
        z = np.bincount(row, weights[column] * value, n) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / n
        slope = np.bincount(column, error[row] * value, columns + 1) + penalty / n * weights
        slope[-1] = error.sum()
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        weights -= rate * first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return weights[:-1], float(weights[-1])


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most: int) -> DataFrame:
    """Rows (text, label) of at most so many labelled documents."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(
        F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), "id")  # `most` rows
    return saved(joined.groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label")), "labelled")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> Model:
    """Learn from the documents whose id has a label of 0 or 1."""
    spark = docs.sparkSession
    rows = sample(docs, labels, doc_id, text, label, max_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            is_toxic = batch.column("label").to_numpy()
            row, bucket, _, _ = text_features(batch.column("text"))
            for kind in (0, 1):
                texts[kind] += np.bincount(bucket[is_toxic[row] == kind], minlength=BUCKETS)
        seen = np.flatnonzero(texts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), *map(pa.array, texts[:, seen])], ["bucket", "clean", "toxic"])

    counted = rows.mapInArrow(count, "bucket bigint, clean bigint, toxic bigint").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(f"clean + toxic >= {MIN_TEXTS}").toArrow()
    clean, toxic = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    clean[counted["bucket"].to_numpy()] = counted["clean"].to_numpy()
    toxic[counted["bucket"].to_numpy()] = counted["toxic"].to_numpy()
    by_label = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_clean, n_toxic = by_label.get(0, 0), by_label.get(1, 0)
    chosen = clearest(clean, toxic, n_clean, n_toxic, max_features)
    ratio = log_count_ratios(clean, toxic, n_clean, n_toxic)
    number = np.full(BUCKETS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    sent = spark.sparkContext.broadcast((number, ratio.astype(np.float32)))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ratio = sent.value
        for batch in batches:
            row, bucket, value, words = text_features(batch.column("text"))
            kept = number[bucket] >= 0
            row, bucket = row[kept], bucket[kept]
            value = (value[kept] * ratio[bucket] / np.sqrt(words[row])).astype(np.float32)
            ends = pa.array(np.searchsorted(row, np.arange(len(words) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.ListArray.from_arrays(ends, pa.array(number[bucket])),
                 pa.ListArray.from_arrays(ends, pa.array(value))], ["label", "features", "values"])

    found = rows.mapInArrow(values, "label int, features array<int>, values array<float>").toArrow().combine_chunks()
    row = np.repeat(np.arange(len(found), dtype=np.int32), pc.list_value_length(found["features"]).to_numpy())
    flat = [pc.list_flatten(found[c]).to_numpy() for c in ("features", "values")]
    learned, intercept = fit_logistic(row, *flat, found["label"].to_numpy().astype(np.float64), len(chosen))
    weights = np.zeros(BUCKETS, np.float32)
    weights[chosen] = learned * ratio[chosen]
    return Model(weights, intercept)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of each text, from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, text, f"`{name}` double", lambda column: [pa.array(sent.value.scores(column))])
