"""Language identification by character language models.

Each language has an interpolated Kneser-Ney model of the characters of its
words, up to `ORDER` characters with a begin and an end around each word; the
context does not go over a word's begin. Words are runs of ASCII letters and of
characters beyond ASCII, lower-cased. Orders below the highest count in how many
contexts an n-gram occurs; n-grams at a word's begin, which have no other
context, count as often as they occur. Discounts come from the counts of counts.

The n-grams of all languages are kept in sorted hash arrays, one for each order,
beside a matrix of their finished log probabilities in each language. The
prediction is the language of the lowest cross-entropy per character. A text
whose cross-entropy is above the `QUANTILE` of texts of that language, measured
on documents left out of the counts, is marked as rejected. The score is the
share of the language in a softmax whose sharpness fits the same documents best.

Learning takes documents drawn by hash, about `MAX_CHARS` characters for each
language, so what is counted and sent around is bounded. All texts are predicted.

Null texts and texts without a letter are `und` with score 0. Rows with a null
language or text are not learned from; with nothing learned, all is `und`. Equal
texts have equal results (ties go to the language that sorts first), repeated
rows stay, other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from razonete.llm.common import (
    AS_IS, BYTE_VALUES, Hashes, Words, add_columns, char_begins, find_words, saved, spell)

ORDER = 5
MAX_CHARS = 6_000_000
CALIBRATION = 5  # one in so many sampled documents is left out of the counts
QUANTILE = 0.995
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0)

LETTERS = np.zeros(256, bool)
LETTERS[97:123] = LETTERS[128:] = True
BEGIN, END = " ", "\n"


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def spelled_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words' spellings; the spellings with begin and end, their characters' first bytes and words, and
    the place of each character in its word."""
    number, spelled, bounds = spell(words)
    spelled[bounds[1:] - 1] = ord(END)
    begins, word = char_begins(spelled, bounds)
    place = np.arange(len(begins)) - np.searchsorted(word, word)
    return number, spelled, begins, word, place


def top_grams(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Texts, and for every character but begins its n-gram of the highest order, of all words of a batch."""
    words = find_words(lowered(column), LETTERS, AS_IS)
    number, spelled, begins, word, place = spelled_words(words)
    at = np.flatnonzero(place[:-1] > 0)
    first = begins[at - np.minimum(place[at], ORDER - 1)]
    data = spelled.tobytes()
    grams = np.array([data[a:b].decode() for a, b in zip(first, begins[at + 1])], object)
    of_word = np.searchsorted(word[at], np.arange(word[-1] + 1))
    n = np.diff(of_word)[number]
    entry = np.repeat(of_word[number] - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.repeat(words.texts(), n), grams[entry]


@dataclass
class Model:
    """Log probabilities (natural) by language: grams[k] and contexts[k] have sorted hashes of n-grams of k + 1
    characters and of contexts of k, beside matrices; `unseen` is for characters in none."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    unseen: np.ndarray
    sharpness: float = 16.0
    limits: np.ndarray | None = None

    def entropies(self, column: pa.Array) -> np.ndarray:
        """Cross-entropy in bits for each character of each text (a row), by language."""
        words = find_words(lowered(column), LETTERS, AS_IS)
        number, spelled, begins, word, place = spelled_words(words)
        at = np.flatnonzero(place[:-1] > 0)
        hashes = Hashes(BYTE_VALUES[spelled])
        logs = np.zeros((len(at), len(self.languages)))
        left = np.arange(len(at))
        for order in range(ORDER, 0, -1):
            reaches = place[at[left]] >= order - 1
            now, start = left[reaches], begins[at[left[reaches]] - order + 1]
            found, value = lookup(self.grams[order - 1], hashes.of(start, begins[at[now] + 1]))
            logs[now[found]] += value
            missing = now[~found]
            found, value = lookup(self.contexts[order - 1], hashes.of(start[~found], begins[at[missing]]))
            logs[missing[found]] += value
            left = np.concatenate([left[~reaches], missing])
        logs[left] += self.unseen
        texts, n = words.texts(), len(column)
        chars = np.bincount(texts, np.bincount(word[at], minlength=word[-1])[number], n)
        by_word = [np.bincount(word[at], logs[:, k], word[-1])[number] for k in range(len(self.languages))]
        total = np.array([np.bincount(texts, w, n) for w in by_word]).reshape(-1, n).T
        return -total / np.maximum(chars, 1)[:, None] / np.log(2)


def lookup(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes a sorted table has, and the values of those."""
    keys, values = table
    if not len(keys):
        return np.zeros(len(hashes), bool), values[:0]
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    found = keys[at] == hashes
    return found, values[at[found]]


def string_hashes(texts: pd.Series) -> np.ndarray:
    data = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, data)])
    return Hashes(BYTE_VALUES[np.frombuffer(b"".join(data), np.uint8)]).of(ends[:-1], ends[1:])


def table(logs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the index, and its rows in that order."""
    keys = string_hashes(pd.Series(logs.index, dtype=object))
    order = np.argsort(keys)
    return keys[order], logs.to_numpy(np.float32)[order]


def kneser_ney(counts: pd.DataFrame, languages: list[str]) -> Model:
    """The model of rows (lang, gram, n): how often n-grams of the highest order occur in each language."""
    by_order: dict[int, pd.DataFrame] = {}
    above = counts.iloc[:0]
    size = counts["gram"].str.len()
    for order in range(ORDER, 0, -1):
        # Below the highest order an n-gram counts once for each character before it.
        suffixes = above.assign(gram=above["gram"].str[1:]).groupby(["lang", "gram"], as_index=False)["n"].count()
        above = by_order[order] = pd.concat([counts[size == order], suffixes], ignore_index=True)
    alphabet = counts["gram"].str[-1].nunique() + 1
    lower = pd.DataFrame(np.log(1 / alphabet), index=[""], columns=range(len(languages)))
    grams, contexts, unseen = [], [], None
    for order in range(1, ORDER + 1):
        rows = by_order[order].assign(context=lambda r: r["gram"].str[:-1])
        ones, twos = (rows["n"] == 1).sum(), (rows["n"] == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        per_context = rows.groupby(["lang", "context"])["n"].agg(["sum", "count"])
        left = np.log(discount * per_context["count"] / per_context["sum"]).unstack("lang").reindex(
            columns=range(len(languages))).fillna(0.0)
        own = rows.join(per_context["sum"].rename("total"), on=["lang", "context"])
        direct = (own.assign(p=(own["n"] - discount) / own["total"]).pivot(index="gram", columns="lang", values="p")
                  .reindex(columns=range(len(languages))).fillna(0.0))
        rest = (left.reindex(direct.index.str[:-1]).fillna(0.0).to_numpy()
                + lower.reindex(direct.index.str[1:] if order > 1 else [""] * len(direct)).to_numpy())
        lower = pd.DataFrame(np.log(direct.to_numpy() + np.exp(rest)), index=direct.index, columns=direct.columns)
        if unseen is None:
            # What is left of the empty context is looked up like that of any other.
            unseen = np.full(len(languages), np.log(1 / alphabet))
        grams.append(table(lower))
        contexts.append(table(left))
    return Model(languages, grams, contexts, unseen)


def sample(docs: DataFrame, text: str, lang: str, max_chars: int) -> tuple[DataFrame, list[str]]:
    """Rows (text, lang, held) of documents drawn by hash, and the languages in order."""
    known = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("name")).where(
        "text is not null and name is not null")
    sizes = sorted((r["name"], r["n"]) for r in known.groupBy("name").agg(F.sum(F.length("text")).alias("n")).collect())
    if not sizes:
        return known.select("text", F.lit(0).alias("lang"), F.lit(False).alias("held")), []
    rates = known.sparkSession.createDataFrame(
        [(name, number, min(1.0, max_chars / max(1, n))) for number, (name, n) in enumerate(sizes)],
        "name string, lang int, rate double")
    drawn = known.join(F.broadcast(rates), "name").withColumn("hash", F.xxhash64("text"))
    drawn = drawn.where(F.pmod("hash", F.lit(1 << 20)) < F.col("rate") * (1 << 20))
    held = F.pmod(F.shiftright("hash", 20), F.lit(CALIBRATION)) == 0
    return saved(drawn.select("text", "lang", held.alias("held")), "texts"), [name for name, _ in sizes]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", max_chars: int = MAX_CHARS) -> Model:
    """Learn the languages of the documents that name one."""
    rows, languages = sample(docs, text, lang, max_chars)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, grams = top_grams(batch.column("text"))
            langs = batch.column("lang").to_numpy()[of]
            found = pd.DataFrame({"lang": langs, "gram": grams}).groupby(["lang", "gram"], as_index=False).size()
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["lang"], pa.int32()), pa.array(found["gram"], pa.string()), pa.array(found["size"], pa.int64())],
                ["lang", "gram", "n"])

    counted = rows.where("not held").select("text", "lang").mapInArrow(count, "lang int, gram string, n bigint")
    counts = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if counts.empty:
        nothing = (np.zeros(0, np.uint64), np.zeros((0, 0)))
        return Model([], [nothing] * ORDER, [nothing] * ORDER, np.zeros(0))
    return calibrate(rows.where("held"), kneser_ney(counts, languages))


def calibrate(rows: DataFrame, model: Model) -> Model:
    """Choose the sharpness, and the highest usual cross-entropy of each language, from rows (text, lang)."""
    def measure(column: pa.Array) -> list[pa.Array]:
        bits = sent.value.entropies(column)
        ends = np.arange(len(bits) + 1, dtype=np.int32) * bits.shape[1]
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(bits.ravel()))]

    sent = rows.sparkSession.sparkContext.broadcast(model)
    measured = add_columns(rows, "text", "bits array<double>", measure).withColumn("own", F.expr("bits[lang]"))
    losses = [F.avg(F.log(F.aggregate("bits", F.lit(0.0), lambda total, b: total + F.exp(F.lit(s) * (F.col("own") - b)))))
              for s in SHARPNESS]
    loss = measured.agg(*losses).first()
    sharpness = min(zip(loss, SHARPNESS))[1] if loss[0] is not None else model.sharpness
    limits = np.full(len(model.languages), np.inf)
    for row in measured.groupBy("lang").agg(F.percentile_approx("own", QUANTILE).alias("limit")).collect():
        limits[row["lang"]] = row["limit"]
    return Model(model.languages, model.grams, model.contexts, model.unseen, sharpness, limits)


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any script."""
    words = find_words(lowered(column), LETTERS, AS_IS)
    found = words.counts() > 0
    ascii_only = (words.data < 128).all()
    if not ascii_only:
        for i in np.flatnonzero(found):
            found[i] = any(c.isalpha() for c in column[i].as_py())
    return found


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred, score, bits (cross-entropy per character in that language) and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> list[pa.Array]:
        model, n = sent.value, len(column)
        known = has_letter(column) if model.languages else np.zeros(n, bool)
        bits = model.entropies(column) if known.any() else np.zeros((n, max(1, len(model.languages))))
        best = bits.argmin(axis=1)
        lowest = bits[np.arange(n), best]
        score = np.where(known, 1 / np.exp(-model.sharpness * (bits - lowest[:, None])).sum(axis=1), 0.0)
        names = np.where(known, np.array(model.languages or [""], object)[best], "und")
        over = known & (lowest > model.limits[best]) if model.limits is not None else np.zeros(n, bool)
        return [pa.array(names, pa.string()), pa.array(score), pa.array(np.where(known, lowest, np.nan), from_pandas=True),
                pa.array(over)]

    return add_columns(docs, text, "lang_pred string, score double, bits double, rejected boolean", run)
