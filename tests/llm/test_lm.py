"""The language model: Elias-Fano sequences, and scores against the same model in dictionaries."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from razonete.llm import lm, trie
from razonete.llm.queries import QUERIES


@pytest.mark.parametrize("n, top", [(1, 1), (1, 2**50), (3, 2**40), (1000, 2000), (4000, 10**9), (700, 3), (130, 1)])
def test_elias_fano(n, top):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, top, n)).astype(np.uint64)
    sequence = trie.EliasFano.of(trie.EliasFano.encode(values))
    assert (sequence.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, values + np.uint64(1), draw.integers(0, 2 * top, 500).astype(np.uint64)])
    at, same = sequence.successor(asked)
    assert (at == np.searchsorted(values, asked)).all()
    assert (same == np.isin(asked, values)).all()


def test_empty_sequence():
    sequence = trie.EliasFano.of(trie.EliasFano.encode(np.zeros(0, np.uint64)))
    at, same = sequence.successor(np.array([0, 9], np.uint64))
    assert at.tolist() == [0, 0] and not same.any()


def test_files_hold_arrays(tmp_path):
    arrays = {"a": np.arange(5), "b": np.zeros(0, np.uint16), "c": np.array([2**63], np.uint64)}
    for folder in (str(tmp_path), f"file://{tmp_path}"):
        read = trie.read_arrays(trie.write_arrays(folder, "x", arrays))
        assert all((read[k] == arrays[k]).all() and read[k].dtype == arrays[k].dtype for k in arrays)


class Dictionaries:
    """The same smoothing over counts in dictionaries."""

    def __init__(self, texts):
        split = [self.split(t) for t in texts]
        self.one = collections.Counter(w for s in split for w in s)
        self.total, self.words = sum(self.one.values()), len(self.one)
        self.more, self.left = {1: self.one}, {}
        for n in (2, 3):
            counts = collections.Counter(g for s in split for g in zip(*(s[i:] for i in range(n))))
            self.more[n] = {g: c for g, c in counts.items() if c >= lm.LEAST}
            self.left[n] = collections.Counter()
            for g, c in self.more[n].items():
                self.left[n][g[:-1]] += c - lm.DISCOUNT

    @staticmethod
    def split(text):
        return [w.decode() for w in (text or "").encode().lower().split()] + [None]

    def p(self, context, word):
        if not context:
            return (self.one.get(word, 0) + 0.1) / (self.total + 0.1 * (self.words + 1)) if self.total else 1.0
        below = self.p(context[1:], word)
        n = len(context) + 1
        seen = self.more[n - 1].get(context if n > 2 else context[0], 0)
        if not seen:
            return below
        return (max(0, self.more[n].get((*context, word), 0) - lm.DISCOUNT) + (seen - self.left[n][context]) * below) / seen

    def score(self, text, order):
        words = self.split(text)
        return sum(math.log10(self.p(tuple(words[max(0, i - order + 1):i]), w)) for i, w in enumerate(words))


TEXTS = ["the cat sat on the mat", "The cat  sat on a mat\n", "the dog sat", "a dog sat on the cat", "", None,
         "the the the the the", "cat", "É é È", "the cat sat on the mat"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_dictionaries(spark, order, monkeypatch):
    monkeypatch.setattr(lm, "TASK_ROWS", 7)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    model = lm.fit(docs, order=order)
    same = Dictionaries(TEXTS)
    assert (model.total, model.words) == (same.total, same.words)
    new = [*TEXTS, "unknown words the cat", "the cat sat on unknown", "sat", "on the on the"]
    asked = spark.createDataFrame([(i, t, "x") for i, t in enumerate(new)], "doc_id long, text string, context string")
    for row in lm.score(asked, model).collect():
        words = same.split(row["text"])
        assert row["n_tokens"] == len(words) and row["n_known"] == sum(w in same.one for w in words)
        assert row["base_score"] == pytest.approx(same.score(row["text"], 1), abs=1e-9)
        assert row["score"] == pytest.approx(same.score(row["text"], order), abs=len(words) * 2 / lm.STEPS)


def test_probabilities_of_a_context_sum_to_one():
    same = Dictionaries(TEXTS)
    for context in ((), ("the",), ("the", "cat"), ("dog",), ("nowhere",)):
        known = sum(same.p(context, w) for w in same.one)
        assert known + same.p(context, "unseen") == pytest.approx(1)


def test_no_training_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = lm.fit(none)
    assert (model.total, model.words) == (0, 0)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lm.score(docs, model).collect()[0][2:] == (3, 0, 0.0, 0.0)
    assert lm.score(none, model).count() == 0


def test_very_long_text(spark):
    text = " ".join(f"w{i % 777}" for i in range(80_000))
    docs = spark.createDataFrame([(1, text), (2, "w1 w2 w3")], "doc_id long, text string")
    row = lm.score(docs, lm.fit(docs)).where("doc_id = 1").collect()[0]
    assert row["n_tokens"] == row["n_known"] == 80_001
    assert row["score"] > row["base_score"] * 0.1


def test_query_equals_dictionaries(spark, folder):
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    same = Dictionaries([t for d, t in texts.items() if zlib.crc32(str(d).encode()) % 10])
    rows = QUERIES["op4_lm"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text, n = texts[row["doc_id"]], row["n_tokens"]
        assert row["train_tokens"] == same.total
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 10 == 0)
        assert row["base_score"] == pytest.approx(same.score(text, 1), abs=1e-6)
        assert row["score"] == pytest.approx(same.score(text, 3), abs=n * 2 / lm.STEPS)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_wording_of_a_single_training_text_counts(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(words[::-1])]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = lm.score(docs, lm.fit(docs)).collect()
    # Each pair is seen once, and its two words twice each: a share of 1/8 is its own.
    assert len(rows) == 2 and all(r["score"] > r["base_score"] + 30 for r in rows)


def test_counts_go_straight_to_the_segments(spark, monkeypatch):
    """A context of more tokens than a segment has several; counts are not written as tables of their own."""
    draw = random.Random(5)
    texts = [" ".join(w for _ in range(60) for w in ("the", f"w{draw.randrange(300)}", "of")) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    written = []
    monkeypatch.setattr(lm, "saved", lambda df, name, saved=lm.saved: written.append(name) or saved(df, name))
    monkeypatch.setattr(lm, "SEGMENT_ROWS", 300)
    model = lm.fit(docs)
    assert written == ["words"]
    for segments in model.gram_segments:
        firsts = [s[0] for s in segments]
        assert firsts == sorted(firsts) and len(set(firsts)) < len(firsts)
    same = Dictionaries(texts)
    for row in lm.score(docs, model).collect():
        assert row["score"] == pytest.approx(same.score(row["text"], 3), abs=181 * 2 / lm.STEPS)


def test_packed_counts():
    draw = np.random.default_rng(4)
    values = np.concatenate([draw.integers(0, 1 << bits, 40) for bits in (1, 14, 15, 16, 30, 31, 45, 46, 60, 62)]).astype(np.uint64)
    assert (trie.unpack_numbers(trie.pack_numbers(values)[0]) == values).all()
    assert len(trie.unpack_numbers(trie.pack_numbers(values[:0])[0])) == 0
    wanted, blocks = collections.Counter(), ([], [])
    for top in (50, 10**6, 2**62):
        keys = np.unique(draw.integers(0, top, 400))
        counts = draw.choice([1, 1, 2, 70_000], len(keys))
        wanted.update(dict(zip(keys.tolist(), counts.tolist())))
        for held, packed in zip(blocks, trie.pack_counts(keys, counts, np.array([0, 1, 20]))):
            held += packed.to_pylist()
    found, n = trie.unpack_counts(*blocks)
    assert list(zip(found.tolist(), n.tolist())) == sorted(wanted.items())


def test_counts_are_shuffled_in_a_few_bytes(spark, folder):
    """Pairs of words take some four bytes each; as rows of numbers they took nine and more."""
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("text").toArrow()["text"].combine_chunks()
    words = np.unique(lm.tokens(texts).hash, return_inverse=True)[1]
    [(pairs, n)] = lm.summed([(words[:-1], words[1:])], len(words))
    packed = trie.pack_counts(pairs, n, np.array([0]))
    assert len(pairs) > 10_000 and sum(c.nbytes for c in packed) < 5 * len(pairs)


@pytest.mark.parametrize("keys", [
    np.random.default_rng(1).integers(-2**63, 2**63, 3000).repeat(3), np.array([8, -8, 9, 8, 2**62, 9, 2**62 + 1, 2**62]),
    np.arange(500) % 7, np.zeros(0, np.int64)])
def test_unique_keys(keys):
    keys = np.random.default_rng(2).permutation(keys.astype(np.int64))
    place, number = trie.unique_keys(keys)
    wanted, same = np.unique(keys, return_inverse=True)
    assert (keys[place] == wanted).all() and (number == same).all()


@pytest.mark.parametrize("read", [0, 200, trie.READ])
@pytest.mark.parametrize("distinct", [True, False])
def test_uneven_buckets(distinct, read, monkeypatch):
    """Numbers that crowd at the ends of what their upper bits leave, where a guess by the lower bits is far off."""
    monkeypatch.setattr(trie, "READ", read)
    draw = np.random.default_rng(6)
    parts = [np.arange(3000), 2**30 - 1 - np.arange(500), 2**34 + draw.integers(0, 2**34, 900), 2**40 - 2 ** np.arange(30)]
    values = np.sort(np.concatenate(parts if distinct else [np.repeat(v, draw.integers(1, 90, len(v))) for v in parts])).astype(np.uint64)
    values = np.unique(values) if distinct else values
    sequence = trie.EliasFano.of(trie.EliasFano.encode(values))
    assert sequence.distinct == distinct and (sequence.all() == values).all()
    asked = draw.permutation(np.concatenate([values, values + np.uint64(1), values // np.uint64(3), draw.integers(0, 2**41, 500).astype(np.uint64)]))
    at, same = sequence.successor(asked)
    assert (at == np.searchsorted(values, asked)).all()
    assert (same == np.isin(asked, values)).all()


def test_numbers_are_found_in_a_few_looks(monkeypatch):
    """A frequent context has many successors with the same upper bits; halving took some twelve looks at each."""
    draw = np.random.default_rng(7)
    values = np.unique(np.concatenate([draw.integers(0, 2**20, 40_000), 2**36 + np.arange(3)])).astype(np.uint64)
    sequence = trie.EliasFano.of(trie.EliasFano.encode(values))
    looks = []
    monkeypatch.setattr(trie.EliasFano, "lower", lambda self, i, lower=trie.EliasFano.lower: looks.append(len(i)) or lower(self, i))
    at, same = sequence.successor(values)
    assert same.all() and (at == np.arange(len(values))).all()
    assert sum(looks) < 7 * len(values)


def test_only_what_is_not_found_asks_for_back_offs(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    model, asked = lm.fit(docs), []
    monkeypatch.setattr(lm.ContextSegment, "logs", lambda self, ids, logs=lm.ContextSegment.logs: asked.append(len(ids)) or logs(self, ids))
    known = lm.tokens(pa.array(TEXTS))
    model.log_probabilities(known)
    assert sum(asked) == 0  # every n-gram of a training text has its own probability
    model.log_probabilities(lm.tokens(pa.array(["the cat sat on unknown"])))
    assert sum(asked) == 2  # what "on" and "sat on" leave


@pytest.mark.parametrize("hot", [[], [(2, 300)], [(0, 50), (2, 300), (9, 100)]])
def test_part_of_pairs(hot):
    draw = np.random.default_rng(8)
    nodes, words, total, parts = 10, 40, 1000, 7
    a, b = (np.sort(draw.integers(0, nodes * words, 500)) // words, draw.integers(0, words, 500))
    counts = dict(hot)
    wanted = []
    for x, y in zip(a.tolist(), b.tolist()):
        before = sum(n for i, n in hot if i < x)
        place = before + (total - sum(counts.values())) * (x / nodes) + counts.get(x, 0) * (y / words)
        wanted.append(min(int(place * (parts / total)), parts - 1))
    assert lm.part_of(a, b, hot, nodes, words, total, parts).tolist() == wanted


def test_all_pairs_of_a_segment():
    context, word = np.array([5, 5, 8, 8, 8, 9, 20]), np.array([0, 3, 0, 1, 3, 2, 3])
    segment = lm.GramSegment(lm.GramSegment.arrays(context, word, 4, np.ones(7, np.uint8)))
    assert [v.tolist() for v in segment.all()] == [context.tolist(), word.tolist()]
    asked = [(c, w) for c in range(5, 30) for w in range(4)]
    found = segment.find(*(np.array(v) for v in zip(*asked))).tolist()
    pairs = list(zip(context.tolist(), word.tolist()))
    assert found == [pairs.index(x) if x in pairs else -1 for x in asked]


def test_a_few_numbers_are_found_in_one_look(monkeypatch):
    """With many segments, each has few queries of a batch: rounds of guesses cost more than what lies between the bounds."""
    values = np.unique(np.random.default_rng(9).integers(0, 2**40, 5000)).astype(np.uint64)
    sequence = trie.EliasFano.of(trie.EliasFano.encode(values))
    looks, last = [], sequence.last
    monkeypatch.setattr(trie.EliasFano, "lower", lambda self, i, lower=trie.EliasFano.lower: looks.append(len(i)) or lower(self, i))
    at, same = sequence.successor(values[::50])
    assert same.all() and (at == np.arange(0, len(values), 50)).all() and len(looks) == 1 and last == values[-1]


def test_bounds_of_segments():
    first = np.array([(0, 0), (2, 5), (2, 9), (4, 0)])
    major, minor = np.array([0, 0, 2, 2, 2, 2, 3, 4, 4]), np.array([1, 7, 4, 5, 8, 9, 0, 0, 3])
    assert trie.bounds_of(first, [major, minor]).tolist() == [0, 3, 5, 7, 9]
    assert trie.bounds_of(np.zeros((0, 2), np.int64), [major, minor]).tolist() == [9]
