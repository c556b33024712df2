"""Toxicity: features against sets of strings, learning, and held-out accuracy."""

import collections
import random

import numpy as np
import pyarrow as pa

from razonete.llm import toxicity
from razonete.llm.queries import QUERIES


def grams(word):
    spelled = f" {word} "
    return [spelled[i:i + n] for n in toxicity.ORDERS for i in range(len(spelled) - n + 1)]


def test_features_count_grams_of_different_words():
    texts = ["Ab ab été", None, "", "x", "mañana ÉTÉ"]
    row, bucket, value, words = toxicity.text_features(pa.array(texts))
    assert words.tolist() == [2, 0, 0, 1, 2]
    wanted = [collections.Counter(g for w in set((t or "").lower().split()) for g in grams(w)) for t in texts]
    for i, counts in enumerate(wanted):
        assert sorted(value[row == i].tolist()) == sorted(counts.values())
    same = [set(bucket[row == i].tolist()) for i in range(5)]
    assert len(same[0] & same[4]) == len(set(grams("été")))  # shared by both, no other bucket is


def test_scores_add_up_the_weights_of_features():
    texts = pa.array(["some words here some", "other", "", None, "longwordwithmanygrams " * 3])
    weights = np.random.default_rng(1).normal(size=toxicity.BUCKETS)
    row, bucket, value, words = toxicity.text_features(texts)
    total = np.bincount(row, weights[bucket] * value, 5) / np.sqrt(np.maximum(words, 1))
    scores = toxicity.Model(weights, -0.5).scores(texts)
    assert np.allclose(scores, 1 / (1 + np.exp(0.5 - total)))


def test_logistic_regression_finds_the_least_loss():
    draw = np.random.default_rng(2)
    x, y = draw.normal(size=(80, 3)), (draw.random(80) < 0.4).astype(float)
    row, column = np.divmod(np.arange(240), 3)
    w, b = toxicity.fit_logistic(row, column, x.ravel(), y, 3, penalty=1.0, rounds=3000)
    slope = x.T @ (1 / (1 + np.exp(-(x @ w + b))) - y) + w
    assert np.abs(slope).max() < 0.05


def drawn(n, seed):
    draw = random.Random(seed)
    clean, bad = [f"word{i}" for i in range(60)], ["vilest", "rotten"]
    rows = []
    for i in range(n):
        toxic = int(draw.random() < 0.3)
        words = [draw.choice(clean) for _ in range(draw.randrange(5, 40))] + [draw.choice(bad)] * (2 * toxic)
        draw.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_learns_from_labelled_rows_and_scores_all(spark):
    rows = drawn(300, 3)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(1, None, "null"), (None, "", "y"), (None, "vilest", "z")],
                                 "doc_id long, text string, score_ string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:150]] + [(2, None), (None, 1), (999, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, max_rows=100)
    out = toxicity.score(docs, model).collect()
    assert len(out) == 303
    found = {r["doc_id"]: r["score"] for r in out if r["score_"] == "x"}
    right = sum((found[i] >= 0.5) == bool(y) for i, _, y in rows[150:])
    assert right >= 0.97 * 150
    assert all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if not r["text"]}) == 1


def test_no_labels_or_one_kind(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "vilest"), (3, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.5}
    clean = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert all(r["score"] < 0.5 for r in toxicity.score(docs, toxicity.fit(docs, clean)).collect())
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), clean)).count() == 0


def test_sample_is_bounded_and_has_a_row_for_each_id(spark):
    docs = spark.createDataFrame([(i % 20, f"t{i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 20, i % 2) for i in range(60)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels, "doc_id", "text", "toxic", 8).collect()
    assert len(rows) == 8 and len({r["id"] for r in rows}) == 8
    assert all(r["text"] == min(f"t{i}" for i in range(100) if i % 20 == r["id"]) for r in rows)


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    labels = dict(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect())
    rows = QUERIES["op9_toxicity"](spark, folder).collect()
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [p for y, p, _ in held if y]
    clean = [p for y, p, _ in held if not y]
    assert sum(clean) <= 0.005 * len(clean) and sum(toxic) >= 0.75 * len(toxic)
    high, low = [s for y, _, s in held if y], [s for y, _, s in held if not y]
    above = np.searchsorted(np.sort(low), high).sum() / (len(high) * len(low))
    assert above > 0.97
