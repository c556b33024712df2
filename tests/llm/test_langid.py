"""Language identification: the models against dictionaries, rejection, and held-out accuracy."""

import collections
import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa

from razonete.llm import langid
from razonete.llm.queries import QUERIES


def top(texts):
    """Counts of the n-grams of the highest order of all words."""
    counts = collections.Counter()
    for text in texts:
        for word in (text or "").lower().split():
            spelled = f"{langid.BEGIN}{word}{langid.END}"
            for i in range(1, len(spelled)):
                counts[spelled[max(0, i - langid.ORDER + 1):i + 1]] += 1
    return counts


class Dictionary:
    """Interpolated Kneser-Ney of one language, with the discounts of the order over all languages."""

    def __init__(self, counts, everything):
        self.values, alls = self.values_of(counts), [self.values_of(c) for c in everything]
        self.alphabet = len({g[-1] for c in everything for g in c}) + 1
        self.discounts = {}
        for n in range(1, langid.ORDER + 1):
            ones = sum(v == 1 for a in alls for v in a[n].values())
            twos = sum(v == 2 for a in alls for v in a[n].values())
            self.discounts[n] = ones / (ones + 2 * twos) if ones and twos else 0.5

    @staticmethod
    def values_of(counts):
        out, above = {}, {}
        for n in range(langid.ORDER, 0, -1):
            values = collections.Counter({g: c for g, c in counts.items() if len(g) == n})
            for g in above:
                values[g[1:]] += 1
            out[n] = above = values
        return out

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / self.alphabet
        after = {g: v for g, v in self.values[n].items() if g[:-1] == gram[:-1]}
        if not after:
            return self.p(gram[1:])
        d, total = self.discounts[n], sum(after.values())
        return max(after.get(gram, 0) - d, 0) / total + d * len(after) / total * self.p(gram[1:])


TEXTS = {0: ["the cat the hat", "that then there"], 1: ["le chat été là", "les étés"], 2: ["der die das", "dem der"]}


def model_of(texts):
    counts = {k: top(t) for k, t in texts.items()}
    rows = [(k, g, n) for k, c in counts.items() for g, n in c.items()]
    model = langid.kneser_ney(pd.DataFrame(rows, columns=["lang", "gram", "n"]), [str(k) for k in texts])
    return model, {k: Dictionary(c, list(counts.values())) for k, c in counts.items()}


def test_entropies_equal_dictionaries():
    model, same = model_of(TEXTS)
    texts = ["the cat", "étés théière", "zz", "", None, "Der hat das the the the"]
    bits = model.entropies(pa.array(texts))
    for text, row in zip(texts, bits):
        counts = top([text])
        n = sum(counts.values())
        for k in TEXTS:
            wanted = -sum(c * math.log2(same[k].p(g)) for g, c in counts.items()) / max(1, n)
            assert math.isclose(row[k], wanted, rel_tol=1e-4, abs_tol=1e-9)


def test_probabilities_after_a_context_sum_to_one():
    _, same = model_of(TEXTS)
    for k, dictionary in same.items():
        letters = {g[-1] for g in dictionary.values[1]} | {g[-1] for d in same.values() for g in d.values[1]}
        for context in ("", langid.BEGIN, f"{langid.BEGIN}th", "zz"):
            total = sum(dictionary.p(context + c) for c in letters)
            assert math.isclose(total + dictionary.p(context + "\0"), 1, rel_tol=1e-9)


def test_top_grams_of_a_batch():
    texts = ["The the été", None, "", "12 ab-cd", "x"]
    of, grams = langid.top_grams(pa.array(texts))
    plain = ["the the été", "", "", "ab cd", "x"]
    for i, text in enumerate(plain):
        assert collections.Counter(np.array(grams)[of == i].tolist()) == top([text])


def drawn(seed, n=120):
    draw = random.Random(seed)
    words = {"aa": ["bana", "nabo", "abba", "onab"], "bb": ["kitik", "tikki", "ikkit"], "cc": ["œuvre", "sœur", "cœur"]}
    return [(i, " ".join(draw.choice(words[lang]) for _ in range(draw.randrange(3, 30))), lang)
            for i, lang in enumerate(draw.choice(list(words)) for _ in range(n))]


def test_fit_and_predict(spark):
    known = spark.createDataFrame(drawn(1) + [(900, None, "aa"), (901, "kitik", None), (902, "", "bb")], "doc_id long, text string, lang string")
    model = langid.fit(known)
    assert model.languages == ["aa", "bb", "cc"]
    more = drawn(2) + [(500, None, "und"), (501, "", "und"), (502, "123 -- !", "und"), (503, "— …", "und"), (504, "kitik", "bb"), (504, "kitik", "bb")]
    out = langid.predict(spark.createDataFrame(more, "doc_id long, text string, want string"), model).collect()
    assert len(out) == len(more)
    assert all(r["lang_pred"] == r["want"] for r in out)
    assert all((r["score"] == 0) == (r["want"] == "und") and 0 <= r["score"] <= 1 for r in out)
    odd = spark.createDataFrame([(1, "zzzz qqqq xxyy wwww")], "doc_id long, text string")
    assert langid.predict(odd, model).collect()[0]["rejected"]


def test_very_long_text(spark):
    model, _ = model_of(TEXTS)
    docs = spark.createDataFrame([(1, "the hat " * 60_000), (2, "e" * 300_000)], "doc_id long, text string")
    assert langid.predict(docs, model).collect()[0]["lang_pred"] == "0"


def test_nothing_learned(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit(none)
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    assert [(r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()] == [("und", 0.0)] * 2
    assert langid.predict(docs.limit(0), model).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    lang = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect())
    rows = QUERIES["op6_langid"](spark, folder).collect()
    assert len(rows) == len(lang)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(held) >= 0.98 * len(held)
