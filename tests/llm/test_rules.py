"""Quality rules against a count in plain Python."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from razonete.llm import rules
from razonete.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    runs = [tuple(words[i:i + rules.WINDOW]) for i in range(len(words) - rules.WINDOW + 1)]
    counts = collections.Counter(runs)
    repeated = {i + k for i, run in enumerate(runs) if counts[run] > 1 for k in range(rules.WINDOW)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_marks": len(re.findall(r"[!-/:-@\[-`{-~]", text)), "n_stop_words": sum(w.rstrip(".,;:!?").lower() in rules.STOP_WORDS for w in words),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated)}


def texts():
    chance = random.Random(5)
    out = [None, "", " \n\t\r\x0b\f ", "a", "a\nb\na\n a\n\na\r\n", "é𝄞 ## <|> 日本 語 x", "the THE, The! then de.", "x " * 30_000,
           "a b c d e f g h", "a b c d e f g h i a b c d e f g h", "a b c d e f g h a b c d e f g h", "w " * 9]
    for _ in range(60):
        n = chance.choice([5, 20, 200])
        words = [chance.choice("abc") if chance.random() < 0.9 else chance.choice(["#the", "x!!", "é,"]) for _ in range(n)]
        out.append("".join(w + chance.choice(["  ", "\n", "\t", " ", " "]) for w in words))
    return out


def test_measures_equal_counts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    found = {r["doc_id"]: r.asDict() for r in rules.measure(docs).drop("text").collect()}
    for i, text in enumerate(texts()):
        assert {k: v for k, v in found[i].items() if k != "doc_id"} == expected(text), repr(text)[:80]


def test_rules_of_a_table(spark):
    docs = spark.createDataFrame([("a b",), ("a b c d",), ("a ## c",), (None,)], "text string")
    table = [rules.Rule("short", "n_words", least=3), rules.Rule("long", "n_words", most=3), rules.Rule("marked", "n_symbols", "n_words", most=50)]
    found = [(r["broken"], r["kept"]) for r in rules.judge(docs, table).collect()]
    assert found == [(["short"], False), (["long"], False), (["marked"], False), (["short"], False)]
    assert rules.judge(docs, [], "text").where("kept").count() == 4


def test_clear_texts_stay_and_junk_goes(spark):
    clear = "The ship came into the harbour at dawn, and nobody on the quay had seen one like it before. It was small and grey, with a red sail."
    junk = ["word " * 50, "*** ### &&& $$$ %%% the of and in a " * 8, " ".join(f"w{i}" for i in range(40)),
            "\n".join(["The same line again and more of it here"] * 9), "too few words"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([clear, *junk])], "doc_id long, text string")
    assert [r["doc_id"] for r in rules.keep(docs).collect()] == [0]


def test_keep_takes_any_names_rows_and_no_rows(spark):
    text = "The ship came into the harbour at dawn, and nobody on the quay had seen one like it before, the day it came."
    docs = spark.createDataFrame([(text, 1, "x", None), (text, 1, "x", None), (None, 2, "y", "z")],
                                 "text string, n_words int, broken string, `a.b` string")
    assert rules.keep(docs).collect() == docs.where("text IS NOT NULL").collect()
    assert rules.keep(docs.limit(0)).columns == docs.columns
    assert rules.keep(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op13_quality"])
def test_plan_has_no_python_and_no_shuffle(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert plan.count("xxhash64") == 1


def test_base_verdict(spark, folder):
    found = QUERIES["op13_quality"](spark, folder)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    assert found.where(base != F.col("base_failed")).count() == 0
    assert found.where("base_failed and kept").count() == 0
