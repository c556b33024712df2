"""Repeated passages: the cover, and removal against a brute-force search."""

import random

import pytest

from razonete.llm import repeats
from razonete.llm.queries import QUERIES


@pytest.mark.parametrize("period", [1, 2, 3, 7, 13, 31])
def test_every_shift_is_a_difference_of_the_cover(period):
    cover = repeats.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_the_cover_in_use_is_perfect():
    assert len(repeats.difference_cover(31)) == 6


def brute_force(docs: list[tuple], window: int) -> list[tuple]:
    """(id, words, removed, kept) by comparing every window with those of smaller ids."""
    out = []
    key = lambda doc: -2**63 if doc is None else doc
    split = [(doc, (text or "").encode().split()) for doc, text in docs]
    for doc, words in split:
        earlier = {tuple(w[i:i + window]) for d, w in split if key(d) < key(doc) for i in range(len(w) - window + 1)}
        gone = {j for i in range(len(words) - window + 1) if tuple(words[i:i + window]) in earlier
                for j in range(i, i + window)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((str(doc), len(words), len(gone), kept))
    return sorted(out)


def removed(spark, docs, **options):
    rows = repeats.remove(spark.createDataFrame(docs, "doc_id long, text string"), **options).collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in rows)


def drawn(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    passages = [[draw.choice(words) for _ in range(n)] for n in (9, 10, 11, 14, 25, 60)]
    docs = []
    for doc in range(60):
        text = []
        for _ in range(draw.randrange(0, 5)):
            text += draw.choice(passages) if draw.random() < 0.6 else [draw.choice(words) for _ in range(draw.randrange(1, 20))]
        docs.append((doc, draw.choice([" ", "\n", "  "]).join(text)))
    return docs


@pytest.mark.parametrize("period", [1, 3, 7, 9])
def test_equals_brute_force(spark, period):
    docs = drawn(period)
    assert removed(spark, docs, window=10, period=period) == brute_force(docs, 10)


def test_hot_passage_and_copies(spark):
    passage = " ".join(f"p{i}" for i in range(70))
    docs = [(i, f"own{i} {passage} end{i}") for i in range(200)] + [(i, passage) for i in range(200, 260)]
    assert removed(spark, docs) == brute_force(docs, 50)


def test_repeats_within_a_document_stay(spark):
    text = " ".join(["same"] * 300)
    assert removed(spark, [(1, text)]) == [("1", 300, 0, text)]
    assert removed(spark, [(2, text), (1, " ".join(["same"] * 50))])[1] == ("2", 300, 300, "")


def test_windows_are_judged_on_the_input(spark):
    a, b = [f"a{i}" for i in range(10)], [f"b{i}" for i in range(10)]
    docs = [(1, " ".join(a)), (2, " ".join(a + b)), (3, " ".join(b))]
    assert removed(spark, docs, window=10, period=4) == brute_force(docs, 10)


def test_nulls_ties_and_rows_of_one_id(spark):
    long = " ".join(f"x{i}" for i in range(60))
    other = " ".join(f"y{i}" for i in range(60))
    docs = [(1, long), (1, long), (1, other), (2, other + " " + long), (None, other), (3, None), (4, ""), (4, " \n")]
    assert removed(spark, docs) == brute_force(docs, 50)


def test_tasks_flush_in_between(spark, monkeypatch):
    docs = drawn(11)
    monkeypatch.setattr(repeats, "TASK_ROWS", 5)
    assert removed(spark, docs, window=10, period=7) == brute_force(docs, 10)


def test_very_long_text(spark):
    text = " ".join(f"z{i % 5000}" for i in range(60_000))
    docs = [(1, text), (2, "head " + text)]
    rows = removed(spark, docs)
    assert [r[1:3] for r in rows] == [(60_000, 0), (60_001, 60_000)]


def test_empty_table_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, runs string")
    assert repeats.remove(docs).collect()[0]["kept"] == "a b"
    assert repeats.remove(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeats.remove(docs, window=5, period=5)


def test_query_returns_every_document(spark, folder):
    rows = QUERIES["op5_repeats"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert any(r["n_removed"] for r in rows)
