"""Benchmark passages: small literal cases, and a brute-force search over drawn texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from razonete.llm import decontaminate as dec
from razonete.llm.common import ALNUM, LOWER, find_words
from razonete.llm.queries import QUERIES

WORDS = [f"w{i}" for i in range(12)]


def found(docs, items, **options):
    rows = dec.find(docs, items, **options).withColumn("n_hit", dec.covered("hits")).collect()
    return sorted((r["doc_id"], tuple((h["item"], h["start"], h["end"]) for h in r["hits"]), r["n_hit"]) for r in rows)


def brute_force(doc: list[str], item: list[str], window: int) -> set[int]:
    """Numbers of the document's words that are in an occurrence of a window of the item."""
    length = min(window, len(item))
    parts = {tuple(item[i:i + length]) for i in range(len(item) - length + 1)} if item else set()
    return {j for i in range(len(doc) - length + 1) if tuple(doc[i:i + length]) in parts for j in range(i, i + length)}


def test_words():
    words = find_words(pa.array(["Ab9-é_x", None, "", "É  ÉZ"]), ALNUM, LOWER)
    assert words.counts().tolist() == [3, 0, 0, 2]
    assert [words.join(i, i + 1).decode() for i in range(5)] == ["ab9", "é", "x", "É", "Éz"]


def test_windows_do_not_go_over_the_end_of_a_text(spark):
    item = " ".join(f"q{i}" for i in range(13))
    first, second = " ".join(item.split()[:7]), " ".join(item.split()[7:])
    docs = spark.createDataFrame([(1, first), (2, second), (3, f"x {item} y")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert found(docs, items) == [(1, (), 0), (2, (), 0), (3, (("7", 1, 14),), 13)]


@pytest.mark.parametrize("blocks", [1, 3])
def test_equals_brute_force(spark, blocks):
    draw = random.Random(3)
    items = [[draw.choice(WORDS) for _ in range(n)] for n in (1, 2, 3, 4, 5, 6, 6, 8, 9, 0)]
    docs = [[draw.choice(WORDS) for _ in range(draw.randrange(0, 60))] for _ in range(40)]
    docs += [items[8] * 3, items[7][:4] + items[7], ["none"] * 30]
    chars = sum(len(" ".join(i)) for i in items)
    out = found(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string"),
                spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string"),
                window=6, block_chars=-(-chars // blocks))
    for doc, (_, hits, n_hit) in zip(docs, out):
        by_item = [brute_force(doc, item, 6) for item in items]
        assert {i for i, words in enumerate(by_item) if words} == {int(h[0]) for h in hits}
        assert n_hit == len(set().union(*by_item))
        for i, words in enumerate(by_item):
            assert {w for item, a, b in hits if item == str(i) for w in range(a, b)} == words


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 5), (1, "a b c", 5), (2, None, None), (None, "", 1)],
                                 "doc_id long, text string, _found int")
    items = spark.createDataFrame([(9, "B"), (9, "b"), (None, "c"), (8, None), (7, "...")], "item_id long, text string")
    rows = dec.find(docs, items).collect()
    hits = [[(h["item"], h["start"], h["end"]) for h in r["hits"]] for r in rows]
    assert sorted(map(str, hits)) == sorted(map(str, [[("", 2, 3), ("9", 1, 2)]] * 2 + [[], []]))
    assert sorted(str(r["_found"]) for r in rows) == ["1", "5", "5", "None"]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([("1", "a")], "item_id string, text string")
    assert found(docs, items.limit(0)) == [(1, (), 0)]
    assert found(docs.limit(0), items) == []


def test_prefix_is_the_rarest_shingle():
    index = dec.build_index([("i", "a b c d e f g")], window=7)
    assert len(index.hash) == 3
    kept = dec.keep_prefixes(index, np.array([5, 2, 9]))
    assert len(kept.entry_shingle) == 1 and kept.hash[0] == index.hash[1]
    assert len(dec.keep_prefixes(index, np.array([0, 2, 9])).entry_shingle) == 0


def test_one_in_twenty_words_is_the_limit(spark):
    item = " ".join(f"q{i}" for i in range(13))
    docs = spark.createDataFrame([(n, item + " z" * (n - 13)) for n in (260, 261)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = dec.find(docs, items).withColumn("c", dec.is_contaminated(dec.covered("hits"), F.col("n_words")))
    assert {r["doc_id"]: r["c"] for r in rows.collect()} == {260: True, 261: False}


def test_query_returns_every_document(spark, folder):
    rows = QUERIES["op3_decontaminate"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert any(r["contaminated"] for r in rows)
