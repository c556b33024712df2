"""The registered queries: those with SQL against it, clashing columns, and the entry points without the subpackage."""

import collections
import importlib
import importlib.util
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points
from razonete.llm.queries import ORACLE, QUERIES


def test_a_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, name):
    connection = duckdb.connect()
    for file in os.listdir(folder):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    found = collections.Counter(tuple(row[c] for c in columns) for row in df.collect())
    relation = connection.execute(ORACLE[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == collections.Counter(tuple(row[i] for i in order) for row in relation.fetchall())


def test_all_queries_take_nulls_and_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n", "en", "s", 2), (4, "one two three four five six", "en", "s", 27),
            (5, "one two three four five six", None, None, None), (6, "é" * 5000, "fr", "s", 5000), (7, "x " * 30_000, "en", "s", 60_000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 1, 1), (9, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "two three"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, None, 0), (2, [1.0] * 64, 0), (3, [0.5], None)], "vec_id long, embedding array<float>, label int").write.parquet(
        f"{folder}/embeddings.parquet")
    for name, run in entry_points.queries().items():
        if name in QUERIES:
            out = run(spark, folder)
            if "doc_id" in out.columns:
                assert sorted(r["doc_id"] for r in out.collect()) == [1, 2, 3, 4, 5, 6, 7], name
    assert [r["vec_id"] for r in QUERIES["op11_centroids"](spark, folder).collect()] == [2]
    # Each language has one source, and no term is in ten documents.
    assert QUERIES["op12_divergence"](spark, folder).count() == 0
    assert {r["doc_id"] for r in entry_points.queries()["pipeline"](spark, folder).collect()} <= {1, 2, 3, 4, 5, 6, 7}
    empty = str(tmp_path / "empty")
    for table in ("documents", "labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{empty}/{table}.parquet")
    for name in QUERIES:
        assert QUERIES[name](spark, empty).count() == 0, name


def test_entry_points_work_without_the_subpackage(monkeypatch):
    whole = set(entry_points.queries())
    find = importlib.util.find_spec
    gone = ("razonete.llm", "corpus_pipeline")
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith(gone) else find(name, *a))
    spec = find("__spark_entry__")
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    left = set(alone.queries())
    assert whole - left == set(QUERIES) | {"pipeline"}
    assert not any(name.startswith("razonete.llm") for name in vars(alone))
    assert sys.modules["__spark_entry__"] is entry_points
