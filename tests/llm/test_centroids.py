"""Centroid clustering against plain Python."""

import hashlib
import math
import random

from razonete.llm import centroids
from razonete.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def expected(rows, dimensions, k, rounds, scale=256, seed=2):
    def usable(e):
        return e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)

    whole = [(i, [math.floor(scale * x) for x in e]) for i, e in rows if usable(e)]
    key = {i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i, _ in whole}
    centers = [v for _, v in sorted(whole, key=lambda r: (key[r[0]], r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = {}
        for _, v in whole:
            members.setdefault(nearest(v)[1], []).append(v)
        centers = [[sum(c) // len(members[n]) for c in zip(*members[n])] if n in members else c for n, c in enumerate(centers)]
    found = [(i, *nearest(v)) for i, v in whole]
    of = {n: sum(d for _, d, m in found if m == n) for _, _, n in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, n, d, of[n], sum(of.values()), digest[n]) for i, d, n in found), key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
                   for r in df.collect()), key=str)


def test_query_equals_plain_rounds(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()][:]
    assert found(QUERIES["op11_centroids"](spark, folder)) == expected(rows, 64, 40, 5)


def test_odd_vectors_ties_and_repeated_rows(spark):
    chance = random.Random(3)
    points = [[chance.choice([-1.5, -0.25, 0.0, 0.125, 2.0]) for _ in range(3)] for _ in range(60)]
    rows = [(i % 50, p) for i, p in enumerate(points)] + [(1, points[0])] * 30
    rows += [(None, points[1]), (100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0]), (104, [1.0, float("nan"), 0.0]),
             (105, [float("inf"), 0.0, 0.0]), (106, [1.0, 2.0, 3.0, 4.0])]
    vectors = spark.createDataFrame(rows, SCHEMA)
    for k in (1, 4, 200):
        assert found(centroids.cluster(vectors, dimensions=3, centroids=k)) == expected(rows, 3, k, 5), k


def test_empty_clusters_stay(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(12)]  # two different vectors, so most centroids stay empty
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert found(centroids.cluster(vectors, dimensions=2, centroids=6)) == expected(rows, 2, 6, 5)


def test_no_usable_vectors_and_clashing_columns(spark):
    empty = centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], SCHEMA))
    assert empty.count() == 0 and len(empty.columns) == 6
    more = spark.createDataFrame([(1, [1.0], "a", 0), (2, [3.0], "b", 1)], "vec_id long, embedding array<float>, cluster string, square int")
    assert found(centroids.cluster(more, dimensions=1, centroids=2)) == expected([(1, [1.0]), (2, [3.0])], 1, 2, 5)


def test_centroids_are_literals_and_sums_are_partial(spark):
    vectors = centroids.whole_vectors(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], SCHEMA), dimensions=2)
    plan = centroids.assign(vectors, [[1, 2], [-3, 4]])._jdf.queryExecution().executedPlan().toString()
    assert "[1,2]" in plan and "[-3,4]" in plan and "Python" not in plan and "split" not in plan
