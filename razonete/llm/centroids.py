"""Centroid clustering in whole numbers: k-means whose every step is a Spark expression.

Vectors are arrays of `DIMENSIONS` numbers; each number x becomes the integer
floor(`SCALE` * x). Distances are squared Euclidean ones: the centroids stand in
the plan as literal arrays, zip_with and aggregate compute the distance to each,
and array_min over structs (distance, number) chooses the centroid, the smaller
number among equally near ones. Sums of the columns and counts are aggregated
before they are shuffled, so a cluster may hold any share of the rows; what
reaches the driver is a row for each cluster. A new centroid is the exact floor
of sum / count; one without vectors stays as it is.

All rounds read the vectors where they are stored, so a lost executor costs its
own part of a round. Vectors that are null, of another length, or with a null or
non-finite component are left out. Repeated rows count and are returned one by
one; a null id counts as empty text for the choice of the first centroids, and
of rows of one id the smaller vector comes first. With fewer vectors than
centroids there are as many centroids as vectors; without any, no rows. Numbers
too large for exact 64-bit distances raise Spark's overflow error.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from razonete.functions.jsonops import computed_once
from razonete.llm.common import saved

DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2


def product(a: str, b: str) -> str:
    """SQL for the sum of the products of two arrays' components."""
    return f"aggregate(zip_with({a}, {b}, (x, y) -> x * y), 0L, (total, x) -> total + x)"


def literal(centroid: list[int]) -> str:
    """SQL for the centroid as an array: one value, which the optimizer makes of one text, not a node for each component."""
    return f"cast(split('{','.join(map(str, centroid))}', ',') AS array<bigint>)"


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                  dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, vector, square): the usable vectors as whole numbers, and the sums of their squares."""
    infinity = float("inf")
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity))
    whole = F.transform(embedding, lambda x: F.floor(scale * x.cast("double")).cast("long"))
    kept = vectors.where(F.coalesce((F.size(embedding) == dimensions) & finite, F.lit(False)))
    found = computed_once(kept.select(F.col(vec_id).alias("vec_id"), embedding), "vector", whole)
    return found.select("vec_id", "vector", F.expr(product("vector", "vector")).alias("square"))


def first_centroids(vectors: DataFrame, centroids: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes, in their order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.select("vector", order.alias("_order")).orderBy("_order", "vector").limit(centroids)
    return [row["vector"] for row in first.collect()]  # `centroids` rows


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Rows (vec_id, vector, cluster, distance), by |v - c|² = |v|² + |c|² - 2 v·c."""
    choices = [f"struct(square + {sum(x * x for x in c)}L - 2 * {product('vector', literal(c))} AS distance, {number} AS cluster)"
               for number, c in enumerate(centroids)]
    found = vectors.select("vec_id", "vector", F.expr(f"array_min(array({', '.join(choices)}))").alias("nearest"))
    return found.select("vec_id", "vector", "nearest.cluster", "nearest.distance")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round."""
    sums = [F.expr(f"sum(vector[{i}]) AS s{i}") for i in range(len(centroids[0]))]
    found = assign(vectors, centroids).groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()  # a row per centroid
    means = {row["cluster"]: [row[f"s{i}"] // row["n"] for i in range(len(sums))] for row in found}
    return [means.get(number, centroid) for number, centroid in enumerate(centroids)]


def fit(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """Centroids after so many rounds over the rows of `whole_vectors`."""
    first = first_centroids(vectors, centroids, seed)
    return reduce(lambda found, _: moved(vectors, found), range(rounds), first) if first else []


def digest(centroid: list[int]) -> str:
    """SHA-256 of the components as decimal numbers with a comma between."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dimensions: int = DIMENSIONS,
            scale: int = SCALE, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for all usable vectors."""
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, vec_id, embedding, dimensions, scale)
    found = fit(whole, centroids, rounds, seed)
    if not found:
        # No usable vector, so no row: the columns alone.
        return whole.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")).where("false")
    assigned = saved(assign(whole, found).select("vec_id", "cluster", "distance"), "assigned")
    sums = {row["cluster"]: row["sum"] for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()}
    facts = spark.createDataFrame(  # a row per centroid
        [(number, sums[number], sum(sums.values()), digest(found[number])) for number in sorted(sums)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
