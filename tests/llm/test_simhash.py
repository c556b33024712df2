"""SimHash: fingerprints, the covering code, links against all pairs, and components."""

import random

import numpy as np
import pytest
import xxhash

from razonete.llm import simhash
from razonete.llm.components import components
from razonete.llm.queries import QUERIES


def roots(pairs, n):
    """Smallest reachable number of each of 0 to n - 1."""
    least = list(range(n))
    while True:
        before = list(least)
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return least


def test_fingerprint_by_hand():
    def expected(shingles):
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))

    def found(text):
        return simhash.majority_bits(simhash.shingle_hashes(text))

    assert found("A b\tÉ d\n") == expected(["a b É", "b É d"])
    assert found("x x x x") == expected(["x x x"] * 2)
    assert found("Two words") == expected(["two words"])
    assert found("one") == expected(["one"])
    assert found(None) == found("") == found(" \n") == 0
    long = " ".join(f"w{i}" for i in range(9000))
    words = long.split()
    assert found(long) == expected([" ".join(words[i:i + 3]) for i in range(8998)])


def test_every_value_has_an_anchor_within_the_radius():
    values = np.random.default_rng(1).integers(0, 2**64, 2000, np.uint64)
    of, anchor = simhash.anchors(values)
    distance = np.bitwise_count(values[of] ^ anchor)
    assert distance.max() <= 2
    assert (np.bincount(of[distance <= simhash.RADIUS], minlength=len(values)) >= 1).all()
    assert len(set(zip(of.tolist(), anchor.tolist()))) == len(of)
    # Anchors are codewords: every check over them is even, so each is its own anchor.
    again, self_anchor = simhash.anchors(np.unique(anchor))
    assert (np.bincount(again, minlength=len(np.unique(anchor))) == 2).all()


def test_all_pairs_within_two_bits_share_an_anchor():
    draw = np.random.default_rng(2)
    for value in draw.integers(0, 2**64, 8, np.uint64):
        near = {int(value)} | {int(value) ^ 1 << i ^ (1 << j if i != j else 0) for i in range(64) for j in range(64)}
        near = np.array(sorted(near), np.uint64)
        assert len(near) == 2081
        of, anchor = simhash.anchors(near)
        own = set(simhash.anchors(np.array([value], np.uint64))[1].tolist())
        reached = {int(near[o]) for o, a in zip(of, anchor.tolist()) if a in own}
        assert reached == set(near.tolist())


def test_forest_has_the_components_of_all_links():
    draw = np.random.default_rng(3)
    for _ in range(30):
        base = draw.integers(0, 2**64, 3, np.uint64)
        flips = np.uint64(1) << draw.integers(0, 10, (40, 3), np.uint64)
        values = np.unique(base[draw.integers(0, 3, 40)] ^ np.bitwise_xor.reduce(flips, axis=1))
        pairs = [(i, j) for i in range(len(values)) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= 2]
        number = {int(v): i for i, v in enumerate(values)}
        tree = [(number[int(a)], number[int(b)]) for a, b in simhash.forest(values, 2)]
        assert len(tree) == len(values) - len(set(roots(pairs, len(values))))
        assert roots(tree, len(values)) == roots(pairs, len(values))


def test_links_over_batches(spark):
    draw = random.Random(4)
    values = {draw.getrandbits(64)}
    while len(values) < 900:
        value = draw.choice(sorted(values)) ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64))
        values.add(value if draw.random() < 0.7 else draw.getrandbits(64))
    values = np.array(sorted(values), np.uint64)
    nodes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long").repartition(3)
    number = {int(v): i for i, v in enumerate(values.view(np.int64))}
    edges = [(number[r["a"]], number[r["b"]]) for r in simhash.links(nodes).collect()]
    pairs = [(i, j) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2)]
    assert set(edges) <= set(pairs)
    assert roots(edges, len(values)) == roots(pairs, len(values))
    with pytest.raises(ValueError):
        simhash.links(nodes, threshold=3)


@pytest.mark.parametrize("pairs, n", [
    ([], 3), ([(1, 1)], 2), ([(0, 1), (1, 0), (1, 2)], 4), ([(i, i + 1) for i in range(60)], 61),
    ([(59 - i, 58 - i) for i in range(58)], 60), ([(0, i) for i in range(1, 50)], 50), ([(49, i) for i in range(49)], 50),
])
def test_components(spark, pairs, n):
    out = components(spark.createDataFrame(pairs + [(None, 0), (0, None)], "a long, b long")).collect()
    want = roots(pairs, n)
    linked = {v for a, b in pairs if a != b for v in (a, b)}
    assert sorted(map(tuple, out)) == sorted((v, want[v]) for v in linked)


def test_components_of_a_drawn_graph(spark):
    draw = random.Random(6)
    pairs = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)]
    want = roots(pairs, 400)
    for node, root in components(spark.createDataFrame(pairs, "a long, b long")).collect():
        assert want[node] == root


def test_classes_with_nulls_copies_and_empty_texts(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (3, text), (9, text + " tail"), (4, None), (2, ""), (7, " "), (8, "alone here now"), (8, "alone here now"),
            (None, text), (None, None), (None, "only a null id has this text")]
    out = simhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    of = {}
    for r in out:
        of.setdefault(r["doc_id"], set()).add(r["component_id"])
    near = int(np.bitwise_count(np.uint64(simhash.majority_bits(simhash.shingle_hashes(text))
                                          ^ simhash.majority_bits(simhash.shingle_hashes(text + " tail"))))) <= 2
    assert of == {5: {3}, 3: {3}, 9: {3 if near else 9}, 4: {2}, 2: {2}, 7: {2}, 8: {8}, None: {3, 2, None}}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.classes(empty).count() == 0


def test_keep_one_keeps_the_smallest_id(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text, 1), (3, text, 2), (3, text, 3), (None, text, 4), (6, "other words entirely", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _dropped int")
    kept = sorted(r["_dropped"] for r in simhash.keep_one(docs).collect())
    assert kept in ([2, 5], [3, 5])  # one of the two equal rows


def test_query_equals_all_pairs(spark, folder):
    rows = sorted((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in QUERIES["op8_simhash"](spark, folder).collect())
    prints = np.array([f for _, f, _ in rows], np.uint64)
    pairs = [(i, int(j)) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2)]
    assert [c for _, _, c in rows] == [rows[i][0] for i in roots(pairs, len(rows))]


def test_keep_one_decides_row_by_row(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(40)) for w in "ab")
    rows = [(5, a, "x"), (5, a, "x"), (5, b, "y"), (7, a, "z"), (None, b, "n"), (None, "lone words", "m"), (9, None, "o"), (8, " ", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    kept = sorted(tuple(r) for r in simhash.keep_one(docs).select("doc_id", "text", "_row").na.fill(-1, ["doc_id"]).collect())
    assert kept == [(-1, "lone words", "m"), (5, a, "x"), (5, b, "y"), (8, " ", "p")]
    assert simhash.keep_one(docs.limit(0)).count() == 0
