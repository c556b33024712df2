"""Source divergence against plain Python, and the skyband against all dominances."""

import collections
import random
import re

from razonete.llm import divergence
from razonete.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def expected(rows, min_documents=10, top=10):
    counts, docs, groups = collections.Counter(), collections.Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = ["".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or "")]
        counts.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for (of, t), n in docs.items() if of == lang and n >= min_documents]
        sources = sorted(s for of, s in groups if of == lang)

        def shares(names):
            own = {t: sum(counts[lang, s, t] for s in names) for t in kept}
            total = sum(own.values())
            return {t: 1 + 10**9 * (n + 2) // (total + 2 * len(kept)) for t, n in own.items()}

        own, whole = shares([source]), shares(sources)

        def ranked(part, values):
            order = sorted(values, key=lambda v: (-v[1], v[0].encode()))
            return {(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(order, 1)}

        others = {s: shares([s]) for s in sources if s != source}
        out |= ranked("pair", [(s, sum((own[t] - q[t]) ** 2 // (own[t] + q[t]) for t in kept)) for s, q in others.items()])
        used = [(t, (own[t] - whole[t]) ** 2 // (own[t] + whole[t])) for t in kept if counts[lang, source, t] and own[t] > whole[t]]
        out |= {r for r in ranked("term", used) if r[-1] <= top}
    return out


def found(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_plain_counts(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "source", "text").collect()]
    assert found(QUERIES["op12_divergence"](spark, folder)) == expected(rows)


def test_odd_rows_ties_and_long_texts(spark):
    draw = random.Random(8)
    words = ["a", "B", "b", "é", "É", "zz", "日本", "x-y", "𝄞", "ab1c"]
    rows = [(draw.choice(["en", None, "fr"]), draw.choice(["s", None, "t", "u"]), " ".join(draw.choices(words, k=draw.randrange(30))))
            for _ in range(120)]
    rows += [("xx", "s", "too few"), ("xx", "t", None), ("yy", "s", ""), (None, None, None), ("en", "long", "word " * 40_000), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "lang string, source string, text string, n int, term string")
    for least, top in ((10, 10), (1, 2)):
        assert found(divergence.audit(docs, min_documents=least, top=top)) == expected(rows, least, top)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_skyband_equals_all_dominances(spark):
    draw = random.Random(4)
    rows = [("en", draw.choice("st"), f"t{draw.randrange(10**6):06}", draw.randrange(1, 40), draw.randrange(40, 90)) for _ in range(800)]
    rows = list({(r[1], r[2]): r for r in rows}.values())
    df = spark.createDataFrame(rows, "lang string, source string, term string, n long, total long")
    once = {tuple(r) for r in divergence.skyband(df.repartition("lang", "source"), 3).collect()}
    assert once == {r for r in rows if sum(
        o[1] == r[1] and o[3] >= r[3] and o[4] <= r[4] and o[2] < r[2] for o in rows) < 3}
    parts = divergence.skyband(df.repartition(4), 3)
    assert parts.count() < len(rows)
    assert {tuple(r) for r in divergence.skyband(parts.repartition("lang", "source"), 3).collect()} == once


def test_shares_are_exact_for_large_counts(spark):
    for count, size in ((0, 2), (10**14, 3 * 10**14), (3 * 10**14 - 3, 3 * 10**14 - 1), (10**9, 10**9 + 2)):
        exact = 1 + 10**9 * (count + 2) // size
        assert int(divergence.shares(divergence.np.array([count]), divergence.np.array([size]))[0]) == exact
        assert spark.sql(f"SELECT {divergence.share(f'{count}L', f'{size}L')}").first()[0] == exact
