"""A query for each operator over the whole of its table."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from razonete.llm import (
    bpe, centroids, decontaminate, divergence, langid, lm, minhash, repeats, ring, rules, secrets, simhash, toxicity)
from razonete.llm.common import add_columns, documents, id_remainder
from razonete.session import configure

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _ids_digest(column: pa.Array) -> list[pa.Array]:
    """SHA-256 of each list of ids, as little-endian unsigned 32-bit numbers."""
    values, ends = column.flatten().to_numpy().astype("<u4"), np.cumsum([0, *column.value_lengths().to_pylist()])
    return [pa.array([hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:])], pa.string())]


@query
def op1_bpe(spark, folder):
    encoded = bpe.encode(documents(spark, folder, "doc_id", "text")).select("doc_id", "ids")
    decoded = add_columns(bpe.decode(encoded), "ids", "ids_sha256 string", _ids_digest)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_secrets(spark, folder):
    found = secrets.find(documents(spark, folder, "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


@query
def op3_decontaminate(spark, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.find(documents(spark, folder, "doc_id", "text"), items).withColumn("n_hit", decontaminate.covered("hits"))
    ids = F.array_sort(F.array_distinct("hits.item"))
    return found.select("doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
                        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


ORACLE["op3_decontaminate"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS k FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS t
        FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM sized)),
sizes AS (SELECT DISTINCT k FROM win),
grams AS (SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS t
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes)),
hit AS (SELECT doc_id, p, k, item FROM grams JOIN win USING (k, t)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit)
            GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op8_simhash(spark, folder):
    found = simhash.classes(documents(spark, folder, "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op5_repeats(spark, folder):
    kept = repeats.remove(documents(spark, folder, "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op5_repeats"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, p, hash(list_slice(w, p, p + 49)) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
least AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM win JOIN least USING (h) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op10_shards(spark, folder):
    placed = ring.shard_documents(documents(spark, folder, "doc_id", "text"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_toxicity(spark, folder):
    docs = documents(spark, folder, "doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(id_remainder("doc_id", 3) != 1))
    return toxicity.score(docs, model).select(
        "doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"))


@query
def op7_minhash(spark, folder):
    docs = documents(spark, folder, "doc_id", "text")
    compared = minhash.compare_in_order(docs).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next", "node")
    named = minhash.name_classes(compared, minhash.classes(docs))
    return named.withColumn("class_id", F.coalesce("class_id", "doc_id")).drop("node")


@query
def op6_langid(spark, folder):
    known = documents(spark, folder, "doc_id", "text", "lang").where(id_remainder("doc_id", 4) != 2)
    found = langid.predict(documents(spark, folder, "doc_id", "text"), langid.fit(known))
    return found.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "bits", "rejected")


@query
def op4_lm(spark, folder):
    docs = documents(spark, folder, "doc_id", "text")
    model = lm.fit(docs.where(id_remainder("doc_id", 10) != 0))
    return lm.score(docs, model).select(
        "doc_id", (id_remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


@query
def op11_centroids(spark, folder):
    return centroids.cluster(configure(spark).read.parquet(f"{folder}/embeddings.parquet"))


def _rounds() -> str:
    """SQL for the rounds: tables a0, c1, a1, ..., of nearest centroids and of the centroids they give."""
    nearest = """a{i} AS (SELECT r, any_value(vec_id) AS vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, any_value(vec_id) AS vec_id, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d
    FROM x JOIN c{i} USING (k) GROUP BY r, c) GROUP BY r)"""
    means = """m{i} AS (SELECT c, k, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{i} USING (r) GROUP BY c, k),
c{j} AS (SELECT c{i}.c, c{i}.k, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y
         FROM c{i} LEFT JOIN m{i} ON m{i}.c = c{i}.c AND m{i}.k = c{i}.k)"""
    rounds = range(centroids.ROUNDS)
    return ",\n".join([*(f"{nearest.format(i=i)},\n{means.format(i=i, j=i + 1)}" for i in rounds), nearest.format(i=centroids.ROUNDS)])


ORACLE["op11_centroids"] = f"""
WITH v AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), ''))) AS r
           FROM embeddings WHERE len(embedding) = {centroids.DIMENSIONS}
             AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {centroids.DIMENSIONS}),
x AS (SELECT r, vec_id, k, CAST(floor({centroids.SCALE} * CAST(e AS DOUBLE)) AS BIGINT) AS x
      FROM (SELECT r, vec_id, unnest(embedding) AS e, unnest(range({centroids.DIMENSIONS})) AS k FROM v)),
c0 AS (SELECT r - 1 AS c, k, x AS y FROM x WHERE r <= {centroids.CENTROIDS}),
{_rounds()},
digests AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY k)) AS centroid_sha256 FROM c{centroids.ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{centroids.ROUNDS} JOIN digests USING (c)
"""


@query
def op13_quality(spark, folder):
    judged = rules.judge(documents(spark, folder, "doc_id", "text"))
    base = F.arrays_overlap("broken", F.array(*[F.lit(rule.name) for rule in rules.BASE_RULES]))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), "kept", "n_lines", "n_marks", "n_stop_words",
                         F.array_join("broken", ", ").alias("broken"))


def _broken_sql(rule: rules.Rule) -> str:
    value, unit = (rule.measure, "1") if rule.per is None else (f"100 * {rule.measure}", rule.per)
    parts = [f"{value} < {rule.least} * {unit}"] * (rule.least is not None) + [f"{value} > {rule.most} * {unit}"] * (rule.most is not None)
    return f"CASE WHEN {' OR '.join(parts)} THEN '{rule.name}' END"


ORACLE["op13_quality"] = rf"""
WITH d AS (SELECT doc_id, t, regexp_extract_all(t, '[^ 	-
]+') AS w,
                  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ 	-
]')) AS l
           FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
runs AS (SELECT doc_id, p, array_to_string(list_slice(w, p, p + {rules.WINDOW - 1}), ' ') AS run
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - {rules.WINDOW - 2})) AS p FROM d)),
twice AS (SELECT doc_id, run FROM runs GROUP BY doc_id, run HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
    SELECT doc_id, unnest(range(p, p + {rules.WINDOW})) AS q FROM runs JOIN twice USING (doc_id, run)) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '{rules.SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(t) - length(regexp_replace(t, '{rules.MARKS}', '', 'g')) AS BIGINT) AS n_marks,
             CAST(len(list_filter(w, lambda x: list_contains([{', '.join(f"'{word}'" for word in dict.fromkeys(rules.STOP_WORDS))}],
                                                             lower(rtrim(x, '{rules.CLOSING}'))))) AS BIGINT) AS n_stop_words,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, concat_ws(', ', {', '.join(map(_broken_sql, rules.RULES))}) AS broken FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, broken = '' AS kept,
       n_lines, n_marks, n_stop_words, broken
FROM judged
"""


@query
def op12_divergence(spark, folder):
    return divergence.audit(documents(spark, folder, "lang", "source", "text"))


ORACLE["op12_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM u GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCUMENTS}),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM u JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, k.total,
             1 + CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 2) // (coalesce(sizes.n, 0) + 2 * l.v) AS p,
             1 + CAST(1000000000 AS HUGEINT) * (k.total + 2) // (l.n + 2 * l.v) AS q
      FROM groups g JOIN kept k ON k.lang = g.lang JOIN l ON l.lang = g.lang
           LEFT JOIN sizes ON sizes.lang = g.lang AND sizes.source = g.source
           LEFT JOIN counts ON counts.lang = g.lang AND counts.source = g.source AND counts.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
         FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value,
                  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
           UNION ALL
           SELECT lang, source, 'term' AS part, item, value,
                  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""
