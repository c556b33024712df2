"""The pipeline: each stage's decisions, and the whole against its parts."""

import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline as pipeline
from razonete.llm import bpe, secrets, simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], COLUMNS)


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "decontaminate", "secrets", "tokens"]
    assert entry_points.queries()["pipeline"] is pipeline.run


def test_each_stage_keeps_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = docs.withColumn("score", F.lit(1)).withColumn("hits", F.lit("x")).withColumn("redacted", F.lit(2))
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, extra, folder)
        assert out.columns == extra.columns
        assert 0 < out.count() <= docs.count()
    assert pipeline.tokenize(spark, extra, folder).columns == ["doc_id", "n_tokens", "ids"]


def test_empty_input(spark, folder):
    empty = docs_of(spark, [])
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_near_duplicates_keep_one(spark, folder):
    text = " ".join(f"w{i}" for i in range(80))
    kept = pipeline.drop_near_duplicates(spark, docs_of(spark, [text, "other words", text, None, ""]), folder).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 1, 3]


def test_near_duplicates_equal_all_pairs_of_fingerprints(spark, folder):
    """One document, that of the smallest id, of each group linked by fingerprints within two bits."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = [simhash.majority_bits(simhash.shingle_hashes(r["text"])) for r in rows]
    kept, reached = [], set()
    for i, r in enumerate(rows):
        if i in reached:
            continue
        kept.append(r["doc_id"])
        front = [i]
        while front:
            at = front.pop()
            near = [j for j in range(len(rows)) if j not in reached and (prints[at] ^ prints[j]).bit_count() <= 2]
            reached.update(near)
            front += near
    found = pipeline.drop_near_duplicates(spark, docs, folder)
    assert sorted(r["doc_id"] for r in found.collect()) == kept
    assert found.columns == docs.columns


def test_contaminated_documents_go_and_clean_ones_stay(spark, folder):
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = " ".join(f"w{i}" for i in range(4000))
    kept = pipeline.drop_contaminated(spark, docs_of(spark, [item, clean, f"x {item} y", f"{clean} {item}", None]), folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_secrets_are_replaced(spark, folder):
    rows = pipeline.redact_secrets(spark, docs_of(spark, ["a token=abcdefgh b", "clean", None, ""]), folder).collect()
    assert [(r["text"], r["n_chars"]) for r in sorted(rows)] == [("a [secret] b", 12), ("clean", 5), (None, None), ("", 0)]


def test_whole_run_equals_the_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
    texts = dict(docs.select("doc_id", "text").collect())
    assert not any(secrets.base_spans(t) for t in texts.values())
    of = bpe.encoding(bpe.RANKS, public_tokenizers.PATTERN)
    rows = pipeline.run(spark, folder).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {d: of.encode_ordinary(t) for d, t in texts.items()}
    assert len(rows) == len(texts)
