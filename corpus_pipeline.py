"""From raw documents to token ids: toxic texts out, near-duplicates out, benchmark passages out, secrets out, encoded.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns they came with; the last returns the ids of each document's tokens.
A stage sees only what the one before has kept. `run` writes every stage to the
shared work folder and reads it again, so that a lost executor costs no more than
the stage it was in.

Null texts have no words and no tokens. They pass all stages but the second: all
documents without words have the same fingerprint there, so one of them stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from razonete.llm import bpe, decontaminate, secrets, simhash, toxicity
from razonete.llm.common import free_name, saved
from razonete.session import configure

# Whole model-made texts cannot be put into SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the limit, by a model learned from the labelled ones among them."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    score = free_name(docs, "score")
    return toxicity.score(docs, model, name=score).where(F.col(score) < toxicity.TOXIC).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of three-word shingles that differ in two bits at most."""
    configure(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words from windows of the benchmark."""
    items = configure(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    hits, n_words = free_name(docs, "hits"), free_name(docs, "n_words")
    found = decontaminate.find(docs, items, hits=hits, n_words=n_words)
    return found.where(~decontaminate.is_contaminated(decontaminate.covered(hits), F.col(n_words))).drop(hits, n_words)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark, n_chars counted anew."""
    configure(spark)
    redacted = free_name(docs, "redacted")
    found = secrets.redact(docs, redacted=redacted)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col(redacted).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(
            F.length(redacted)).cast(docs.schema["n_chars"].dataType))
    return found.withColumn("text", F.col(redacted)).drop(redacted)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids)."""
    configure(spark)
    encoded = bpe.encode(docs.select("doc_id", "text"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all documents."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
