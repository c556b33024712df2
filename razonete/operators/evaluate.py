"""Evaluation and tuning datasets from reviewed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from razonete.functions.jsonops import computed_once, path_get
from razonete.functions.scoring import score_balance, score_field, score_structure
from razonete.functions.text import preview
from razonete.operators.joins import join_unique
from razonete.operators.review import default_record

MIN_CORRECTED_DOCUMENTS = 5

# Wording of the notes and of the answer a tuning example asks for.
NOTE = "- Campo '%s': deve ser '%s' (era '%s'). %s"
EXPECTED_HEAD = "A extração deve corrigir os seguintes campos:\n"
EXPECTED_TAIL = "\nOs demais campos devem ser extraídos normalmente seguindo o schema."


def _text(max_chars: int | None):
    text = F.col("document_text")
    return preview(text, max_chars) if max_chars else text


def first_corrections(corrections: DataFrame) -> DataFrame:
    """One correction per document, the least field name."""
    return corrections.groupBy("document_name").agg(
        F.min_by(F.struct("campo", "valor_correto"), "campo").alias("_first")
    ).select("document_name", "_first.campo", "_first.valor_correto")


def evaluation_set(documents: DataFrame, statements: DataFrame, corrections: DataFrame,
                   max_chars: int | None = None) -> DataFrame:
    """inputs, outputs and expectations of every document.

    outputs is the document's first record, '{}' without one; expectations is
    NULL without a correction. Each right side holds a document once.
    """
    outputs = default_record(statements.select("document_name", "tipo_entidade", "periodo", "extracted_json"))
    joined = (documents.select("document_name", _text(max_chars).alias("text"))
              .join(outputs.select("document_name", "extracted_json"), "document_name", "left")
              .join(first_corrections(corrections), "document_name", "left"))
    return joined.select(
        F.struct("text", "document_name").alias("inputs"),
        F.coalesce("extracted_json", F.lit("{}")).alias("outputs"),
        F.when(F.col("campo").isNotNull(), F.struct("campo", "valor_correto")).alias("expectations"))


def evaluation_scores(records: DataFrame) -> DataFrame:
    """Long form: document_name, metric, value, rationale of the three scores."""
    parsed = computed_once(records.select(F.col("inputs.document_name").alias("document_name"), "outputs", "expectations"),
                           "record", F.try_parse_json("outputs"))
    extracted = path_get(F.col("record"), F.col("expectations.campo"))
    scores = F.array(
        score_structure(F.col("outputs")),
        score_balance(F.col("record")),
        score_field(extracted, F.col("expectations.valor_correto"), F.col("expectations").isNotNull()))
    return (parsed.select("document_name", F.inline(scores))
            .withColumnRenamed("name", "metric"))


def evaluation_metrics(scores: DataFrame) -> DataFrame:
    """Mean of each score; unscored rows count in n but not in the mean."""
    return scores.groupBy("metric").agg(
        F.avg(F.col("value").cast("double")).alias("mean"),
        F.count("value").alias("n_scored"), F.count("*").alias("n"))


def score_corrections(statements: DataFrame, corrections: DataFrame) -> DataFrame:
    """Every correction scored against its document's first record.

    A document's record is parsed before it meets the corrections, and only the
    value at each correction's field is read from it.
    """
    outputs = default_record(statements.select("document_name", "tipo_entidade", "periodo", "extracted_json"))
    parsed = computed_once(outputs.select("document_name", "extracted_json"), "record", F.try_parse_json("extracted_json"))
    joined = join_unique(corrections.select("document_name", "campo", "valor_correto"),
                         parsed.select("document_name", "record"), "document_name", "left")
    found = computed_once(joined, "_found", path_get(F.col("record"), F.col("campo"))).drop("record")
    return (found.withColumn("_score", score_field(F.col("_found"), F.col("valor_correto")))
            .select("document_name", "campo", F.col("_score.name").alias("metric"),
                    F.col("_score.value").alias("value"), F.col("_score.rationale").alias("rationale")))


def tuning_set(documents: DataFrame, corrections: DataFrame, max_chars: int | None = None) -> DataFrame:
    """inputs and the expected response of every corrected document that has a text: one example each, with all notes.

    `corrections` holds a field once per document, so a document's notes are
    bounded by its fields. Both sides of the join hold a document once.
    """
    note = F.format_string(NOTE, "campo", F.coalesce("valor_correto", F.lit("")),
                           F.coalesce("valor_extraido", F.lit("")), F.coalesce("comentario", F.lit("")))
    notes = (corrections.select("document_name", "campo", note.alias("note"))
             .groupBy("document_name").agg(F.expr("listagg(note, '\\n') WITHIN GROUP (ORDER BY campo)").alias("notes")))
    texts = documents.select("document_name", _text(max_chars).alias("text"))
    return notes.join(texts, "document_name").select(
        F.struct("text", "document_name").alias("inputs"),
        F.struct(F.concat(F.lit(EXPECTED_HEAD), "notes", F.lit(EXPECTED_TAIL)).alias("expected_response"))
         .alias("expectations"))


def tuning_readiness(documents: DataFrame, corrections: DataFrame,
                     min_docs: int = MIN_CORRECTED_DOCUMENTS) -> DataFrame:
    """Whether enough documents with a text were corrected, and how many are missing."""
    corrected = corrections.select("document_name").distinct()
    counted = corrected.join(documents.select("document_name"), "document_name").agg(
        F.count_distinct("document_name").alias("corrected_docs"))
    shortfall = F.greatest(F.lit(min_docs) - F.col("corrected_docs"), F.lit(0))
    return counted.select("corrected_docs", (F.col("corrected_docs") >= min_docs).alias("ready"),
                          shortfall.cast("bigint").alias("missing_docs"))
