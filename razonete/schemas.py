"""Declared schemas of the tables the jobs hand to each other."""

from __future__ import annotations

from pyspark.sql import SparkSession

RAW_FILES = "path string, content binary"

PARSER_OUTPUT = "struct<document: struct<elements: array<struct<content: string>>>, error_status: string>"

# `version` names a file as it was read: its path, length and modification time.
# `digest` is that of the text: files with one text are asked about once, however often they are written or copied.
PARSED_TEXT = "path string, version string, raw_parsed string, ingested_at timestamp, digest string"
PARSE_ERRORS = "path string, version string, error_status string, reason string, seen_at timestamp"

EXTRACTED = ("path string, version string, raw_parsed string, extracted string, error_message string, "
             "extracted_at timestamp, answer_id string, digest string")

CALL_RESPONSE = "result string, errorMessage string, attempts int"

STATEMENTS = ("document_name string, tipo_entidade string, periodo string, extracted_json string, "
              "razao_social string, cnpj string, ativo_total double, lucro_liquido double, answer_id string, processed_at timestamp")
STATEMENT_KEY = ["document_name", "tipo_entidade", "periodo"]

CORRECTIONS = ("document_name string, campo string, valor_extraido string, valor_correto string, "
               "comentario string, criado_em timestamp, seq bigint, op string")
CORRECTION_KEY = ["document_name", "campo"]

REJECTS = "document_name string, path string, answer_id string, pos int, reason string"

STATUS_LOG = "document_name string, status string, step string, detail string, records bigint, at timestamp"


def ensure_tables(spark: SparkSession, database: str) -> None:
    """Create the result and correction tables when missing; rerunning is harmless.

    `criado_em` carries a column default, so a partial insert that leaves it
    out still gets a timestamp instead of a NULL that would sort last.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.statements ({STATEMENTS}) USING parquet")
    columns = CORRECTIONS.replace("criado_em timestamp", "criado_em timestamp DEFAULT current_timestamp()")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.corrections ({columns}) USING parquet")
