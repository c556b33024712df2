"""What a reviewer sees: document lists, details, labels and processing status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from razonete.functions.jsonops import path_get
from razonete.functions.text import format_money
from razonete.operators.upsert import latest

DEFAULT_ENTITY = "INDIVIDUAL"
MISSING = "—"


def document_list(statements: DataFrame, ordered: bool = True) -> DataFrame:
    """One row per document; any name will do, so the greatest is taken to be repeatable."""
    summary = statements.groupBy("document_name").agg(
        F.max("razao_social").alias("razao_social"),
        F.max("cnpj").alias("cnpj"),
        F.max("periodo").alias("periodo"),
        F.max("ativo_total").alias("ativo_total"),
        F.max("lucro_liquido").alias("lucro_liquido"))
    return summary.orderBy("document_name") if ordered else summary


def document_cards(summary: DataFrame) -> DataFrame:
    """What the list shows of each document: title, period, total assets in whole currency units."""
    return summary.select(
        "document_name", F.coalesce("razao_social", "document_name").alias("title"),
        F.when(F.col("periodo") != "", F.substring("periodo", 1, 10)).alias("period"),
        F.coalesce(format_money(F.col("ativo_total"), 0), F.lit(MISSING)).alias("assets"))


def document_detail(statements: DataFrame, document_name: str | None = None) -> DataFrame:
    """Records of one document (of all when none is named), entity type first, newest period first.

    The records are rows, not one array per document, so a document may have
    any number of them.
    """
    rows = statements if document_name is None else statements.where(F.col("document_name") == document_name)
    return (rows.select("document_name", "tipo_entidade", "periodo", "extracted_json")
                .orderBy("document_name", "tipo_entidade", F.col("periodo").desc()))


def default_record(statements: DataFrame) -> DataFrame:
    """The record shown first per document: least entity type, then newest period.

    Two combining aggregations instead of a window, so that no document's rows
    are sorted in one task.
    """
    rest = [c for c in statements.columns if c not in ("document_name", "tipo_entidade")]
    newest = statements.groupBy("document_name", "tipo_entidade").agg(
        F.max_by(F.struct(*rest), "periodo").alias("_row"))
    first = newest.groupBy("document_name").agg(
        F.min_by(F.struct("tipo_entidade", "_row"), "tipo_entidade").alias("_first"))
    return first.select("document_name", F.col("_first.tipo_entidade").alias("tipo_entidade"),
                        *[F.col(f"_first._row.{c}").alias(c) for c in rest])


def record_label(tipo_entidade: Column, periodo: Column) -> Column:
    period = F.when(periodo.isNull() | (periodo == ""), MISSING).otherwise(F.substring(periodo, 1, 10))
    return F.concat(F.coalesce(tipo_entidade, F.lit(DEFAULT_ENTITY)), F.lit(" · "), period)


def record_labels(statements: DataFrame) -> DataFrame:
    """Tab label of every record and the title of its document."""
    title = path_get(F.try_parse_json("extracted_json"), "razao_social")
    return statements.select(
        "document_name", "tipo_entidade", "periodo",
        record_label(F.col("tipo_entidade"), F.col("periodo")).alias("record_label"),
        F.coalesce(title, F.col("document_name")).alias("title"))


def statement_combos(rows: DataFrame) -> DataFrame:
    """The (entity type, period) pairs each document yielded, one row each, with their count."""
    return (rows.groupBy("document_name", "tipo_entidade", "periodo").agg(F.count("*").alias("n_records"))
                .orderBy("document_name", "tipo_entidade", "periodo"))


def latest_status(documents: DataFrame, log: DataFrame, order: list[str]) -> DataFrame:
    """Newest status per document, 'unknown' for a document without any."""
    newest = latest(log, ["document_name"], order)
    return (documents.select("document_name").join(newest, "document_name", "left")
            .withColumn("status", F.coalesce("status", F.lit("unknown"))))
