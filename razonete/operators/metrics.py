"""Review metrics over the current corrections and statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from razonete.sources.dictionary import NO_COMMENT

FIELDS_PER_ROW = 70


def metrics_totals(statements: DataFrame, corrections: DataFrame, fields_per_row: int = FIELDS_PER_ROW) -> DataFrame:
    """One row of totals. total_docs counts statement rows, distinct_docs documents.

    Both sides are counted on their own and the two rows added up, so the
    tables are never joined.
    """
    zero = F.lit(0).cast("bigint")
    of_statements = statements.agg(
        F.count("*").alias("total_docs"), F.count_distinct("document_name").alias("distinct_docs"),
        zero.alias("total_corrections"), zero.alias("docs_with_corrections"))
    of_corrections = corrections.agg(
        zero.alias("total_docs"), zero.alias("distinct_docs"),
        F.count("*").alias("total_corrections"), F.count_distinct("document_name").alias("docs_with_corrections"))
    names = ["total_docs", "distinct_docs", "total_corrections", "docs_with_corrections"]
    totals = of_statements.unionByName(of_corrections).agg(*[F.sum(n).alias(n) for n in names])
    reviewed = F.col("total_docs") * fields_per_row
    share = 1 - F.try_divide(F.col("total_corrections"), reviewed)
    return totals.select(
        *names,
        F.bround(share * 100, 1).alias("accuracy_pct"),
        (F.col("total_docs") - F.col("docs_with_corrections")).alias("docs_without_errors"))


def with_share(counts: DataFrame, value: str = "total") -> DataFrame:
    """Bar length: percent of the greatest value of the list (which is at least 1)."""
    top = counts.agg(F.greatest(F.max(value), F.lit(1))).scalar()
    return counts.withColumn("share_pct", F.col(value) / top * 100)


def metrics_by_field(corrections: DataFrame, limit: int = 15) -> DataFrame:
    """Fields corrected most, ties by name."""
    counts = corrections.groupBy("campo").agg(F.count("*").alias("total"))
    return with_share(counts).orderBy(F.col("total").desc(), "campo").limit(limit)


def metrics_by_type(corrections: DataFrame) -> DataFrame:
    """Corrections per comment; without one they count as undescribed."""
    tipo = F.when(F.coalesce("comentario", F.lit("")) == "", NO_COMMENT).otherwise(F.col("comentario"))
    counts = corrections.groupBy(tipo.alias("tipo")).agg(F.count("*").alias("total"))
    return with_share(counts).orderBy(F.col("total").desc(), "tipo")


def metrics_by_document(statements: DataFrame, corrections: DataFrame, limit: int = 10) -> DataFrame:
    """Documents with most corrections per company name, each correction counted
    once per matching statement row.

    Both sides are counted per key before they meet; the product of the counts
    is what the row-by-row join would have counted.
    """
    per_doc = corrections.groupBy("document_name").agg(F.count("*").alias("_n"))
    names = statements.groupBy("document_name", "razao_social").agg(F.count("*").alias("_rows"))
    joined = per_doc.join(names, "document_name", "left").select(
        "document_name", (F.col("_n") * F.coalesce("_rows", F.lit(1))).alias("corrections"), "razao_social")
    return joined.orderBy(F.col("corrections").desc(), "document_name", "razao_social").limit(limit)


def metrics_by_document_distinct(statements: DataFrame, corrections: DataFrame, limit: int = 10) -> DataFrame:
    """The same list with every correction counted once."""
    per_doc = corrections.groupBy("document_name").agg(F.count("*").alias("corrections"))
    names = statements.groupBy("document_name").agg(F.max("razao_social").alias("razao_social"))
    return (per_doc.join(names, "document_name", "left")
            .orderBy(F.col("corrections").desc(), "document_name").limit(limit))
