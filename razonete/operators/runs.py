"""Summaries of a run and the gate that fails it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Reasons that leave a document out without failing the run.
SOFT_REASONS = ("no_text", "empty_text")


class HardErrors(RuntimeError):
    """Documents failed for a reason that is not a soft one."""


def run_summary(results: DataFrame, batch_id: int) -> DataFrame:
    """Rows, distinct documents and rows of the given batch, in one pass over `document_name` and `batch_id`."""
    return results.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("document_name").alias("distinct_documents"),
        F.count_if(F.col("batch_id") == batch_id).alias("new_rows"))


def run_errors(rejects: DataFrame, soft: tuple[str, ...] = SOFT_REASONS) -> DataFrame:
    """Rejects per reason, and whether the reason is a hard one."""
    return (rejects.groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("document_name").alias("documents"))
            .withColumn("is_hard", ~F.col("reason").isin(*soft)))


def fail_on_hard_errors(errors: DataFrame) -> None:
    """Raise when `run_errors` holds a hard reason; the rejects themselves stay in their table."""
    found = errors.where("is_hard").agg(F.sum("n").alias("n"), F.count("*").alias("reasons")).first()
    if found["n"]:
        raise HardErrors(f"{found['n']} rejects for {found['reasons']} hard reasons")
