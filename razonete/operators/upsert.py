"""Merging batches into a keyed table without a row-level transactional format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from razonete.schemas import CORRECTION_KEY, CORRECTIONS, STATEMENT_KEY


def upsert(target: DataFrame, source: DataFrame, keys: list[str] = STATEMENT_KEY, force: bool = True) -> DataFrame:
    """Rows of `source` replace those of `target` with the same key, others are added.

    `source` must hold a key once (see `dedupe_batch`). With force=False keys
    already in `target` stay as they are. A key with a NULL part matches
    nothing. Spark broadcasts the key side by its measured size or sorts both;
    the anti join keeps no row of the key side beyond the first per key.
    """
    if force:
        kept = target.join(source.select(*keys), keys, "left_anti")
        return kept.unionByName(source.select(*target.columns))
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti").select(*target.columns))


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key of an append-only log, combined on the map side."""
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return log.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest_corrections(log: DataFrame) -> DataFrame:
    """Current corrections: newest by (criado_em, seq) per document and field.

    A missing `seq` counts as 0. An entry whose `op` is 'delete' removes the key
    until it is written again; any other `op`, and none, writes it.
    """
    if "seq" in log.columns:
        log = log.withColumn("seq", F.coalesce("seq", F.lit(0)))
    order = [c for c in ("criado_em", "seq") if c in log.columns]
    current = latest(log, CORRECTION_KEY, order)
    if "op" in log.columns:
        current = current.where(~F.col("op").eqNullSafe("delete")).drop("op")
    return current


def correction_entry(rows: DataFrame, op: str | None = "upsert") -> DataFrame:
    """Rows to append to the correction log: a write time and number where none is given, all columns of the table."""
    def given(name: str, kind: str, otherwise: Column) -> Column:
        return (F.coalesce(F.col(name), otherwise) if name in rows.columns else otherwise).cast(kind).alias(name)

    kinds = dict(column.split() for column in CORRECTIONS.split(", "))
    defaults = {"criado_em": F.current_timestamp(), "seq": F.lit(0)}
    columns = [given(name, kind, defaults.get(name, F.lit(None))) for name, kind in kinds.items() if name != "op"]
    return rows.select(*columns, F.lit(op).cast("string").alias("op"))


def corrections_of(current: DataFrame, document_name: str) -> DataFrame:
    """One document's corrections, newest first, the time as text."""
    return (current.where(F.col("document_name") == document_name)
                   .orderBy(F.col("criado_em").desc(), "campo")
                   .select("campo", "valor_extraido", "valor_correto", "comentario",
                           F.date_format("criado_em", "yyyy-MM-dd HH:mm:ss").alias("criado_em")))
