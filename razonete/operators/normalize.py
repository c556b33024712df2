"""Model answers to statement rows, with a reason for every answer left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from razonete.functions.jsonops import (
    as_records, computed_once, parse_column, parse_failure, path_get, read_fields, safe_double, strip_fences,
    text_at, to_double_sql, unwrap_envelope)
from razonete.functions.text import basename
from razonete.schemas import STATEMENT_KEY

REASONS = ["no_answer", "bad_json", "call_error", "null_result", "no_records", "parse_failed", "bad_record"]


def answers(extracted: DataFrame, keep_text: bool = False) -> DataFrame:
    """(path, extracted) -> document_name, path, answer VARIANT, reason. Parses each text once.

    An `answer_id` goes along. No answer at all, as of a failed call, has its own reason.
    """
    named = extracted.select(basename(F.col("path")).alias("document_name"), "path", *_answer_id(extracted),
                             strip_fences(F.col("extracted")).alias("text"))
    parsed = unwrap_envelope(parse_column(named, "text", "_value"), "_value", "answer", "reason").drop("_value")
    parsed = parsed.withColumn("reason", F.when(F.col("text").isNull(), "no_answer").otherwise(F.col("reason")))
    return parsed if keep_text else parsed.drop("text")


def _answer_id(df: DataFrame) -> list[str]:
    return [c for c in ("answer_id",) if c in df.columns]


def records(extracted: DataFrame) -> DataFrame:
    """One row per record of each answer, tagged: reason NULL means a statement.

    Only rows explode here and nothing is shuffled: a document's records stay
    in the partition its answer was read in.
    """
    exploded = (answers(extracted)
                .select("document_name", "path", *_answer_id(extracted), F.col("reason").alias("_failed"),
                        F.posexplode_outer(as_records(F.col("answer"))).alias("pos", "record")))
    tagged = computed_once(exploded, "extracted_json", F.to_json("record"))
    reason = (F.when(F.col("_failed").isNotNull(), F.col("_failed"))
               .when(F.col("record").isNull(), "no_records")
               .when(path_get(F.col("record"), "error") == "parse_failed", "parse_failed")
               .when(~F.col("extracted_json").startswith("{"), "bad_record"))
    return tagged.withColumn("reason", reason).drop("_failed")


def statement_columns(record: Column) -> list[Column]:
    return [
        text_at(record, "tipo_entidade").alias("tipo_entidade"),
        text_at(record, "identificacao.periodo").alias("periodo"),
        F.col("extracted_json"),
        text_at(record, "razao_social").alias("razao_social"),
        text_at(record, "cnpj").alias("cnpj"),
        safe_double(record, "ativo_total").alias("ativo_total"),
        safe_double(record, "dre.lucro_liquido").alias("lucro_liquido"),
    ]


def statements_of(tagged: DataFrame) -> DataFrame:
    """The statement rows of `records`, still with path and pos for deduplication."""
    return (tagged.where(F.col("reason").isNull())
                  .select("document_name", *statement_columns(F.col("record")), *_answer_id(tagged), "path", "pos"))


def rejects_of(tagged: DataFrame) -> DataFrame:
    return (tagged.where(F.col("reason").isNotNull())
                  .select("document_name", "path", *_answer_id(tagged), F.coalesce("pos", F.lit(0)).alias("pos"), "reason"))


def normalize(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(statements, rejects). Both read `extracted`; write it first if it is costly."""
    tagged = records(extracted)
    return statements_of(tagged), rejects_of(tagged)


def dedupe_batch(rows: DataFrame, keys: list[str] = STATEMENT_KEY, order: tuple[str, ...] = ("path", "pos")) -> DataFrame:
    """Keep the last row per key, the one sequential merges would leave behind.

    max_by combines on the map side, so a key that holds a third of the batch
    reaches its reducer as one row per task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


# The flat columns of a statement and the paths they come from.
FLAT_TEXTS = {
    "razao_social": "razao_social",
    "cnpj": "cnpj",
    "periodo": "identificacao.periodo",
    "tipo_demonstrativo": "identificacao.tipo_demonstrativo",
    "moeda": "identificacao.moeda",
    "escala_valores": "identificacao.escala_valores",
}
FLAT_NUMBERS = {
    "ativo_circulante_total": "ativo_circulante.total_ativo_circulante",
    "ativo_nao_circulante_total": "ativo_nao_circulante.total_ativo_nao_circulante",
    "ativo_permanente_total": "ativo_permanente.total_ativo_permanente",
    "ativo_total": "ativo_total",
    "passivo_circulante_total": "passivo_circulante.total_passivo_circulante",
    "passivo_nao_circulante_total": "passivo_nao_circulante.total_passivo_nao_circulante",
    "patrimonio_liquido_total": "patrimonio_liquido.total_patrimonio_liquido",
    "passivo_total": "passivo_total",
    "receita_operacional_bruta": "dre.receita_operacional_bruta",
    "receita_operacional_liquida": "dre.receita_operacional_liquida",
    "lucro_bruto": "dre.lucro_bruto",
    "lucro_operacional": "dre.lucro_operacional",
    "lucro_antes_imposto_de_renda": "dre.lucro_antes_imposto_de_renda",
    "lucro_liquido": "dre.lucro_liquido",
    "despesas_financeiras": "dre.despesas_financeiras",
    "receitas_financeiras": "dre.receitas_financeiras",
}


def flatten_statement(statements: DataFrame) -> DataFrame:
    """Main fields of each record as typed columns, read in one pass over its text."""
    paths = [*FLAT_TEXTS.values(), *FLAT_NUMBERS.values()]
    read = read_fields(statements, paths, ["document_name", "extracted_json"])
    texts = [f"raw_{i} AS {name}" for i, name in enumerate(FLAT_TEXTS)]
    numbers = [f"coalesce({to_double_sql(f'raw_{i}')}, truth_{i}) AS {name}"
               for i, name in enumerate(FLAT_NUMBERS, len(FLAT_TEXTS))]
    return read.selectExpr("document_name", "extracted_json", *texts, *numbers)


def tag_parse_failures(extracted: DataFrame) -> DataFrame:
    """Answers that are no JSON, replaced by the one-record answer that says so."""
    tagged = answers(extracted, keep_text=True).where("reason = 'bad_json'")
    return tagged.select("document_name", "path", parse_failure(F.col("text")).alias("extracted"))
