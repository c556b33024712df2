"""Corrected statements in long and wide form, corrections and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from razonete.functions.jsonops import computed_once, read_fields, to_double_sql
from razonete.operators.joins import join_unique
from razonete.schemas import STATEMENT_KEY
from razonete.sources.dictionary import FIELDS, LAST_SECTION, PATHS, Field, sections_df, with_label


def corrections_by_document(corrections: DataFrame) -> DataFrame:
    """document_name, corrections (count of all), fixes MAP<path, value>.

    `corrections` holds a field once per document, and the map takes dictionary
    fields only, so a map has at most 81 entries.
    """
    known = F.when(F.col("campo").isin(PATHS), F.struct("campo", "valor_correto"))
    return corrections.groupBy("document_name").agg(
        F.count("*").alias("corrections"), F.map_from_entries(F.collect_list(known)).alias("fixes"))


def _with_fixes(statements: DataFrame, corrections: DataFrame) -> DataFrame:
    """Statements with their document's fixes: one join for all fields."""
    return join_unique(statements.select(*STATEMENT_KEY, "extracted_json"), corrections_by_document(corrections),
                       "document_name", "left")


# The per-field expressions below are SQL text: one call builds all columns.

def _is_fixed(field: Field) -> str:
    return f"coalesce(map_contains_key(fixes, '{field.path}'), false)"


def _fix(field: Field) -> str:
    return f"try_element_at(fixes, '{field.path}')"


def overlay(statements: DataFrame, corrections: DataFrame, fields: list[Field] = FIELDS) -> DataFrame:
    """Long form: a row per statement and field that has a value or a correction.

    The corrected value wins. A number field gives value_num, or value_text
    where the value is no number; other fields give value_text.
    """
    def cell(i: int, f: Field) -> str:
        return (f"CASE WHEN raw_{i} IS NOT NULL OR {_is_fixed(f)} THEN named_struct('ord', {f.ord}, 'path', '{f.path}', "
                f"'is_number', {f.is_number}, 'raw', raw_{i}, 'truth', truth_{i}, 'fix', {_fix(f)}, "
                f"'corrected', {_is_fixed(f)}) END")

    present = f"array_compact(array({', '.join(cell(i, f) for i, f in enumerate(fields))}))"
    read = read_fields(_with_fixes(statements, corrections), [f.path for f in fields], [*STATEMENT_KEY, "fixes"])
    # The outer form: for the plain one Spark would build the array once more in a filter on its size.
    cells = read.selectExpr(*STATEMENT_KEY, f"inline_outer({present})").where("path IS NOT NULL")
    texts = cells.selectExpr(*STATEMENT_KEY, "ord", "path", "is_number", "corrected",
                             "CASE WHEN corrected THEN fix ELSE raw END AS text",
                             "CASE WHEN NOT corrected THEN truth END AS truth")
    numbers = texts.withColumn("value_num", F.expr(f"CASE WHEN is_number THEN coalesce({to_double_sql('text')}, truth) END"))
    return numbers.selectExpr(*STATEMENT_KEY, "ord", "path", "CASE WHEN value_num IS NULL THEN text END AS value_text",
                              "value_num", "corrected")


def export_wide(statements: DataFrame, corrections: DataFrame, ordered: bool = True) -> DataFrame:
    """One row per statement: key, a column per field, number of corrections (NULL for none).

    Number columns are DOUBLE; values that are no numbers go, keyed by path, into
    the JSON object `text_cells` instead of being lost.
    """
    numbers = [(i, f) for i, f in enumerate(FIELDS) if f.is_number]

    def value(i: int, f: Field) -> str:
        if not f.is_number:
            return f"coalesce(text_{i}, CASE WHEN NOT fixed_{i} THEN '' END) AS {f.column}"
        return f"coalesce({to_double_sql(f'text_{i}')}, CASE WHEN NOT fixed_{i} THEN truth_{i} END) AS {f.column}"

    joined = _with_fixes(statements, corrections)
    if ordered:
        # Sorted before the columns are made: the sort's sampling pass does not
        # compute them, and the projections that follow keep the order.
        joined = joined.orderBy(*STATEMENT_KEY)
    read = read_fields(joined, [f.path for f in FIELDS], [*STATEMENT_KEY, "corrections", "fixes"])
    texts = read.selectExpr(
        *STATEMENT_KEY, "corrections", *[f"truth_{i}" for i, _ in numbers],
        *[f"{_is_fixed(f)} AS fixed_{i}" for i, f in enumerate(FIELDS)],
        *[f"CASE WHEN {_is_fixed(f)} THEN {_fix(f)} ELSE raw_{i} END AS text_{i}" for i, f in enumerate(FIELDS)])
    valued = texts.selectExpr(*STATEMENT_KEY, *[value(i, f) for i, f in enumerate(FIELDS)], "corrections",
                              *[f"text_{i}" for i, _ in numbers])
    left_over = ", ".join(f"CASE WHEN {f.column} IS NULL AND text_{i} IS NOT NULL "
                          f"THEN named_struct('key', '{f.path}', 'value', text_{i}) END" for i, f in numbers)
    return (valued.withColumn("left_over", F.expr(f"array_compact(array({left_over}))"))
            .selectExpr(*STATEMENT_KEY, *[f.column for f in FIELDS], "corrections",
                        "CASE WHEN size(left_over) > 0 THEN to_json(map_from_entries(left_over)) END AS text_cells"))


def export_corrections(corrections: DataFrame) -> DataFrame:
    return (corrections.select("document_name", "campo", "valor_extraido", "valor_correto", "comentario")
            .orderBy("document_name", "campo"))


def provenance_entries(statements: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per entry of the `fontes` object of each statement; '' for an empty text.

    Ordered means by statement and path: the statements are sorted, not their
    entries, whose order within a statement is that of the sorted array.
    """
    fontes = F.try_variant_get(F.try_parse_json("extracted_json"), "$.fontes", "map<string, string>")
    entries = computed_once(statements, "entries", F.sort_array(F.map_entries(fontes))).select(*STATEMENT_KEY, "entries")
    if ordered:
        entries = entries.orderBy(*STATEMENT_KEY)
    return (entries.select(*STATEMENT_KEY, F.inline("entries")).withColumnsRenamed({"key": "path", "value": "fonte"})
            .withColumn("fonte", F.coalesce("fonte", F.lit(""))))


def export_provenance(statements: DataFrame, ordered: bool = True) -> DataFrame:
    return with_label(provenance_entries(statements, ordered)).select(*STATEMENT_KEY, "label", "fonte", "path")


def provenance_by_section(statements: DataFrame) -> DataFrame:
    """Provenance entries per document and section, in display order.

    Entries without a dot in their path come first, unknown sections last.
    """
    section = F.when(F.col("path").contains("."), F.substring_index("path", ".", 1)).otherwise(F.lit(""))
    counts = (provenance_entries(statements).groupBy("document_name", section.alias("section"))
              .agg(F.count("*").alias("n_entries")))
    sections = F.broadcast(sections_df(statements.sparkSession))
    return (counts.join(sections, "section", "left")
            .withColumn("section_ord", F.coalesce("section_ord", F.lit(LAST_SECTION)))
            .withColumn("section_label", F.coalesce("section_label", "section"))
            .orderBy("document_name", "section_ord", "section"))


def provenance_panel(statements: DataFrame, document_name: str) -> DataFrame:
    """The entries of one document as shown beside its fields."""
    rows = provenance_entries(statements.where(F.col("document_name") == document_name), ordered=True)
    return with_label(rows, which="panel_label")


def write_export(statements: DataFrame, corrections: DataFrame, folder: str, format_: str = "csv") -> None:
    """The three datasets of an export, each sorted, below one folder."""
    datasets = {
        "statements": export_wide(statements, corrections),
        "corrections": export_corrections(corrections),
        "provenance": export_provenance(statements),
    }
    for name, df in datasets.items():
        writer = df.write.mode("overwrite").format(format_)
        if format_ == "csv":
            writer = writer.option("header", "true").option("escape", '"')
        writer.save(f"{folder}/{name}")
