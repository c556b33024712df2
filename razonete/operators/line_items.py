"""Statement lines to field values: label, amount, scale, sum per field.

Input lines are rows (document_name, tipo_entidade, periodo, line), optionally
with the `escala_valores` the document declares and the `section` they stand
under (`statement_text.read_statements` gives both).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from razonete.functions.jsonops import computed_once
from razonete.functions.text import amount_tail, format_amount, label_before, scale_factor, tail_amount
from razonete.schemas import STATEMENT_KEY
from razonete.sources.dictionary import ANYWHERE, FIELDS, synonyms_df

ITEM_KEY = [*STATEMENT_KEY, "path"]


def split_lines(documents: DataFrame, text: str = "raw_parsed") -> DataFrame:
    """One row per line of each document, its other columns kept."""
    rest = [c for c in documents.columns if c != text]
    return documents.select(*rest, F.explode_outer(F.split(F.col(text), "\n")).alias("line")).where("line IS NOT NULL")


def read_lines(lines: DataFrame) -> DataFrame:
    """Add the normalised label and the scaled amount (NULL without an amount). One pattern match per line."""
    line, tail = F.col("line"), F.col("_tail")
    amount = tail_amount(tail)
    if "escala_valores" in lines.columns:
        amount = amount * scale_factor(F.col("escala_valores"))
    section = F.col("section") if "section" in lines.columns else F.lit(None).cast("string")
    # Tail and amount are computed once, or a filter on the amount computes them again, several times over.
    read = computed_once(lines, "_tail", amount_tail(line)).withColumn("_section", section)
    read = computed_once(read.select(*STATEMENT_KEY, "line", "_section", "_tail", amount.alias("_amount")), "value", F.col("_amount").cast("decimal(28,2)"))
    # The label is never NULL, so the join on it adds no filter that would compute it again.
    return read.select(*STATEMENT_KEY, F.coalesce(label_before(line, tail), F.lit("")).alias("label"), F.col("_section").alias("section"), "value")


def _joined(lines: DataFrame, synonyms: DataFrame | None, how: str) -> DataFrame:
    """Lines with an amount, joined to what their label names under their section.

    The built-in synonyms are a constant table and are broadcast; a caller's own
    table, (label, path) or (label, section, path), is left to Spark's size estimate.
    """
    read = read_lines(lines).where(F.col("value").isNotNull())
    known = F.broadcast(synonyms_df(lines.sparkSession)) if synonyms is None else synonyms
    if "section" not in known.columns:
        return read.join(known, "label", how)
    known = known.withColumnsRenamed({"label": "_label", "section": "_section"})
    holds = (F.col("_section") == ANYWHERE) | F.col("_section").eqNullSafe(F.col("section"))
    return read.join(known, (F.col("label") == F.col("_label")) & holds, how).drop("_label", "_section")


def match_lines(lines: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Lines whose label names a field."""
    return _joined(lines, synonyms, "inner").drop("section")


def unmatched_labels(lines: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """How often each label with an amount named no field."""
    return _joined(lines, synonyms, "left_anti").groupBy("label").agg(F.count("*").alias("n_lines"))


def line_items(lines: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Sum of the lines of each (document, entity type, period, field)."""
    return (match_lines(lines, synonyms).groupBy(*ITEM_KEY)
            .agg(F.sum("value").alias("value"), F.count("*").alias("n_lines")))


def line_item_cells(lines: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Line items with `fonte`: the labels, amounts and operation a non-zero value came from.

    Lines are first summed per label, so the labels joined into one text are at
    most the synonyms of that field, however many lines a document has.
    """
    by_label = (match_lines(lines, synonyms).groupBy(*ITEM_KEY, "label")
                .agg(F.sum("value").alias("value"), F.count("*").alias("n")))
    repeated = F.when(F.col("n") > 1, F.concat(F.lit(", "), F.col("n").cast("string"), F.lit(" linhas"))).otherwise(F.lit(""))
    part = F.concat("label", F.lit(" ("), format_amount(F.col("value")), repeated, F.lit(")"))
    summed = (by_label.withColumn("part", part).groupBy(*ITEM_KEY)
              .agg(F.expr("listagg(part, ' + ') WITHIN GROUP (ORDER BY label)").alias("parts"),
                   F.sum("value").alias("value"), F.sum("n").alias("n_lines")))
    text = F.when(F.col("n_lines") == 1, F.concat("parts", F.lit(": leitura direta"))).otherwise(
        F.concat("parts", F.lit(" = "), format_amount(F.col("value")), F.lit(": soma")))
    return summed.select(*ITEM_KEY, "value", "n_lines", F.when(F.col("value") != 0, text).alias("fonte"))


def line_item_provenance(lines: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Where each non-zero field came from, as text."""
    return line_item_cells(lines, synonyms).where("fonte IS NOT NULL").select(*ITEM_KEY, "fonte")


def assemble_records(cells: DataFrame) -> DataFrame:
    """`line_item_cells` back to one JSON record per (document, entity type, period).

    Number fields without a line are 0.00. The map per record holds at most the
    paths of the dictionary, because only those can be matched.
    """
    entry = F.struct("path", F.struct(F.col("value").cast("decimal(28,2)").alias("value"), "fonte"))
    maps = cells.groupBy(*STATEMENT_KEY).agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))
    sections: dict[str, list[str]] = {}
    for field in FIELDS:
        if field.is_number:
            section, _, name = field.path.rpartition(".")
            amount = f"coalesce(try_element_at(cells, '{field.path}').value, CAST(0 AS DECIMAL(28,2)))"
            sections.setdefault(section, []).append(f"'{name}', {amount}")
    members = ["'tipo_entidade', tipo_entidade", "'identificacao', named_struct('periodo', periodo)", *sections.pop("")]
    members += [f"'{section}', named_struct({', '.join(inner)})" for section, inner in sections.items()]
    members.append("'fontes', transform_values(map_filter(cells, (_, c) -> c.fonte IS NOT NULL), (_, c) -> c.fonte)")
    return maps.select(*STATEMENT_KEY, F.expr(f"to_json(named_struct({', '.join(members)}))").alias("extracted"))
