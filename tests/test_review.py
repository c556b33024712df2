"""Overlay, exports, metrics and evaluation against small cases worked out by hand."""

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from razonete.operators import evaluate, export, line_items as items, metrics, review
from razonete.sources.dictionary import FIELDS

STATEMENT = "document_name string, tipo_entidade string, periodo string, razao_social string, extracted_json string"
CORRECTION = ("document_name string, campo string, valor_extraido string, valor_correto string, comentario string, "
              "criado_em timestamp, seq int")

RECORD = {"razao_social": "Um", "ativo_total": 10, "passivo_total": "abc", "identificacao": {"periodo": "2024-12-31", "moeda": 7},
          "dre": {"lucro_liquido": "3.5", "lucro_bruto": True, "abatimentos": "true"}, "fontes": {"dre.lucro_liquido": "linha", "x.y": None, "cnpj": "k"}}


@pytest.fixture(scope="module")
def statements(spark):
    return spark.createDataFrame([
        ("d", "A", "2024", "Um", json.dumps(RECORD)), ("d", "A", "2023", "Um", "{}"), ("d", "B", "2025", "Um", '{"fontes":[1]}'),
        ("e", "B", "", "Dois", json.dumps({"ativo_total": "12f"}))], STATEMENT)


@pytest.fixture(scope="module")
def corrections(spark):
    return spark.createDataFrame([
        ("d", "ativo_total", "10", "11.5", "tag", None, 1), ("d", "dre.lucro_liquido", "3.5", "n/d", "", None, 2),
        ("d", "cnpj", "", "123", None, None, 3), ("d", "observacao", "", "free", None, None, 4), ("f", "cnpj", "", "9", None, None, 5)],
        CORRECTION)


def test_overlay_without_corrections_shows_the_record(statements, corrections):
    cells = {(r.document_name, r.periodo, r.path): r for r in export.overlay(statements, corrections.limit(0)).collect()}
    assert not any(r.corrected for r in cells.values())
    found = {path: (r.value_text, r.value_num) for (d, p, path), r in cells.items() if (d, p) == ("d", "2024")}
    assert found == {"razao_social": ("Um", None), "ativo_total": (None, 10.0), "passivo_total": ("abc", None),
                     "identificacao.periodo": ("2024-12-31", None), "identificacao.moeda": ("7", None),
                     "dre.lucro_liquido": (None, 3.5), "dre.lucro_bruto": (None, 1.0), "dre.abatimentos": ("true", None)}
    assert cells["e", "", "ativo_total"].value_text == "12f"


def test_overlay_with_corrections(statements, corrections):
    cells = {(r.document_name, r.periodo, r.path): (r.value_text, r.value_num) for r in export.overlay(statements, corrections).collect()
             if r.corrected}
    assert cells == {("d", p, path): value for p in ("2024", "2023", "2025") for path, value in
                     {"ativo_total": (None, 11.5), "dre.lucro_liquido": ("n/d", None), "cnpj": ("123", None)}.items()}


def test_wide_export_agrees_with_the_long_one(statements, corrections):
    wide = export.export_wide(statements, corrections)
    assert wide.columns == ["document_name", "tipo_entidade", "periodo", *[f.column for f in FIELDS], "corrections", "text_cells"]
    rows = wide.collect()
    assert [(r.document_name, r.tipo_entidade, r.periodo) for r in rows] == [
        ("d", "A", "2023"), ("d", "A", "2024"), ("d", "B", "2025"), ("e", "B", "")]
    assert [r.corrections for r in rows] == [4, 4, 4, None]
    long = {(r.document_name, r.periodo, r.path): r for r in export.overlay(statements, corrections).collect()}
    for r in rows:
        left_over = json.loads(r.text_cells) if r.text_cells else {}
        for f in FIELDS:
            cell = long.get((r.document_name, r.periodo, f.path))
            if not f.is_number:
                assert r[f.column] == (cell.value_text if cell else "")
            else:
                assert r[f.column] == (cell.value_num if cell else None)
                assert left_over.get(f.path) == (cell.value_text if cell else None)


def test_provenance(statements):
    found = [(r.path, r.label, r.fonte) for r in export.export_provenance(statements).collect()]
    assert found == [("cnpj", "CNPJ", "k"), ("dre.lucro_liquido", "Lucro Líquido", "linha"), ("x.y", "x.y", "")]
    sections = [(r.section, r.section_label, r.section_ord, r.n_entries) for r in export.provenance_by_section(statements).collect()]
    assert sections == [("", "Geral", 0, 1), ("dre", "DRE", 8, 1), ("x", "x", 999, 1)]
    assert [r.label for r in export.provenance_panel(statements, "d").collect()] == ["CNPJ", "Lucro Líquido", "x.y"]


def test_written_export_reads_back(spark, statements, corrections, tmp_path):
    export.write_export(statements, corrections, str(tmp_path / "out"))
    counts = {}
    for name in ("statements", "corrections", "provenance"):
        parts = sorted(glob.glob(str(tmp_path / "out" / name / "*.csv")))
        counts[name] = sum(len(list(csv.DictReader(open(p, encoding="utf-8")))) for p in parts)
    assert counts == {"statements": 4, "corrections": 5, "provenance": 3}


def test_metrics(statements, corrections):
    totals = metrics.metrics_totals(statements, corrections).first()
    assert totals.asDict() == {"total_docs": 4, "distinct_docs": 2, "total_corrections": 5, "docs_with_corrections": 2,
                               "accuracy_pct": round((1 - 5 / 280) * 100, 1), "docs_without_errors": 2}
    assert metrics.metrics_totals(statements.limit(0), corrections).first().accuracy_pct is None
    assert [(r.campo, r.total, r.share_pct) for r in metrics.metrics_by_field(corrections, 2).collect()] == [
        ("cnpj", 2, 100.0), ("ativo_total", 1, 50.0)]
    assert [(r.tipo, r.total) for r in metrics.metrics_by_type(corrections).collect()] == [("Sem descrição", 4), ("tag", 1)]
    assert [(r.document_name, r.corrections, r.razao_social) for r in metrics.metrics_by_document(statements, corrections).collect()] == [
        ("d", 12, "Um"), ("f", 1, None)]
    assert [(r.document_name, r.corrections, r.razao_social)
            for r in metrics.metrics_by_document_distinct(statements, corrections).collect()] == [("d", 4, "Um"), ("f", 1, None)]


def test_lists_and_labels(spark, statements):
    assert [(r.document_name, r.periodo) for r in review.document_list(statements.withColumns(
        {c: F.lit(None).cast("string") for c in ("cnpj", "ativo_total", "lucro_liquido")})).collect()] == [("d", "2025"), ("e", "")]
    assert [(r.tipo_entidade, r.periodo) for r in review.document_detail(statements, "d").collect()] == [
        ("A", "2024"), ("A", "2023"), ("B", "2025")]
    assert {(r.document_name, r.tipo_entidade, r.periodo) for r in review.default_record(statements).collect()} == {
        ("d", "A", "2024"), ("e", "B", "")}
    labels = {(r.document_name, r.periodo): (r.record_label, r.title) for r in review.record_labels(statements).collect()}
    assert labels["d", "2024"] == ("A · 2024", "Um") and labels["e", ""] == ("B · —", "e")


def test_evaluation(spark, statements, corrections):
    documents = spark.createDataFrame([("d", "x" * 5000), ("e", "text"), ("g", "none")], "document_name string, document_text string")
    records = {r.inputs.document_name: r for r in evaluate.evaluation_set(documents, statements, corrections).collect()}
    assert len(records["d"].inputs.text) == 5000 and json.loads(records["d"].outputs) == RECORD
    assert tuple(records["d"].expectations) == ("ativo_total", "11.5")
    assert records["e"].expectations is None and records["g"].outputs == "{}"
    scores = evaluate.evaluation_scores(evaluate.evaluation_set(documents, statements, corrections, 4000))
    by_metric = {r.metric: (r["mean"], r.n_scored, r.n) for r in evaluate.evaluation_metrics(scores).collect()}
    assert by_metric == {"json_structure_valid": (0.0, 3, 3), "balanco_equilibrado": (None, 0, 3), "numeric_accuracy": (0.0, 1, 3)}
    every = {(r.document_name, r.campo): (r.metric, r.value) for r in evaluate.score_corrections(statements, corrections).collect()}
    assert every["d", "dre.lucro_liquido"] == ("text_match", False) and every["f", "cnpj"] == ("text_match", False)
    assert len(every) == 5


def test_tuning(spark, corrections):
    documents = spark.createDataFrame([("d", "text")], "document_name string, document_text string")
    example, = evaluate.tuning_set(documents, corrections).collect()
    assert (example.inputs.document_name, example.inputs.text) == ("d", "text")
    notes = example.expectations.expected_response.splitlines()[1:-1]
    assert notes == ["- Campo 'ativo_total': deve ser '11.5' (era '10'). tag", "- Campo 'cnpj': deve ser '123' (era ''). ",
                     "- Campo 'dre.lucro_liquido': deve ser 'n/d' (era '3.5'). ", "- Campo 'observacao': deve ser 'free' (era ''). "]
    ready = evaluate.tuning_readiness(documents, corrections).first()
    assert (ready.corrected_docs, ready.ready, ready.missing_docs) == (1, False, 4)


def test_latest_status(spark):
    documents = spark.createDataFrame([("d",), ("e",)], "document_name string")
    log = spark.createDataFrame([("d", "processing", 1), ("d", "done", 2), ("x", "error", 3)], "document_name string, status string, at int")
    assert {(r.document_name, r.status) for r in review.latest_status(documents, log, ["at"]).collect()} == {("d", "done"), ("e", "unknown")}


def test_line_items_to_records(spark):
    lines = spark.createDataFrame([
        ("d", "A", "2024", "Disponibilidades: 1.000,50", "milhares"), ("d", "A", "2024", "Caixa e equivalentes 2,00", "milhares"),
        ("d", "A", "2024", "ESTOQUES (LP)   (3)", "milhares"), ("d", "A", "2024", "Outra linha 5", "milhares"),
        ("d", "A", "2024", "Fornecedores (CP): 0,00", "milhares"), ("d", "A", "2024", "Título", "milhares"),
        ("d", "B", "2024", "Lucro Líquido -7", None)],
        "document_name string, tipo_entidade string, periodo string, line string, escala_valores string")
    found = {(r.tipo_entidade, r.path): (float(r.value), r.n_lines) for r in items.line_items(lines).collect()}
    assert found == {("A", "ativo_circulante.disponibilidades"): (1002500.0, 2), ("A", "ativo_nao_circulante.estoques"): (-3000.0, 1),
                     ("A", "passivo_circulante.fornecedores"): (0.0, 1), ("B", "dre.lucro_liquido"): (-7.0, 1)}
    assert [(r.label, r.n_lines) for r in items.unmatched_labels(lines).collect()] == [("outra linha", 1)]
    texts = {r.path: r.fonte for r in items.line_item_provenance(lines).collect()}
    assert texts["ativo_circulante.disponibilidades"] == (
        "caixa e equivalentes (2.000,00) + disponibilidades (1.000.500,00) = 1.002.500,00: soma")
    assert texts["dre.lucro_liquido"] == "lucro liquido (-7,00): leitura direta"
    assert "passivo_circulante.fornecedores" not in texts
    records = {r.tipo_entidade: json.loads(r.extracted) for r in items.assemble_records(items.line_item_cells(lines)).collect()}
    assert records["A"]["ativo_circulante"]["disponibilidades"] == 1002500.0 and records["A"]["dre"]["lucro_liquido"] == 0
    assert set(records["A"]["fontes"]) == {"ativo_circulante.disponibilidades", "ativo_nao_circulante.estoques"}
    assert sum(len(v) for k, v in records["B"].items() if isinstance(v, dict) and k not in ("identificacao", "fontes")) == 73


def test_split_lines_keeps_every_line(spark):
    df = spark.createDataFrame([("d", "a\n\nb"), ("e", ""), ("f", None)], "document_name string, raw_parsed string")
    assert sorted(tuple(r) for r in items.split_lines(df).collect()) == [("d", ""), ("d", "a"), ("d", "b"), ("e", "")]
