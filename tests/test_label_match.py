"""Labels by similarity: literal labels, the prefix filter against all pairs, and measured precision and recall."""

import random

from pyspark.sql import functions as F

from razonete.operators import label_match, line_items as items
from razonete.plans.catalogue import QUERIES
from razonete.sources.dictionary import synonyms_df

LABELS = [
    ("fornecedoress", "passivo_circulante", "passivo_circulante.fornecedores", None),
    ("fornecedor", "passivo_nao_circulante", "passivo_nao_circulante.fornecedores", None),
    ("fornecedor", None, None, "no_section"),
    ("emprest. e financ.", "passivo_circulante", "passivo_circulante.financiamentos_com_instituicoes_de_credito", None),
    ("receita operacional liqiuda", None, "dre.receita_operacional_liquida", None),
    ("despesa administrativa", "dre", "dre.despesas_administrativas", None),
    ("total do ativo circulante", "ativo_circulante", "ativo_circulante.total_ativo_circulante", None),
    ("total dos passivos circulantes", "passivo_circulante", "passivo_circulante.total_passivo_circulante", None),
    ("provisoes", "passivo_circulante", "passivo_circulante.provisoes", None),
    ("ajuste de avaliacao patrimonial", "patrimonio_liquido", None, "unknown"),
    ("", None, None, "unknown"), (None, None, None, "unknown"),
]


def test_literal_labels(spark):
    labels = spark.createDataFrame([(a, b) for a, b, _, _ in LABELS] * 2, "label string, section string")
    found = {(r["label"], r["section"]): (r["path"], r["reason"]) for r in label_match.resolve(labels, synonyms_df(spark)).collect()}
    assert found == {(a, b): (c, d) for a, b, c, d in LABELS}
    assert label_match.resolve(labels.limit(0), synonyms_df(spark)).count() == 0


def test_equally_near_names_are_ambiguous(spark):
    names = spark.createDataFrame([("reserva legal m", "*", "x"), ("reserva legal n", "*", "y"), ("outra coisa", "*", "z")],
                                  "label string, section string, path string")
    names = names.union(spark.createDataFrame([("reserva legal mn", "*", "x")], names.schema))
    labels = spark.createDataFrame([("reserva legal q", None), ("outras coisas", "dre")], "label string, section string")
    found = {r["label"]: (r["path"], r["reason"], r["paths"]) for r in label_match.resolve(labels, names).collect()}
    assert found["outras coisas"] == ("z", None, ["z"])
    assert found["reserva legal q"][:2] == (None, "ambiguous")


def test_prefix_filter_loses_no_pair(spark):
    draw = random.Random(6)
    names = list({"".join(draw.choices("abc ", k=draw.randrange(4, 24))).strip() or "a" for _ in range(60)})
    forms = set()
    for name in names:
        text = list(name)
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(text) + 1)
            text[at:at + draw.randrange(2)] = draw.choice(["", "x", "a"])
        forms.add("".join(text).strip() or "b")
    left = spark.createDataFrame([(f,) for f in sorted(forms)], "form string")
    right = spark.createDataFrame([(n,) for n in names], "name string")
    distance = F.levenshtein("form", "name")
    every = {tuple(r) for r in left.crossJoin(right).where(distance <= label_match.edits(F.col("form"))).select("form", "name", distance).collect()}
    assert {tuple(r) for r in label_match._near(left, right).select("form", "name", "distance").collect()} == every and len(every) > 20


def test_lines_with_similar_labels(spark):
    lines = spark.createDataFrame([
        ("d", "A", "2024", "Fornecedors 5,00", "passivo_circulante"), ("d", "A", "2024", "Fornecedores 7,00", "passivo_circulante"),
        ("d", "A", "2024", "Fornecedor 7,00", None), ("d", "A", "2024", "Algo mais 1,00", "dre"), ("d", "A", "2024", "Sem valor", "dre")],
        "document_name string, tipo_entidade string, periodo string, line string, section string")
    synonyms, rejected = label_match.with_similar(lines)
    assert [(r["path"], float(r["value"])) for r in items.line_items(lines, synonyms).collect()] == [("passivo_circulante.fornecedores", 12.0)]
    assert {(r["label"], r["reason"], r["n_lines"]) for r in rejected.collect()} == {("fornecedor", "no_section", 1), ("algo mais", "unknown", 1)}


def test_precision_and_recall(spark, folder):
    rows = {r["variant"]: r for r in QUERIES["similar_label_quality"](spark, folder).collect()}
    known = [r for v, r in rows.items() if v != "none"]
    recall = sum(r["n_right"] for r in known) / sum(r["n_lines"] for r in known)
    precision = sum(r["n_right"] for r in rows.values()) / sum(r["n_found"] for r in rows.values())
    print(f"precision {precision:.4f}, recall {recall:.4f}", {v: tuple(r)[1:] for v, r in rows.items()})
    assert precision > 0.98 and recall > 0.95
    assert rows["exact"]["n_right"] == rows["exact"]["n_lines"] and rows["none"]["n_found"] == 0
