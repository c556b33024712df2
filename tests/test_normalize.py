"""Answers of every kind to statements and rejects, against the rules in plain Python."""

import json
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from razonete.operators import normalize as norm

RECORD = {"tipo_entidade": "CONSOLIDADO", "identificacao": {"periodo": "2024-12-31"}, "razao_social": "Ação S.A.",
          "cnpj": None, "ativo_total": 10.5, "dre": {"lucro_liquido": "7.25"}}
OTHER = {**RECORD, "tipo_entidade": "CONTROLADORA", "ativo_total": "x", "dre": {"lucro_liquido": True}}
ARRAY = json.dumps([RECORD, OTHER], ensure_ascii=False)

# answer text -> number of statements, reject reasons
FAULTS = {
    "array": (ARRAY, 2, []),
    "object": (json.dumps(RECORD), 1, []),
    "fenced": (f"```json\n{ARRAY}\n```", 2, []),
    "fenced_plain": (f"```\n{ARRAY}\n```", 2, []),
    "envelope_text": (json.dumps({"result": ARRAY, "errorMessage": None}), 2, []),
    "envelope_value": (json.dumps({"result": [RECORD]}), 1, []),
    "envelope_fenced": (json.dumps({"result": f"```json\n{ARRAY}\n```"}), 2, []),
    "envelope_error": (json.dumps({"result": ARRAY, "errorMessage": "boom"}), 0, ["call_error"]),
    "envelope_empty_error": (json.dumps({"result": ARRAY, "errorMessage": ""}), 2, []),
    "envelope_null": (json.dumps({"result": None}), 0, ["null_result"]),
    "envelope_bad": (json.dumps({"result": "no json"}), 0, ["bad_json"]),
    "predictions_list": (json.dumps({"predictions": [ARRAY]}), 2, []),
    "predictions_many": (json.dumps({"predictions": [RECORD, OTHER]}), 2, []),
    "predictions_text": (json.dumps({"predictions": json.dumps(RECORD)}), 1, []),
    "malformed": ("not json", 0, ["bad_json"]),
    "trailing": (ARRAY + " and more", 0, ["bad_json"]),
    "parse_failed": ('[{"error":"parse_failed","raw":"x"}]', 0, ["parse_failed"]),
    "mixed": (json.dumps([RECORD, {"error": "parse_failed"}, 5]), 1, ["parse_failed", "bad_record"]),
    "other_error": ('[{"error":"something"}]', 1, []),
    "scalar": ("5", 0, ["bad_record"]),
    "null": ("null", 0, ["bad_record"]),
    "text": ('"hello"', 0, ["bad_record"]),
    "empty_array": ("[]", 0, ["no_records"]),
    "empty_text": ("", 0, ["bad_json"]),
    "nothing": (None, 0, ["no_answer"]),
}


@pytest.fixture(scope="module")
def tagged(spark):
    rows = [(f"file:/in/{name}.pdf", text) for name, (text, *_) in FAULTS.items()]
    return norm.records(spark.createDataFrame(rows, "path string, extracted string")).cache()


@pytest.mark.parametrize("name", FAULTS)
def test_fault_matrix(tagged, name):
    _, n_statements, reasons = FAULTS[name]
    document = F.col("document_name") == f"{name}.pdf"
    assert norm.statements_of(tagged).where(document).count() == n_statements
    assert sorted(r.reason for r in norm.rejects_of(tagged).where(document).collect()) == sorted(reasons)


def test_every_record_is_a_statement_or_a_reject(tagged):
    assert norm.statements_of(tagged).count() + norm.rejects_of(tagged).count() == tagged.count()
    assert {r.reason for r in norm.rejects_of(tagged).select("reason").distinct().collect()} <= set(norm.REASONS)


def test_values(tagged):
    first, second = (norm.statements_of(tagged).where("document_name = 'array.pdf'").orderBy("pos").collect())
    assert (first.tipo_entidade, first.periodo, first.razao_social, first.cnpj) == ("CONSOLIDADO", "2024-12-31", "Ação S.A.", "")
    assert (first.ativo_total, first.lucro_liquido) == (10.5, 7.25)
    assert (second.ativo_total, second.lucro_liquido) == (0.0, 1.0)
    assert json.loads(first.extracted_json) == RECORD and json.loads(second.extracted_json) == OTHER


def test_repeated_keys_keep_the_last(spark):
    df = spark.createDataFrame([("/a.pdf", '{"tipo_entidade":"A","tipo_entidade":"B"}')], "path string, extracted string")
    assert norm.statements_of(norm.records(df)).first().tipo_entidade == "B"


def test_dedupe_keeps_the_last_position(spark):
    rows = [("d", "A", "p", i, "/x", i) for i in range(5)] + [("d", "B", "p", 9, "/x", 0)]
    df = spark.createDataFrame(rows, "document_name string, tipo_entidade string, periodo string, v int, path string, pos int")
    assert {(r.tipo_entidade, r.v) for r in norm.dedupe_batch(df).collect()} == {("A", 4), ("B", 9)}


def test_tag_parse_failures(spark):
    df = spark.createDataFrame([("/a.pdf", "x" * 600), ("/b.pdf", ARRAY)], "path string, extracted string")
    found = norm.tag_parse_failures(df).collect()
    assert [r.document_name for r in found] == ["a.pdf"]
    assert json.loads(found[0].extracted) == [{"error": "parse_failed", "raw": "x" * 600}]


def test_flatten_statement_tells_booleans_from_texts(spark):
    texts = ['{"ativo_total":true,"passivo_total":"true","moeda":"x","identificacao":{"moeda":"BRL"},"dre":5}',
             '{"ativo_total":"1_000.5","passivo_total":[1],"dre":{"lucro_bruto":"-3"}}']
    df = spark.createDataFrame([("a", texts[0]), ("b", texts[1])], "document_name string, extracted_json string")
    a, b = norm.flatten_statement(df).orderBy("document_name").collect()
    assert (a.ativo_total, a.passivo_total, a.moeda, a.lucro_bruto) == (1.0, None, "BRL", None)
    assert (b.ativo_total, b.passivo_total, b.moeda, b.lucro_bruto) == (1000.5, None, None, -3.0)


# Answers, and the statements wanted of each: entity type, period, company, total assets, net profit.
LITERAL = [
    ('{"tipo_entidade":"A","identificacao":{"periodo":"2020"},"razao_social":"x","ativo_total":1,"dre":{"lucro_liquido":"2.5"}}',
     [("A", "2020", "x", 1.0, 2.5)]),
    ('[{"ativo_total":"1,5"},{"ativo_total":null},{"ativo_total":true}]',
     [("", "", "", 0.0, 0.0), ("", "", "", 0.0, 0.0), ("", "", "", 1.0, 0.0)]),
    ('[{"identificacao":"none","dre":7},5,null,"text",[1]]', [("", "", "", 0.0, 0.0)]),
    ('{"tipo_entidade":null,"razao_social":"","ativo_total":"-1e3","dre":{"lucro_liquido":" 7 "}}', [("", "", "", -1000.0, 7.0)]),
    ('{"tipo_entidade":false,"identificacao":{"periodo":0},"ativo_total":[]}', [("", "", "", 0.0, 0.0)]),
    ("[]", []), ("5", []), ('"text"', []), ("null", []), ('{"error":"parse_failed"}', []),
]


def test_statements_of_literal_answers(spark):
    df = spark.createDataFrame([(f"/{i}.pdf", answer) for i, (answer, _) in enumerate(LITERAL)], "path string, extracted string")
    found = {}
    for r in sorted(norm.statements_of(norm.records(df)).collect(), key=lambda r: r.pos):
        found.setdefault(r.document_name, []).append((r.tipo_entidade, r.periodo, r.razao_social, r.ativo_total, r.lucro_liquido))
    assert [found.get(f"{i}.pdf", []) for i in range(len(LITERAL))] == [rows for _, rows in LITERAL]


# --- random answers ----------------------------------------------------------

text = st.text("ab1. ", min_size=1, max_size=4)
amount = st.one_of(st.none(), st.booleans(), text, st.integers(-10**6, 10**6), st.lists(st.integers(), max_size=1))
record = st.fixed_dictionaries({"razao_social": text, "tipo_entidade": text, "ativo_total": amount, "dre": st.fixed_dictionaries(
    {"lucro_liquido": amount})})
leaf = st.one_of(st.none(), st.booleans(), st.integers(), text)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.one_of(record, leaf), max_size=4), min_size=20, max_size=40))
def test_random_answers(spark, answers):
    """A statement for each object and none for anything else; texts as they were, amounts always numbers."""
    df = spark.createDataFrame([(f"/{i}.pdf", json.dumps(a)) for i, a in enumerate(answers)], "path string, extracted string")
    tagged = norm.records(df)
    found, rejects = norm.statements_of(tagged).collect(), norm.rejects_of(tagged).collect()
    objects = {(f"{i}.pdf", pos): r for i, a in enumerate(answers) for pos, r in enumerate(a) if isinstance(r, dict)}
    assert {(r.document_name, r.pos) for r in found} == set(objects) and len(found) == len(objects)
    assert len(rejects) == sum(len(a) - sum(isinstance(r, dict) for r in a) or not a for a in answers)
    for row in found:
        given = objects[row.document_name, row.pos]
        assert (row.razao_social, row.tipo_entidade) == (given["razao_social"], given["tipo_entidade"])
        for value, source in ((row.ativo_total, given["ativo_total"]), (row.lucro_liquido, given["dre"]["lucro_liquido"])):
            assert value == source if isinstance(source, int) else math.isfinite(value)
