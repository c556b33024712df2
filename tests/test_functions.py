"""Column functions value by value."""

import json
import math
import zlib

import time

import pytest
from pyspark.sql import functions as F

from razonete.functions import jsonops, scoring, text as texts
from razonete.operators import elements
from razonete.operators.ingest import crc_bucket
from razonete.sources import dictionary


def values(spark, column, inputs, schema="x string"):
    numbered = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"n int, {schema}")
    return [r["y"] for r in numbered.select("n", column.alias("y")).orderBy("n").collect()]


def python_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


FLOAT_TEXTS = ["1", " 1.5 ", "-2.", ".5", "+3e2", "1E-3", "1_000", "1__0", "_1", "1_", "12f", "12d", "1.0D", "inf", "-Infinity",
               "nan", "", " ", "1,5", "0x10", "abc", None, "1 2", "1e", ".", "834988.00", "infx", "1_0.5_0", "\t7\n"]


def test_to_double_reads_what_float_reads(spark):
    found = values(spark, jsonops.to_double(F.col("x")), FLOAT_TEXTS)
    for text, value in zip(FLOAT_TEXTS, found):
        expected = python_float(text)
        same = value == expected or (value is not None and expected is not None and math.isnan(value) and math.isnan(expected))
        assert same, (text, value, expected)


def test_to_double_sql_is_the_same(spark):
    column = F.expr(jsonops.to_double_sql("x"))
    assert str(values(spark, column, FLOAT_TEXTS)) == str(values(spark, jsonops.to_double(F.col("x")), FLOAT_TEXTS))


JSON_NUMBERS = ['{"a":{"b":1.5}}', '{"a":{"b":"1.5"}}', '{"a":{"b":true}}', '{"a":{"b":"true"}}', '{"a":{"b":null}}',
                '{"a":{"b":[1]}}', '{"a":{"b":{}}}', '{"a":5}', '{}', '{"a":{"b":"x"}}', '{"a":{"b":0}}', '{"a":{"b":""}}']


def test_safe_double_by_kind(spark):
    found = values(spark, jsonops.safe_double(F.try_parse_json("x"), "a.b"), JSON_NUMBERS)
    assert found == [1.5, 1.5, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_text_at_turns_false_values_into_blank(spark):
    inputs = ['{"a":"x"}', '{"a":""}', '{"a":null}', '{"a":0}', '{"a":false}', '{"a":[]}', '{"a":{}}', "{}", '{"a":7}', '{"a":"0"}', "[1]"]
    assert values(spark, jsonops.text_at(F.try_parse_json("x"), "a"), inputs) == [
        "x", "", "", "", "", "", "", "", "7", "0", ""]


def test_path_get_by_column_path(spark):
    df = spark.createDataFrame([("a.b",), ("a",), ("z",), ("a b",), (None,), ("a.b.c",), ("$",)], "p string")
    record = F.try_parse_json(F.lit('{"a":{"b":"v"}}'))
    found = [r[0] for r in df.select(jsonops.path_get(record, F.col("p"))).collect()]
    assert found == ["v", '{"b":"v"}', None, None, None, None, None]


def test_strip_fences(spark):
    inputs = ["```json\n[1]\n```", "```\n[1]\n```", "  [1] ", "```[1]``` tail", "a ```b```", None]
    assert values(spark, jsonops.strip_fences(F.col("x")), inputs) == [
        "\n[1]\n", "\n[1]\n", "[1]", "[1]", "a ```b```", None]


@pytest.mark.parametrize("text", [
    '[1]', '{"a":1}', '"x"', '5', 'null', '[1] x', '[1] ]', '1,2', '', 'not json', '[1,]', '{"a":1}}', '[[1]', ' [1] ',
    '{"a":1,"a":2}', '"unclosed', '[1]]', '{"a":[1,2]} {"b":1}', 'true'])
def test_whole_text_must_be_one_json_value(spark, text):
    df = spark.createDataFrame([(text,)], "x string")
    found = jsonops.parse_column(df, "x", "v").select(F.to_json("v")).first()[0]
    try:
        expected = json.loads(text)
    except json.JSONDecodeError:
        assert found is None
    else:
        assert json.loads(found) == expected


def test_text_helpers(spark):
    assert values(spark, texts.basename(F.col("x")), ["/a/b.pdf", "b.pdf", "/a/", ""]) == ["b.pdf", "b.pdf", "", ""]
    assert values(spark, texts.strip_scheme(F.col("x")), ["file:/a/b", "file:///a/b", "hdfs:/a", "/a:b", "s3a://bucket/a"]) == [
        "/a/b", "/a/b", "/a", "/a:b", "//bucket/a"]
    assert values(spark, texts.document_key(F.col("x")), ["a", "a.pdf"]) == ["a.pdf", "a.pdf"]
    assert values(spark, texts.is_blank(F.col("x")), [None, "", " \n\t", "x"]) == [True, True, True, False]
    assert values(spark, texts.preview(F.col("x"), 2), ["ação", "a"]) == ["aç", "a"]


def test_amounts_and_labels(spark):
    lines = ["Caixa: 68.423,46", "Estoques  Líquidos  (1.234)", "Perda -R$ 10,5", "Ágio R$ -3", "Sem valor", "Total....... 2.156.906,51",
             "Nota 12 - 7", "1,00", None]
    tail = texts.amount_tail(F.col("x"))
    amounts = values(spark, texts.tail_amount(tail), lines)
    assert [None if a is None else float(a) for a in amounts] == [68423.46, -1234, -10.5, -3, None, 2156906.51, -7, 1, None]
    assert values(spark, texts.label_before(F.col("x"), tail), lines) == [
        "caixa", "estoques liquidos", "perda", "agio", "sem valor", "total", "nota 12", "", None]


def test_scale_factor(spark):
    inputs = ["milhares", "Em R$ mil", "em milhões", "unidades", None, "?"]
    assert [int(v) for v in values(spark, texts.scale_factor(F.col("x")), inputs)] == [1000, 1000, 1_000_000, 1, 1, 1]


def test_money_formats(spark):
    assert values(spark, texts.format_money(F.col("x")), [1234.5, -0.5, None, 1e6], "x double") == [
        "R$\u00a01.234,50", "-R$\u00a00,50", None, "R$\u00a01.000.000,00"]
    assert values(spark, texts.format_cell(F.col("x"), F.lit("number")), ["12.5", "", "null", "abc", None, "3 mil"]) == [
        "R$\u00a012,50", "", "", "abc", "", "R$\u00a03,00"]
    assert values(spark, texts.format_cell(F.col("x"), F.lit("text")), ["12.5"]) == ["12.5"]


# (found, wanted, metric, value)
FIELD_SCORES = [
    ("100", "100", "numeric_accuracy", True), ("101", "100", "numeric_accuracy", True),
    ("101.01", "100", "numeric_accuracy", False), ("99", "100", "numeric_accuracy", True),
    ("98.9", "100", "numeric_accuracy", False), ("100,5", "100.5", "numeric_accuracy", True),
    ("100,5", "100", "numeric_accuracy", True), ("-100", "100", "numeric_accuracy", False),
    ("-100", "-100,9", "numeric_accuracy", True), ("1e2", "100", "numeric_accuracy", True),
    ("0", "0.0", "numeric_accuracy", True), ("0.001", "0", "numeric_accuracy", False),
    ("0", "100", "numeric_accuracy", False), ("inf", "100", "numeric_accuracy", False),
    ("abc", " ABC ", "text_match", True), ("abc", "abd", "text_match", False), ("abc", "100", "text_match", False),
    ("100", "abc", "text_match", False), ("12f", "12", "text_match", False), ("12f", "12F", "text_match", True),
    ("", "", "text_match", True), ("", "0", "text_match", False), (None, None, "text_match", True),
    (None, "none", "text_match", True), ("None", None, "text_match", True), (None, "0", "text_match", False),
    ("1.234,5", "1234.5", "text_match", False),
]


def test_score_field_cases(spark):
    df = spark.createDataFrame(FIELD_SCORES, "a string, b string, metric string, value boolean")
    for row in df.withColumn("s", scoring.score_field(F.col("a"), F.col("b"))).collect():
        assert (row.s.name, row.s.value) == (row.metric, row.value), row


def test_wordings_of_rationales(spark):
    found = [("1234.5", "1000"), ("a", "b"), (None, "x")]
    df = spark.createDataFrame(found, "a string, b string")
    assert [r[0] for r in df.select(scoring.score_field(F.col("a"), F.col("b"))["rationale"]).collect()] == [
        "Extraído: 1234.50 | Correto: 1000.00 | Delta: 234.50", "Extraído: 'a' | Correto: 'b'", "Extraído: 'None' | Correto: 'x'"]
    balance = values(spark, scoring.score_balance(F.try_parse_json("x")), ['{"ativo_total":1000,"passivo_total":990}'])[0]
    assert (balance.name, balance.rationale) == (
        "balanco_equilibrado", "Ativo: 1,000.00 | Passivo: 990.00 | Delta: 1.00%")


def test_score_field_without_correction(spark):
    df = spark.createDataFrame([("1", None)], "a string, b string")
    score = df.select(scoring.score_field(F.col("a"), F.col("b"), F.col("b").isNotNull()).alias("s")).first().s
    assert (score.name, score.value) == ("numeric_accuracy", None)


def test_score_balance_cases(spark):
    inputs = ['{"ativo_total":100,"passivo_total":101}', '{"ativo_total":100,"passivo_total":101.5}', '{"ativo_total":0,"passivo_total":5}',
              '{"ativo_total":"x","passivo_total":5}', '{"passivo_total":5}', '{"ativo_total":"-100.0","passivo_total":"-99.5"}']
    found = values(spark, scoring.score_balance(F.try_parse_json("x"))["value"], inputs)
    assert found == [True, False, None, None, None, True]


def test_score_structure_cases(spark):
    whole = json.dumps({k: 1 for k in dictionary.REQUIRED_KEYS})
    part = json.dumps({k: 1 for k in dictionary.REQUIRED_KEYS if k not in ("cnpj", "dre")})
    score = scoring.score_structure(F.col("x"))
    assert values(spark, score["value"], [whole, part, "[1]", "no json"]) == [True, False, False, False]
    assert values(spark, score["rationale"], [part]) == ["Campos ausentes: cnpj, dre"]


def test_dictionary_shape():
    assert len(dictionary.FIELDS) == 81 and len(set(dictionary.PATHS)) == 81
    assert sum(f.is_total for f in dictionary.FIELDS) == 16
    assert sum(f.is_number for f in dictionary.FIELDS) == 75
    assert {p.split(".")[0] for p in dictionary.PATHS} == set(dictionary.REQUIRED_KEYS)


def test_crc_bucket_is_crc32(spark):
    paths = [f"/in/{i}.pdf" for i in range(50)]
    assert values(spark, crc_bucket(F.col("x")), paths) == [zlib.crc32(p.encode()) % 8 for p in paths]


def test_page_elements(spark):
    pages = {
        '<title>A &amp; B</title><script>var t="<p>no</p>";</script><!-- <p>no</p> --><p class="x">one <b>two</b>\nthree</p>'
        '<ul><li> </li><li>four<ul><li>five</li></ul>after</li></ul><pre>kept</pre>':
            ["A & B", "one two\nthree", "four", "five", "after", "kept"],
        "<table><tr><td>Caixa<td>1.000,00</tr></table><h4>x</h4><blockquote>y": ["Caixa", "1.000,00", "x", "y"],
        "<p>open<p>next <abbr title='<'>n</abbr> 1 < 2 <br/>last<": ["open", "next n 1 < 2", "last<"],
        "a<script>never closed": ["a"],
        "<STYLE>x</STYLE >b<!-- open": ["b"],
        "no tags &copy;": ["no tags ©"],
        "": [],
    }
    df = spark.createDataFrame([(p,) for p in pages], "html string").select("html", elements.page_elements(F.col("html")).alias("parts"))
    assert {r.html: r.parts for r in df.collect()} == pages
    assert values(spark, elements.page_elements(F.col("x")), [None]) == [None]


def test_message_text(spark):
    df = spark.createDataFrame(
        [(1, [("user", "a"), ("assistant", "b")], "t"), (2, [], "t"), (3, None, None)],
        "n int, messages array<struct<role: string, content: string>>, text string")
    found = df.orderBy("n").select(jsonops.message_text(F.col("messages"), F.col("text"))).collect()
    assert [r[0] for r in found] == ["b", "t", ""]


def test_character_references(spark):
    written = ["Dep&oacute;sitos &#8212; a", "&#x1D11E;&#119070;", "&lt;b&gt; &amp;lt; &amp;amp;", "&nothing; & &;", "&#0;&#xD800;&#1114112;",
               "&#150;&#x80;", "&NotEqualTilde;&nbsp;", "plain", None]
    assert values(spark, elements.character_references(F.col("x")), written) == [
        "Depósitos — a", "\U0001d11e\U0001d11e", "<b> &lt; &amp;", "&nothing; & &;", "\ufffd\ufffd\ufffd", "–€", "\u2242\u0338\u00a0", "plain", None]


def test_rows_of_tables_become_lines(spark):
    page = ("<p>Before</p><table><caption>Title</caption><tr><th rowspan=2>Conta<th colspan='2'>Consolidado</th><th>X</th></tr>"
            "<tr><th>2023</th><th>2022</th><td>-</td></tr><tr><td>Caixa &amp; bancos<td>1.000,00<td><b>7</b>,00</td></tr>"
            "<tr><td>Estoques</td><td></td><td>3,00</td></tr><tr><td colspan=4>All</td></tr></table>After"
            "<table><tr><td>outer<table><tr><td>inner</td><td>1</td></tr></table></td></tr></table>")
    rows = spark.createDataFrame([(1, page, "k"), (2, None, "l"), (3, "no table", "m")], "id int, html string, _x string")
    found = {r["id"]: r["lines"] for r in elements.page_lines(rows).collect()}
    assert found[1] == [
        "Before", "Title", f"{'Conta':19}{'Consolidado':15}  X", f"{'Conta':16}{'2023':>10}{'2022':>8}{'-':>3}",
        f"{'Caixa & bancos':16}{'1.000,00':>10}{'7,00':>8}", f"{'Estoques':16}{'':10}{'3,00':>8}", "All", "After", "outer", "inner    1"]
    assert found[2] is None and found[3] == ["no table"]
    assert elements.page_lines(rows).columns == ["id", "html", "_x", "lines"]


def test_cells_over_rows_keep_their_columns(spark):
    page = ("<table><tr><td rowspan=3>A</td><td>1</td><td rowspan=2>2</td><td>3</td></tr><tr><td>4</td><td>5</td></tr>"
            "<tr><td colspan=2>6</td><td>7</td></tr><tr><td rowspan=0>B</td></tr><tr><td>8</td></tr></table>")
    found = elements.page_lines(spark.createDataFrame([(page,)], "html string")).first()["lines"]
    assert found == ["A    1  2  3", "A    4     5", "A    6     7", "B", "B    8"]


def test_page_lines_of_long_tables(spark):
    """A row costs the same however many stand above it: copying those took minutes."""
    n = 20_000
    page = "<table><tr><th rowspan=2>Conta<th colspan=2>Individual<tr><th>2023<th>2022" + "".join(
        f"<tr><td>Item {i}</td><td align=right>{i},00</td><td>&nbsp;</td></tr>" for i in range(n)) + "</table>"
    begun = time.perf_counter()
    found = elements.page_lines(spark.createDataFrame([(page,)], "html string")).first()["lines"]
    assert time.perf_counter() - begun < 25
    assert found[:4] == [f"{'Conta':15}Individual", f"{'Conta':12}{'2023':>10}{'2022':>7}", f"{'Item 0':12}{'0,00':>10}", f"{'Item 1':12}{'1,00':>10}"]
    assert len(found) == n + 2


def test_page_lines_tell_where_a_table_ends(spark):
    """A letter that is two in lower case moved the end; odd tags and marks of the reader's own are read cell by cell."""
    pages = ["<table><tr><td>İİİ<td>1,00</TABLE>after", "<table><tr><td>a\x03b<td title='<b>x'>2 &am<b></b>p;<td>\x041</table>z",
             "<table><tr><td colspan='2'>a &lt;td&gt;<tr><td>b<td>&am<i></i>p;</table>"]
    found = elements.page_lines(spark.createDataFrame([(p,) for p in pages], "html string")).collect()
    assert {r["html"]: r["lines"] for r in found} == {
        pages[0]: ["İİİ    1,00", "after"], pages[1]: ["a\x03b    x'>2 &  \x041", "z"], pages[2]: ["a <td>", "b        &"]}
