"""Views that give the supplied tables the shapes the document jobs work on.

A customer is a document, its orders the amounts of a statement; an order is
also an entry of the correction log, a line item a line of a statement. All
views read their whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from razonete.functions.jsonops import computed_once
from razonete.functions.text import format_amount
from razonete.sources.dictionary import ANYWHERE, synonym_rows

MONEY = "decimal(18,2)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def numbered(prefix: str, key: str | Column, suffix: str = ".pdf") -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), key.cast("string"), F.lit(suffix))


def year_end(date: str) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("-12-31"))


def entity_type(status: str) -> Column:
    return (F.when(F.col(status) == "F", "CONSOLIDADO").when(F.col(status) == "O", "CONTROLADORA")
             .otherwise("INDIVIDUAL"))


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """k, path, tipo, periodo, rs, ativo, lucro: a row per document, entity type and year.

    Orders are summed before they meet the customers.
    """
    price = F.col("o_totalprice").cast(MONEY)
    orders = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("k"), entity_type("o_orderstatus").alias("tipo"),
        year_end("o_orderdate").alias("periodo")
    ).agg(F.sum(price).alias("ativo"),
          F.sum(F.when(F.col("o_orderpriority").startswith("1"), price).otherwise(F.lit(0).cast(MONEY))).alias("lucro"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("rs"),
        F.concat(F.lit("/in/"), "c_mktsegment", numbered("/c", "c_custkey")).alias("path"))
    return orders.join(customers, "k")


def extracted_content(spark: SparkSession, folder: str) -> DataFrame:
    """(path, extracted): answers a model could give, every kind of fault among them.

    The kind is k % 12: 0 no answer, 1 failed call, 2 envelope, 3 fenced, 4 no
    JSON, 5 parse failure, 6 one object, 7 bare number, 9 predictions, else an array. The list
    per document holds its entity types and years, at most 3 per year.
    """
    liabilities = (F.col("ativo") * (1 + (F.col("k") % 5).cast("decimal(3,0)") / 200)).cast("decimal(20,2)")
    record = F.struct(
        F.col("tipo").alias("tipo_entidade"),
        F.struct("periodo", F.lit("BRL").alias("moeda")).alias("identificacao"),
        F.col("rs").alias("razao_social"),
        F.col("ativo").alias("ativo_total"),
        liabilities.alias("passivo_total"),
        F.struct(F.col("lucro").cast("string").alias("lucro_liquido")).alias("dre"),
        F.struct(F.concat(F.lit("linha "), F.col("ativo").cast("string")).alias("ativo_total"),
                 F.lit("calc").alias("dre.lucro_liquido")).alias("fontes"))
    documents = totals(spark, folder).groupBy("k", "path").agg(F.sort_array(F.collect_list(record)).alias("records"))
    array, kind = F.to_json("records"), F.col("k") % 12
    answer = (F.when(kind == 0, None)
               .when(kind == 1, '{"result":null,"errorMessage":"boom"}')
               .when(kind == 2, F.to_json(F.struct(array.alias("result"))))
               .when(kind == 3, F.concat(F.lit("```json\n"), array, F.lit("\n```")))
               .when(kind == 4, "not json")
               .when(kind == 5, '[{"error":"parse_failed","raw":"x"}]')
               .when(kind == 6, F.to_json(F.get("records", F.lit(0))))
               .when(kind == 7, "5")
               .when(kind == 9, F.to_json(F.struct(F.array(array).alias("predictions"))))
               .otherwise(array))
    return computed_once(documents, "extracted", answer).select("path", "extracted")


def correction_log_of(orders: DataFrame) -> DataFrame:
    """Orders (batch or stream) as entries of a correction log that rewrites its keys."""
    number = F.col("o_totalprice").cast(MONEY).cast("string")
    kind = F.col("o_orderkey") % 6
    campo = (F.when(kind == 0, "ativo_total").when(kind == 1, "dre.lucro_liquido").when(kind == 2, "razao_social")
              .when(kind == 3, "identificacao.moeda").when(kind == 4, "passivo_circulante.fornecedores")
              .otherwise("observacao"))
    correct = (F.when(kind == 1, F.replace(number, F.lit("."), F.lit(",")))
                .when(kind == 2, F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")))
                .when(kind == 3, "BRL").otherwise(number))
    note = F.col("o_orderkey") % 5
    return orders.select(
        numbered("c", "o_custkey").alias("document_name"), campo.alias("campo"),
        F.concat(F.lit("9"), number).alias("valor_extraido"), correct.alias("valor_correto"),
        F.when(note == 0, "").when(note == 1, None).when(note == 2, "tag-a").when(note == 3, "tag-b")
         .otherwise("free").alias("comentario"),
        F.col("o_orderdate").alias("criado_em"), F.col("o_orderkey").alias("seq"))


def correction_log(spark: SparkSession, folder: str) -> DataFrame:
    return correction_log_of(table(spark, folder, "orders"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """document_name, document_text."""
    return table(spark, folder, "documents").select(
        numbered("c", "doc_id").alias("document_name"), F.col("text").alias("document_text"))


# Labels of the view below, and the fields they count for.
LINE_LABELS = {
    "disponibilidades": "ativo_circulante.disponibilidades", "disponibilidades liquidos": "ativo_circulante.disponibilidades",
    "caixa e equivalentes": "ativo_circulante.disponibilidades", "caixa e equivalentes liquidos": "ativo_circulante.disponibilidades",
    "estoques": "ativo_circulante.estoques", "estoques liquidos": "ativo_nao_circulante.estoques",
}


def line_labels(spark: SparkSession) -> DataFrame:
    """(label, path), a table of constants."""
    return F.broadcast(spark.createDataFrame(sorted(LINE_LABELS.items()), "label string, path string"))


def _labelled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the label a statement gives them, and their order."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    label = F.concat(
        F.when(F.col("l_returnflag") == "A", "Disponibilidades")
         .when(F.col("l_returnflag") == "N", "Caixa e Equivalentes").otherwise("Estoques"),
        F.when(F.col("l_linestatus") == "F", "").otherwise(" Líquidos"))
    return (table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("o_orderkey", numbered("c", "o_custkey").alias("document_name"), F.col("o_orderstatus").alias("tipo_entidade"),
                    year_end("o_orderdate").alias("periodo"), label.alias("label"), "l_extendedprice"))


def statement_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One pt-BR statement line per line item."""
    line = F.concat("label", F.lit(": "), format_amount(F.col("l_extendedprice")))
    return _labelled_lines(spark, folder).select("document_name", "tipo_entidade", "periodo", line.alias("line"))


def scaled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines, even orders in thousands with five decimals."""
    even = F.col("o_orderkey") % 2 == 0
    amount = F.when(even, format_amount(F.col("l_extendedprice") / 1000, 5)).otherwise(format_amount(F.col("l_extendedprice")))
    return _labelled_lines(spark, folder).select(
        "document_name", "tipo_entidade", "periodo", F.concat("label", F.lit(" "), amount).alias("line"),
        F.when(even, "Em milhares").alias("escala_valores"))


TEXT_YEARS = (1995, 1994)


def statement_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(document_name, raw_parsed): a text for each customer, two entity types with two years each side by side.

    Amounts are in thousands; a dash stands for none, and every label has the
    number of a note behind it.
    """
    cells = [(status, year) for status in ("F", "O") for year in TEXT_YEARS]
    price = F.col("l_extendedprice").cast(MONEY)
    sums = [F.sum(F.when((F.col("tipo_entidade") == status) & F.col("periodo").startswith(str(year)), price)).alias(f"c{i}")
            for i, (status, year) in enumerate(cells)]
    amounts = [F.coalesce(format_amount(F.col(f"c{i}") / 1000, 5), F.lit("-")) for i in range(len(cells))]
    line = F.concat_ws("   ", F.concat("label", F.lit(" 12")), *amounts)
    by_label = _labelled_lines(spark, folder).groupBy("document_name", "label").agg(*sums).select("document_name", line.alias("line"))
    head = "\n".join(["Demonstrações financeiras em milhares de reais", "", "   Consolidado      Controladora",
                      "   " + "   ".join(f"31/12/{year}" for _, year in cells), ""])
    # At most six labels per document.
    return by_label.groupBy("document_name").agg(F.concat(
        F.lit(head), F.array_join(F.sort_array(F.collect_list("line")), "\n")).alias("raw_parsed"))


SHAPES = 8
LABEL_WIDTH, CELL_WIDTH = 30, 26
# Items of a sheet: line numbers modulo 4, as label and path; labels repeat from section to section.
SHEET_ITEMS = {1: ("Estoques", "ativo_circulante.estoques"), 2: ("Estoques", "ativo_nao_circulante.estoques"),
               3: ("Fornecedores", "passivo_circulante.fornecedores"), 0: ("Fornecedores", "passivo_nao_circulante.fornecedores")}


def sheet_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """k, block, kind, item, c0 to c3: sums of line items, returned ones negative.

    A block has two years of a customer, the later first; kind 0 has two entity types side by side, kind 1 the third.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    price = F.col("l_extendedprice").cast(MONEY)
    rows = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("k"), F.floor(F.col("year") / 2).alias("block"), (F.col("o_orderstatus") == "P").cast("int").alias("kind"),
        (F.col("l_linenumber") % 4).alias("item"), (F.col("year") % 2 == 0).alias("earlier"), (F.col("o_orderstatus") == "O").alias("second"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("value"))
    cells = [F.sum(F.when((F.col("second") == second) & (F.col("earlier") == earlier), F.col("value"))).alias(f"c{2 * second + earlier}")
             for second in (False, True) for earlier in (False, True)]
    return rows.groupBy("k", "block", "kind", "item").agg(*cells)


def statement_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """(document_name, raw_parsed): the line items of a customer as a statement prints them.

    Blocks of two years stand one below the other, each with its header in one of `SHAPES` shapes in turn: plain
    dates, a column of notes, a title before the years, entity types and years on one line, long dates, dotted dates,
    an entity type for each year, and blanks lost. Amounts of even customers are in thousands, negative ones in
    brackets; missing ones are left blank, a dash where blanks are lost.
    """
    shape = F.when(F.col("kind") == 1, 0).otherwise((F.col("k") + F.col("block")) % SHAPES)
    even, single, lost = F.col("k") % 2 == 0, F.col("kind") == 1, F.col("shape") == SHAPES - 1

    def cell(i: int) -> Column:
        size = F.abs(F.col(f"c{i}"))
        text = F.when(even, format_amount(size / 1000, 5)).otherwise(format_amount(size))
        text = F.when(F.col(f"c{i}") < 0, F.concat(F.lit("("), text, F.lit(")"))).otherwise(text)
        return F.when(lost, F.coalesce(text, F.lit("-"))).otherwise(F.coalesce(F.lpad(text, CELL_WIDTH, " "), F.lit(" " * CELL_WIDTH)))

    def row(label: Column, cells: list[Column]) -> Column:
        shown = F.when(single, F.array(*cells[:2])).otherwise(F.array(*cells))
        return F.when(lost, F.concat(label, F.lit(" "), F.array_join(shown, " "))).otherwise(
            F.concat(F.rpad(label, LABEL_WIDTH, " "), F.array_join(shown, "")))

    years = [F.col("block") * 2 + 1, F.col("block") * 2] * 2
    entities = ["Consolidado", "Consolidado", "Controladora", "Controladora"]

    def dates(before: str) -> list[Column]:
        return [F.concat(F.lit(before), year.cast("string")) for year in years]

    def padded(cells: list[Column]) -> list[Column]:
        return [F.when(lost, c).otherwise(F.lpad(c, CELL_WIDTH, " ")) for c in cells]

    blank = F.lit("")
    two = F.when(single, "    Individual").otherwise(" " * (LABEL_WIDTH + CELL_WIDTH) + "Consolidado" + " " * CELL_WIDTH + "Controladora")
    each = row(blank, padded([F.lit(e) for e in entities]))
    both = row(blank, padded([F.concat(F.lit(f"{e} "), y.cast("string")) for e, y in zip(entities, years)]))
    head = F.concat_ws("\n", F.lit("Balanço patrimonial"), F.when(even, "Em milhares de reais").otherwise("Em reais"), (
        F.when(F.col("shape") == 1, F.concat_ws("\n", two, row(F.lit("                    Notas"), padded(dates("31/12/")))))
         .when(F.col("shape") == 2, F.concat_ws("\n", two, row(F.lit("Ativo"), padded(dates("")))))
         .when(F.col("shape") == 3, both)
         .when(F.col("shape") == 4, F.concat_ws("\n", two, row(blank, padded(dates("31 de dezembro de ")))))
         .when(F.col("shape") == 5, F.concat_ws("\n", two, row(blank, padded(dates("31.12.")))))
         .when(F.col("shape") == 6, F.concat_ws("\n", each, row(blank, padded(dates("")))))
         .otherwise(F.concat_ws("\n", two, row(blank, padded(dates("31/12/")))))))

    label = F.lit(None).cast("string")
    for item, (name, _) in SHEET_ITEMS.items():
        label = F.when(F.col("item") == item, name).otherwise(label)
    noted = F.when(F.col("shape") == 1, F.concat(F.rpad(label, 22, " "), F.lit("12"))).otherwise(label)
    lines = sheet_amounts(spark, folder).withColumn("shape", shape).select(
        "k", "block", "kind", "shape", "item", row(noted, [cell(i) for i in range(4)]).alias("line"))
    of = {item: F.max(F.when(F.col("item") == item, F.col("line"))).alias(f"l{item}") for item in SHEET_ITEMS}
    blocks = lines.groupBy("k", "block", "kind", "shape").agg(*of.values()).select("k", "block", "kind", F.concat_ws(
        "\n", head, F.when(F.col("shape") != 2, "Ativo"), F.lit("Circulante"), "l1", F.lit("Não circulante"), "l2",
        F.lit("Passivo"), F.lit("Circulante"), "l3", F.lit("Não circulante"), "l0", F.when(lost, "Outros 1,00")).alias("text"))
    # A block for each two years and kind.
    ordered = F.sort_array(F.collect_list(F.struct("block", "kind", "text")))
    return blocks.groupBy(numbered("c", "k").alias("document_name")).agg(F.concat(
        F.lit("Companhia 10\n"), F.array_join(F.transform(ordered, lambda b: b["text"]), "\n\n")).alias("raw_parsed"))


def statement_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(document_name, html): the same amounts as a page for each customer, a table for each block.

    Headings reach over columns and rows; section titles over the whole row; odd customers write accents and dashes
    as named, the others as numeric character references.
    """
    odd, single = F.col("k") % 2 == 1, F.col("kind") == 1

    def cell(i: int) -> Column:
        size = format_amount(F.abs(F.col(f"c{i}")))
        text = F.when(F.col(f"c{i}") < 0, F.concat(F.lit("("), size, F.lit(")"))).otherwise(size)
        return F.concat(F.lit("<td align=right>"), F.coalesce(text, F.when(odd, "&nbsp;").otherwise("&#8212;")), F.lit("</td>"))

    def title(text: Column | str) -> Column:
        text = F.lit(text) if isinstance(text, str) else text
        return F.concat(F.lit("<tr><td colspan='5'><b>"), text, F.lit("</b></td></tr>"))

    def years(n: int) -> Column:
        return F.concat(*[F.concat(F.lit("<th>"), (F.col("block") * 2 + (i + 1) % 2).cast("string"), F.lit("</th>")) for i in range(n)])

    head = F.when(single, F.concat(F.lit("<tr><th rowspan=2>Conta</th><th colspan=2>Individual</th></tr><tr>"), years(2), F.lit("</tr>"))).otherwise(
        F.concat(F.lit("<tr><th rowspan=\"2\">Conta</th><th colspan=2>Consolidado</th><th colspan=2>Controladora</th></tr>\n<tr>"), years(4), F.lit("</tr>")))
    not_current = F.when(odd, "N&atilde;o circulante").otherwise("N&#xE3;o circulante")
    label = F.lit(None).cast("string")
    for item, (name, _) in SHEET_ITEMS.items():
        label = F.when(F.col("item") == item, name).otherwise(label)
    cells = F.when(single, F.concat(cell(0), cell(1))).otherwise(F.concat(*[cell(i) for i in range(4)]))
    lines = sheet_amounts(spark, folder).select("k", "block", "kind", "item", F.concat(
        F.lit("<tr>\n <td>"), label, F.lit("</td>"), cells, F.lit("</tr>")).alias("line"))
    of = {item: F.max(F.when(F.col("item") == item, F.col("line"))).alias(f"l{item}") for item in SHEET_ITEMS}
    blocks = lines.groupBy("k", "block", "kind").agg(*of.values()).select("k", "block", "kind", F.concat_ws(
        "\n", F.lit("<h2>Balan&ccedil;o patrimonial</h2><table border=1>"), head, title("Ativo"), title("Circulante"), "l1", title(not_current), "l2",
        title("Passivo"), title("Circulante"), "l3", title(not_current), "l0", F.lit("</table>")).alias("html"))
    ordered = F.sort_array(F.collect_list(F.struct("block", "kind", "html")))  # a block for each two years and kind
    return blocks.groupBy(numbered("c", "k").alias("document_name")).agg(F.concat(
        F.lit("<html><body>"), F.array_join(F.transform(ordered, lambda b: b["html"]), "<br>"), F.lit("</body></html>")).alias("html"))


VARIANTS = ("exact", "lost letter", "other letter", "plural", "abbreviation", "none")


def varied_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(variant, label, path, n): labels of one field each as line items print them, most of them not as the dictionary does.

    The part tells the field and the variant of its label: a letter lost or another, a plural, the first word cut
    short, or a label that names no field (path NULL). Line items are counted by what tells their label, and labels
    are written for the counts.
    """
    named = [(i, label, path) for i, (label, section, path) in enumerate(
        row for row in synonym_rows() if row[1] == ANYWHERE and len(row[0]) >= 12 and "/" not in row[0] and "(" not in row[0])]
    known = F.broadcast(spark.createDataFrame(named, "i int, name string, path string"))
    kind, at = F.col("kind"), F.col("at")
    words = F.split("name", " ")
    label = (F.when(kind == 1, F.concat(F.left("name", at), F.substring(F.col("name"), at + 2, F.length("name"))))
              .when(kind == 2, F.concat(F.left("name", at), F.lit("y"), F.substring(F.col("name"), at + 2, F.length("name"))))
              .when(kind == 3, F.concat("name", F.lit("s")))
              .when(kind == 4, F.concat_ws(" ", F.concat(F.left(F.get(words, F.lit(0)), F.lit(5)), F.lit(".")), F.array_join(F.slice(words, 2, 20), " ")))
              .when(kind == 5, F.concat(F.reverse("name"), F.lit(" q"))).otherwise(F.col("name")))
    items = table(spark, folder, "lineitem").groupBy(
        (F.col("l_orderkey") % len(named)).cast("int").alias("i"), (F.col("l_partkey") % len(VARIANTS)).alias("kind"),
        (4 + F.col("l_suppkey") % 5).alias("at")).agg(F.count("*").alias("n_items"))
    rows = items.join(known, "i").select(F.get(F.array(*[F.lit(v) for v in VARIANTS]), kind.cast("int")).alias("variant"), label.alias("label"),
                                         F.when(kind != 5, F.col("path")).alias("path"), "n_items")
    return rows.groupBy("variant", "label", "path").agg(F.sum("n_items").alias("n"))
