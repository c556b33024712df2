"""Whole statement texts with several columns to statement lines, read as they are printed.

A statement prints entity types and dates side by side, and sections one below the other:

    Demonstrações em milhares de reais
                              Consolidado              Controladora
    Ativo           Nota   31/12/2023  31/12/2022   31/12/2023  31/12/2022
    Circulante
      Estoques         5     1.000,00      900,00        10,00
    Não circulante
      Estoques                  70,00                    (3,00)          -

`read_statements` gives a row for every amount, with the entity type, the period
and the section it stands under. Each line is taken apart once into its tokens
(dates, entity words, amounts) and the text between them. What is open at a line
(entity types, dates, scale, side and term of the section) is carried along by
one ordered pass over the lines of its document.

Amounts are matched to columns as intervals. A column reaches from half-way to
the column before it to half-way to the next one, and an amount belongs where it
ends; so a missing amount or the number of a note shifts nothing. That holds
where the columns begin to the right of the line's label. Texts that have lost
their blanks are read by order: the last amounts are those of the columns, and a
line with too few of them is left out, with its reason. Lines of more than
`MOST_TOKENS` tokens are read by order, too.

A text without lines gives no rows. Documents are told apart by their row, so
repeated names are read one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from razonete.functions.jsonops import computed_once
from razonete.functions.text import normal_label, strip

# Entity types as headers write them, without accents.
ENTITY_TYPES = {"consolidado": "CONSOLIDADO", "consolidada": "CONSOLIDADO", "controladora": "CONTROLADORA", "individual": "INDIVIDUAL"}

# Months in order.
MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]

# What a title opens, as side of the statement and term; a title without a side keeps the open one.
SECTION_TITLES = {
    "ativo": ("ativo", None), "passivo": ("passivo", None), "passivo e patrimonio liquido": ("passivo", None),
    "circulante": (None, "circulante"), "nao circulante": (None, "nao_circulante"),
    "realizavel a longo prazo": ("ativo", "nao_circulante"), "exigivel a longo prazo": ("passivo", "nao_circulante"),
    "ativo circulante": ("ativo", "circulante"), "ativo nao circulante": ("ativo", "nao_circulante"),
    "passivo circulante": ("passivo", "circulante"), "passivo nao circulante": ("passivo", "nao_circulante"),
    "permanente": ("ativo", "permanente"), "ativo permanente": ("ativo", "permanente"),
    "patrimonio liquido": ("patrimonio_liquido", None), "demonstracao do resultado": ("dre", None),
    "demonstracao do resultado do exercicio": ("dre", None), "demonstracoes do resultado": ("dre", None), "dre": ("dre", None),
}
WHOLE_SIDES = ("patrimonio_liquido", "dre")

# Further titles that may stand before the dates of a header.
HEADER_TITLES = ("conta", "contas", "descricao")

NOTE_WORDS = r"\b(?:notas?|explicativas?)\b"
# A title that ends so goes on with the date: no header, but a sentence.
OPEN_END = r"(?:^|\s)(?:em|de|do|da|a|ate|no|na|e|para)$"
SCALE_LINE = r"(?:em|valores expressos em|r\$)\s+(?:r\$\s*)?(mil|milhares|milhoes|bilhoes|unidades)\b"

LONG_DATE = rf"\d{{1,2}}º?\s+de\s+(?:{'|'.join(MONTHS)}|marco)\s+de\s+(?:19|20)\d{{2}}"
SHORT_DATE = r"\d{1,2}[/.]\d{1,2}[/.](?:19|20)\d{2}"
YEAR = r"(?:19|20)\d{2}"
# An amount, or a dash that stands for none; a minus sign has no blank behind it.
CELL = r"(?:-?(?:\(\s?)?(?:R\$\s*)?-?(?:\d{1,3}(?:\.\d{3})+|\d+)(?:,\d+)?\)?|[-–—])"
# What no token begins with is passed over at once: most of a line is blanks and letters.
TOKEN = (rf"(?i)(?=[\d\-–—(rci])(?:(?<![\w.,/])(?:{LONG_DATE}|{SHORT_DATE}|{YEAR})(?![\w/]|[.,]\d)"
         rf"|(?<![\w])(?:{'|'.join(ENTITY_TYPES)})(?!\w)|(?<=^|\s)(?=\S){CELL}(?=\s|$))")
MOST_TOKENS = 64
MARK = "\x01"

COLUMN = "STRUCT<tipo_entidade: STRING, periodo: STRING, start: INT, end: INT>"


def _choose(value: Column, choices: dict[str, str]) -> Column:
    out = F.lit(None)
    for written, kind in choices.items():
        out = F.when(value == written, kind).otherwise(out)
    return out


def _period(date: Column) -> Column:
    """The day of a date as written, the last of a year."""
    long = F.regexp_extract(date, r"(?i)^(\d{1,2})º?\s+de\s+(\S+)\s+de\s", 2)
    month = F.coalesce(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(long)), F.lit(0))
    month = F.when(F.lower(long) == "marco", 3).otherwise(month)
    year = F.right(date, F.lit(4))
    written = F.when(long != "", F.concat_ws("/", F.regexp_extract(date, r"^\d+", 0), month.cast("string"), year)).otherwise(
        F.replace(date, F.lit("."), F.lit("/")))
    return F.coalesce(F.date_format(F.try_to_timestamp(written, F.lit("d/M/yyyy")), "yyyy-MM-dd"), F.concat(year, F.lit("-12-31")))


def _tokens(line: Column) -> tuple[Column, Column]:
    """Tokens of a line, and the texts around them: one more than there are tokens."""
    return F.regexp_extract_all(line, F.lit(TOKEN), F.lit(0)), F.split(line, TOKEN, -1)


def _with_tokens(lines: DataFrame) -> DataFrame:
    """Add `_tokens` and `_gaps`, found in one search: each token is put between marks, and every second part is one.

    Splitting by a pattern would compile it again for each line, so only lines that have the mark already do.
    """
    line, marked = F.col("line"), F.contains("line", F.lit(MARK))
    tokens, gaps = _tokens(line)
    lines = lines.withColumn("_parts", F.when(~marked, F.split(F.regexp_replace(line, f"({TOKEN})", f"{MARK}$1{MARK}"), MARK, -1)))
    every = {first: F.filter("_parts", lambda _, i: i % 2 == first) for first in (0, 1)}
    return lines.withColumns({"_tokens": F.when(marked, tokens).otherwise(every[1]), "_gaps": F.when(marked, gaps).otherwise(every[0])}).drop("_parts")


def _spans() -> Column:
    """The tokens with where they begin and end, and their kinds."""
    tokens, gaps = F.col("_tokens"), F.col("_gaps")
    near = F.size(tokens) <= MOST_TOKENS
    # Where each gap ends is where its token begins.
    lengths = F.zip_with(gaps, tokens, lambda gap, token: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(token), F.lit(0)).alias("token")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(lengths, begin, lambda done, n: F.struct(
        (done["at"] + n["gap"] + n["token"]).alias("at"), F.concat(done["starts"], F.array(done["at"] + n["gap"])).alias("starts")))["starts"]

    def span(token: Column, start: Column) -> Column:
        # Most tokens are amounts with a comma, and no other kind has one.
        kind = (F.when(token.contains(","), "cell").when(token.rlike(rf"^(?i)(?:{'|'.join(ENTITY_TYPES)})$"), "entity")
                 .when(token.rlike(rf"^(?i)(?:{LONG_DATE}|{SHORT_DATE})$"), "date").when(token.rlike(f"^{YEAR}$"), "year").otherwise("cell"))
        return F.struct(token.alias("text"), start.alias("start"), (start + F.length(token)).alias("end"), kind.alias("kind"))

    near_starts = F.when(near, starts).otherwise(F.array().cast("array<int>"))
    return F.zip_with(tokens, F.slice(near_starts, 1, F.size(tokens)), span)


def split_lines(documents: DataFrame, text: str) -> DataFrame:
    """A row for each line that is not blank, taken apart: what it heads, opens and holds."""
    numbered = documents.where(F.col(text).isNotNull()).select("document_name", F.monotonically_increasing_id().alias("_document"), text)
    lines = numbered.select("document_name", "_document", F.posexplode(F.split(text, "\n")).alias("_pos", "line"))
    lines = _with_tokens(lines.where(strip(F.col("line")) != ""))
    lines = lines.withColumns({"_spans": _spans(), "_label": normal_label(F.array_join("_gaps", " "))})
    lines = lines.withColumn("_title", strip(F.regexp_replace("_label", NOTE_WORDS, "")))

    def of(*kinds: str) -> Column:
        return F.filter("_spans", lambda span: span["kind"].isin(*kinds))

    no_cells, dates, entities = F.size(of("cell")) == 0, of("date", "year"), of("entity")
    plain = (F.col("_title") == "") | F.col("_title").isin(*SECTION_TITLES, *HEADER_TITLES)
    before = F.forall(F.slice("_gaps", 2, F.greatest(F.size("_gaps") - 1, F.lit(0))), lambda gap: ~gap.rlike(r"\w"))
    titled = (F.size(of("year")) == 0) & before & ~F.col("_title").rlike(OPEN_END)

    def kind_before(date: Column) -> Column:
        """The entity word before a date of the same line, or the line's first."""
        earlier = F.filter("_spans", lambda span: (span["kind"] == "entity") & (span["start"] < date["start"]))
        return F.lower(F.coalesce(F.get(earlier, F.size(earlier) - 1), F.get(entities, F.lit(0)))["text"])

    def column(kind: Column, period: Column, span: Column) -> Column:
        return F.struct(kind.cast("string").alias("tipo_entidade"), period.cast("string").alias("periodo"),
                        span["start"].alias("start"), span["end"].alias("end"))

    heads_dates = no_cells & (F.size(dates) > 0) & (plain | titled)
    heads_entities = no_cells & (F.size(dates) == 0) & (F.size(entities) > 0) & plain
    # The words of a scale are in no token, so that most lines need not be searched.
    scaled = F.contains("_label", F.lit("mil")) | F.contains("_label", F.lit("bilhoes")) | F.contains("_label", F.lit("unidades"))
    scale = F.when(scaled, F.regexp_extract(normal_label(F.col("line")), SCALE_LINE, 1)).otherwise("")
    side = _choose(F.col("_title"), {t: s for t, (s, _) in SECTION_TITLES.items() if s})
    term = _choose(F.col("_title"), {t: s for t, (_, s) in SECTION_TITLES.items() if s})
    return lines.select(
        "document_name", "_document", "_pos", "line", "_gaps", "_spans",
        F.when(heads_dates, F.transform(dates, lambda d: column(_choose(kind_before(d), ENTITY_TYPES), _period(d["text"]), d))).alias("_dates"),
        F.when(heads_entities, F.transform(entities, lambda e: column(_choose(F.lower(e["text"]), ENTITY_TYPES), F.lit(None), e))).alias("_entities"),
        F.when(scale != "", scale).alias("_scale"),
        F.when(side.isNotNull(), F.struct(side.alias("name"), "_pos")).alias("_side"),
        F.when(term.isNotNull(), F.struct(term.alias("name"), "_pos")).alias("_term"))


def columns_of(entities: Column, dates: Column) -> Column:
    """Columns in print order, from entity words above and dates.

    Dates with an entity word of their own line keep it. Else the words are shared out: one for each date where they
    repeat, equal shares where the dates repeat, the nearest word where shares cannot be equal; all dates for each
    word where no date repeats, and such columns have no place.
    """
    n, m = F.size(dates), F.coalesce(F.size(entities), F.lit(0))
    distinct = F.array_distinct(F.transform(dates, lambda d: d["periodo"]))
    repeats = n > F.size(distinct)

    def with_kind(kind) -> Column:
        return F.transform(dates, lambda d, i: d.withField("tipo_entidade", kind(d, i)))

    def nearest(date: Column, _: Column) -> Column:
        middle = date["start"] + date["end"]
        return F.array_min(F.transform(entities, lambda e: F.struct(
            F.abs(e["start"] + e["end"] - middle).alias("off"), e["tipo_entidade"].alias("kind"))))["kind"]

    own = F.exists(dates, lambda d: d["tipo_entidade"].isNotNull())
    one_each = (m == n) & (F.size(F.array_distinct(F.transform(entities, lambda e: e["tipo_entidade"]))) < m)
    crossed = F.flatten(F.transform(entities, lambda e: F.transform(dates, lambda d: d.withField("tipo_entidade", e["tipo_entidade"])
                                                                    .withField("start", F.lit(None).cast("int")))))
    return (F.when(own, dates)
             .when(m == 0, with_kind(lambda d, i: F.lit("INDIVIDUAL")))
             .when(m == 1, with_kind(lambda d, i: F.get(entities, F.lit(0))["tipo_entidade"]))
             .when(one_each, with_kind(lambda d, i: F.get(entities, i)["tipo_entidade"]))
             .when(repeats & (n % m == 0), with_kind(lambda d, i: F.get(entities, F.floor(i * m / n).cast("int"))["tipo_entidade"]))
             .when(repeats, with_kind(nearest))
             .otherwise(crossed))


def _section(side: Column, term: Column) -> Column:
    """The open section: a term counts for the side that is open since before it."""
    inside = F.when(term["_pos"] >= side["_pos"], term["name"])
    return F.when(side["name"].isin(*WHOLE_SIDES), side["name"]).when(inside.isNotNull(), F.concat_ws("_", side["name"], inside))


def _with_bounds(columns: Column) -> Column:
    """The columns with the places between which a cell of theirs ends; no right one for the last."""
    n = F.size(columns)

    def bounded(c: Column, i: Column) -> Column:
        before, after = F.get(columns, i - 1), F.get(columns, i + 1)
        left = F.when(i > 0, (before["end"] + c["start"]) / 2).otherwise(
            c["start"] - F.coalesce((after["start"] - c["end"]) / 2, F.length(c["periodo"]) / 2))
        return F.struct(*[c[name].alias(name) for name in ("tipo_entidade", "periodo", "start")], left.alias("left"),
                        F.when(i < n - 1, (c["end"] + after["start"]) / 2).alias("right"))

    return F.transform(columns, bounded)


def _cells_by_column() -> tuple[Column, Column]:
    """For each column its cells by place, and its amount as printed: by place, else by order; NULL where the line has no clear amounts."""
    columns, cells, label_end = F.col("_columns"), F.col("_cells"), F.col("_label_end")
    n = F.size(columns)
    placed = F.transform(columns, lambda c: F.filter(cells, lambda cell: (cell["end"] > c["left"]) & (c["right"].isNull() | (cell["end"] <= c["right"]))))
    first = F.get(columns, F.lit(0))["start"]
    # Every cell is in a column of its own, but for the number of a note to the left of all columns.
    has_place = F.forall(columns, lambda c: c["start"].isNotNull()) & (label_end <= first) & F.forall(cells, lambda c: c["end"].isNotNull())
    clear = (F.forall("_placed", lambda p: F.size(p) <= 1) & F.exists("_placed", lambda p: F.size(p) == 1)
             & (F.size(F.flatten("_placed")) >= F.size(cells) - 1))
    by_place = F.transform("_placed", lambda p: F.get(p, F.lit(0))["text"])
    by_order = F.transform(F.slice(cells, F.greatest(F.size(cells) - n + 1, F.lit(1)), n), lambda c: c["text"])
    return placed, F.when(has_place & clear, by_place).when(F.size(cells) >= n, by_order)


def _with_cells(lines: DataFrame) -> DataFrame:
    """Add `_cells`, those that close the line after its last text, and `_head`, what stands before them."""
    texts = F.filter(F.transform("_gaps", lambda gap, i: F.when(strip(gap) != "", i)), lambda i: i.isNotNull())
    dates = F.filter(F.transform("_spans", lambda s, i: F.when(s["kind"].isin("entity", "date"), i + 1)), lambda i: i.isNotNull())
    lines = lines.withColumn("_from", F.greatest(F.coalesce(F.array_max(texts), F.lit(0)), F.coalesce(F.array_max(dates), F.lit(0))))
    head = F.array_join(F.concat(F.flatten(F.transform(F.slice("_gaps", 1, F.col("_from")), lambda gap, i: F.array(gap, F.get("_spans", i)["text"]))),
                                 F.array(F.coalesce(F.get("_gaps", F.col("_from")), F.lit("")))), "")
    return lines.withColumns({"_cells": F.slice("_spans", F.col("_from") + 1, F.size("_spans")), "_head": head}).drop("_from", "_gaps", "_spans")


def read_statements(documents: DataFrame, text: str = "raw_parsed") -> DataFrame:
    """(document_name, text) -> document_name, tipo_entidade, periodo, line, escala_valores, section, reason.

    A row for every amount; `line` is its label and the amount as printed. A line that gives none is one row without
    entity type and period, and with the reason: no_amounts, no_columns (no dates above it), or unclear_columns.
    """
    lines = _with_cells(split_lines(documents, text))
    above = Window.partitionBy("_document").orderBy("_pos")
    carried = {name: F.last(name, ignorenulls=True).over(above) for name in ("_dates", "_entities", "_scale", "_side", "_term")}
    is_header = (F.col("_dates").isNotNull() | F.col("_entities").isNotNull() | F.col("_scale").isNotNull())
    lines = lines.withColumn("_is_header", is_header).withColumns(carried).where(~F.col("_is_header"))
    made = F.when(F.col("_dates").isNotNull(), columns_of(F.col("_entities"), F.col("_dates")))
    lines = lines.select("document_name", "_document", "_pos", "line", F.col("_scale").alias("escala_valores"),
                         _section(F.col("_side"), F.col("_term")).alias("section"), "_cells", "_head", made.alias("_columns"))
    lines = lines.withColumn("_columns", _with_bounds(F.col("_columns")))
    lines = lines.withColumn("_label_end", F.length(F.rtrim("_head")))
    placed, amounts = _cells_by_column()
    lines = lines.withColumn("_placed", placed).withColumn("_amounts", amounts)
    reason = (F.when(F.size("_cells") == 0, "no_amounts").when(F.col("_columns").isNull(), "no_columns")
               .when(F.col("_amounts").isNull(), "unclear_columns"))
    # Computed once, so that a filter by it does not move below the steps above and repeat them.
    lines = computed_once(lines, "reason", reason)
    found = F.filter(F.zip_with("_amounts", "_columns", lambda amount, c: F.struct(
        c["tipo_entidade"].alias("tipo_entidade"), c["periodo"].alias("periodo"),
        F.when(amount.isNotNull(), F.concat(strip(F.col("_head")), F.lit(" "), strip(amount))).alias("line"))), lambda row: row["line"].isNotNull())
    none = F.array(F.struct(F.lit(None).cast("string").alias("tipo_entidade"), F.lit(None).cast("string").alias("periodo"), F.col("line")))
    return lines.select("document_name", "escala_valores", "section", "reason", F.inline(F.when(F.col("reason").isNull(), found).otherwise(none))).select(
        "document_name", "tipo_entidade", "periodo", "line", "escala_valores", "section", "reason")


def statement_lines(documents: DataFrame, text: str = "raw_parsed") -> DataFrame:
    """The same without section and reason."""
    return read_statements(documents, text).drop("section", "reason")


def left_out(documents: DataFrame, text: str = "raw_parsed") -> DataFrame:
    """How many lines gave no amounts, by reason."""
    return read_statements(documents, text).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n_lines"))
