"""String expressions: names, labels, amounts and money formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from razonete.sources.dictionary import ACCENTED, PLAIN

WHITESPACE = " \t\n\r\f\v"

# A pt-BR amount closing a line: optional sign, brackets and currency mark,
# dots between thousands, a comma before the decimals.
# What no amount begins with is passed over at once.
AMOUNT = r"(?=[-\s(R\d])-?\s*\(?\s*(?:R\$\s*)?-?(?:\d{1,3}(?:\.\d{3})+|\d+)(?:,\d+)?\)?\s*$"


def strip(text: Column) -> Column:
    """Trim every kind of blank, not only the space character."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    # Blanks are taken from the left alone: Spark needs eight bytes more for each byte of a text to take them from the right.
    return text.isNull() | (F.ltrim(text, F.lit(WHITESPACE)) == "")


def strip_scheme(path: Column) -> Column:
    """Drop a leading `scheme:` so that the same file has one path everywhere."""
    return F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//(?=/))?", "")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def document_key(name: Column, suffix: str = ".pdf") -> Column:
    """File name of a document whose suffix may have been left out."""
    return F.when(name.endswith(suffix), name).otherwise(F.concat(name, F.lit(suffix)))


def preview(text: Column, length: int) -> Column:
    """The first `length` characters (not bytes) of a text, for display."""
    return F.substring(text, 1, length)


def normal_label(text: Column) -> Column:
    """Lower-case, accent-free, single-spaced label without punctuation around it."""
    # translate() looks up every character; plain ASCII labels need no accents removed.
    ascii_only = F.octet_length(text) == F.char_length(text)
    plain = F.when(ascii_only, F.lower(text)).otherwise(F.translate(F.lower(text), ACCENTED, PLAIN))
    return F.btrim(F.regexp_replace(plain, r"\s+", " "), F.lit(" .:_-"))


def amount_tail(line: Column) -> Column:
    """The amount that closes a statement line, as written; '' when there is none."""
    return F.regexp_extract(line, AMOUNT, 0)


def label_before(line: Column, tail: Column) -> Column:
    return normal_label(F.left(line, F.length(line) - F.length(tail)))


def tail_amount(tail: Column) -> Column:
    """DECIMAL(26,6) of a closing amount, NULL for ''; a declared scale applies before cents are rounded.

    Brackets around it or a minus sign make the amount negative, both together no less.
    """
    number = F.replace(F.regexp_replace(tail, r"[-.()R$\s]", ""), F.lit(","), F.lit(".")).try_cast("decimal(26,6)")
    return F.when(tail.rlike(r"-|\(.*\)"), -number).otherwise(number)


# Unit scales a statement may declare for its amounts.
SCALES = {"unidades": 1, "mil": 1_000, "milhares": 1_000, "milhoes": 1_000_000, "bilhoes": 1_000_000_000}


def scale_factor(scale: Column) -> Column:
    """Multiplier of a declared unit scale; 1 when absent or unknown. The label is read once, and no word ends with another."""
    word = F.regexp_extract(normal_label(scale), rf"({'|'.join(SCALES)})\z", 1)
    factors = F.create_map(*[F.lit(part) for entry in SCALES.items() for part in entry])
    return F.coalesce(F.try_element_at(factors, word), F.lit(1)).cast("decimal(10,0)")


def format_amount(value: Column, digits: int = 2) -> Column:
    """1234.5 -> '1.234,50'."""
    return swap_marks(F.format_number(value, digits))


def swap_marks(number: Column) -> Column:
    """Exchange the comma and the dot of a formatted number."""
    swapped = F.replace(F.replace(number, F.lit(","), F.lit("_")), F.lit("."), F.lit(","))
    return F.replace(swapped, F.lit("_"), F.lit("."))


def format_money(value: Column, digits: int = 2) -> Column:
    """pt-BR currency text, '-R$ 1.234,50' with a no-break space after the mark."""
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("R$ "), format_amount(F.abs(value), digits))


def fixed_two(value: Column) -> Column:
    """1234.5 -> '1234.50', the plain form shown while editing."""
    return F.replace(F.format_number(value, 2), F.lit(","))


def format_cell(text: Column, kind: Column) -> Column:
    """Display form of a cell: blank for missing, money for numbers, else as is."""
    number = F.regexp_extract(text, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1).try_cast("double")
    return (F.when(text.isNull() | text.isin("", "null"), F.lit(""))
             .when((kind == "number") & number.isNotNull(), format_money(number))
             .otherwise(text))
