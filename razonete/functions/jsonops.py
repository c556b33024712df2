"""Reading model-written JSON: fences, envelopes, records, paths and numbers.

Texts are parsed once into VARIANT and read by path from there. Everything is
built-in expressions, so parsing stays inside the JVM and is spread over the
partitions of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from razonete.functions.text import strip

# Closes the array each text is wrapped in before parsing. The parser stops
# after the first value and would accept '[1] and more'; inside the wrapper
# anything after the value makes the parse fail or moves the mark.
END_MARK = "~end~"

FENCE = "```"

# JSON forms of the values Python counts as false.
FALSY = ["null", "false", '""', "0", "0.0", "-0.0", "[]", "{}"]


def strip_fences(text: Column) -> Column:
    """Content of a fenced answer, without its `json` tag; other text only trimmed."""
    body = F.regexp_replace(F.split_part(strip(text), F.lit(FENCE), F.lit(2)), "^json", "")
    return F.when(strip(text).startswith(FENCE), body).otherwise(strip(text))


def path_get(value: Column, path: str | Column, type_: str = "string") -> Column:
    """Value at a dot path, NULL when a step is missing, not an object or not of the type."""
    if isinstance(path, str):
        return F.try_variant_get(value, f"$.{path}", type_)
    # A path that is no plain dotted name names nothing, rather than failing the row.
    clean = F.when(path.rlike(r"^[A-Za-z_]\w*(\.[A-Za-z_]\w*)*$"), F.concat(F.lit("$."), path))
    return F.try_variant_get(value, clean, type_)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that it is evaluated once per row.

    Written as the explode of a one-element array: the optimizer neither copies
    the expression into the projections above nor into filters it pushes down.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse_column(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add `out`: the VARIANT of a JSON text, NULL unless the whole text is one value."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(f',"{END_MARK}"]')))
    whole = (F.size("_wrapped") == 2) & (F.try_variant_get(F.get("_wrapped", F.lit(1)), "$", "string") == END_MARK)
    return (computed_once(df, "_wrapped", F.try_variant_get(wrapped, "$", "array<variant>"))
            .withColumn(out, F.when(whole, F.get("_wrapped", F.lit(0))))
            .drop("_wrapped"))


def is_truthy(value: Column) -> Column:
    """Python truth of a VARIANT; false for SQL NULL."""
    return value.isNotNull() & ~F.to_json(value).isin(FALSY)


def is_string(value: Column) -> Column:
    """Whether a VARIANT is a text; arrays and objects are told apart without writing them out."""
    nested = (F.try_variant_get(value, "$", "array<variant>").isNotNull()
              | F.try_variant_get(value, "$", "map<string, variant>").isNotNull())
    return F.when(nested, F.lit(False)).otherwise(F.to_json(value).startswith('"'))


def unwrap_envelope(df: DataFrame, value: str, out: str, reason: str) -> DataFrame:
    """Take the answer out of a call envelope.

    `{"result": …, "errorMessage": …}` gives its result, `{"predictions": …}` its
    value or the single element of it; an inner text is parsed again. Any other
    value passes. `reason` says why there is none: bad_json, call_error or
    null_result.
    """
    result = F.try_variant_get(value, "$.result", "variant")
    predictions = F.try_variant_get(value, "$.predictions", "variant")
    as_list = F.try_variant_get(predictions, "$", "array<variant>")
    single = F.when(F.size(as_list) == 1, F.get(as_list, F.lit(0))).otherwise(predictions)
    step = (
        df.withColumn("_result", result)
          .withColumn("_failed", F.when(F.col(value).isNull(), "bad_json")
                      .when(F.col("_result").isNotNull()
                            & is_truthy(F.try_variant_get(value, "$.errorMessage", "variant")), "call_error")
                      .when(F.is_variant_null("_result"), "null_result"))
          .withColumn("_inner", F.coalesce("_result", single))
          .withColumn("_inner_text", F.when(is_string(F.col("_inner")),
                                            strip_fences(F.try_variant_get("_inner", "$", "string"))))
    )
    step = parse_column(step, "_inner_text", "_parsed")
    answer = (F.when(F.col("_failed").isNotNull(), None)
               .when(F.col("_inner_text").isNotNull(), F.col("_parsed"))
               .otherwise(F.coalesce("_inner", F.col(value))))
    return (step.withColumn(out, answer)
                .withColumn(reason, F.coalesce("_failed", F.when(F.col(out).isNull(), "bad_json")))
                .drop("_result", "_failed", "_inner", "_inner_text", "_parsed"))


def as_records(value: Column) -> Column:
    """An array stays one; any other value becomes a one-element array."""
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.when(value.isNotNull(), F.array(value)))


# What Python's float() reads. Spark alone would accept a Java type suffix
# ('12f') and refuse digit grouping ('1_000').
_DIGITS = r"\d+(?:_\d+)*"
FLOAT_TEXT = rf"^\s*[+-]?(?i:nan|inf|infinity|(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?)\s*$"


def to_double(text: Column) -> Column:
    """Number in a text, else NULL."""
    return F.when(text.rlike(FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def to_double_sql(text: str) -> str:
    """`to_double` of a SQL expression, for column lists written as SQL text."""
    return f"CASE WHEN {text} RLIKE r'{FLOAT_TEXT}' THEN try_cast(replace({text}, '_', '') AS DOUBLE) END"


def number_at(value: Column, path: str | Column) -> Column:
    """Number at a path: JSON numbers, booleans and numeric texts; else NULL."""
    text = path_get(value, path)
    return F.coalesce(to_double(text), F.when(text.isin("true", "false"), path_get(value, path, "double")))


def fields_ddl(paths: list[str]) -> str:
    """DDL of a record that holds the given one- or two-step paths as texts."""
    sections: dict[str, list[str]] = {}
    for path in paths:
        section, _, name = path.rpartition(".")
        sections.setdefault(section, []).append(f"{name}: string")
    members = sections.pop("", [])
    members += [f"{section}: struct<{', '.join(inner)}>" for section, inner in sections.items()]
    return f"struct<{', '.join(members)}>"


def read_fields(df: DataFrame, paths: list[str], keep: list[str], text: str = "extracted_json") -> DataFrame:
    """`keep` columns, then `raw_<i>` (the text at paths[i]) and `truth_<i>` for each path.

    One pass over the JSON text fills a struct with all paths, which costs far
    less than a search per path. truth_<i> is 1.0 or 0.0 where the value is a
    JSON boolean, to tell it from the texts 'true' and 'false'; only records
    that hold a boolean are parsed a second time for it.
    """
    parsed = df.selectExpr(*keep, f"from_json({text}, '{fields_ddl(paths)}') AS fields",
                           f"CASE WHEN {text} RLIKE r':\\s*(true|false)' THEN try_parse_json({text}) END AS booleans")
    raw = parsed.selectExpr(*keep, "booleans", *[f"fields.{path} AS raw_{i}" for i, path in enumerate(paths)])
    truths = [f"CASE WHEN booleans IS NOT NULL AND raw_{i} IN ('true', 'false') "
              f"THEN try_variant_get(booleans, '$.{path}', 'double') END AS truth_{i}" for i, path in enumerate(paths)]
    return raw.selectExpr(*keep, *[f"raw_{i}" for i in range(len(paths))], *truths)


def safe_double(value: Column, path: str | Column) -> Column:
    """Number at a path, 0.0 when missing or not a number."""
    return F.coalesce(number_at(value, path), F.lit(0.0))


def text_at(value: Column, path: str | Column) -> Column:
    """Text at a path, '' when missing or false in Python's sense."""
    found = path_get(value, path, "variant")
    return F.when(is_truthy(found), path_get(value, path)).otherwise(F.lit(""))


def parse_failure(text: Column, kept: int | None = None) -> Column:
    """The one-record answer that stands for an unreadable model text, which it keeps whole or up to `kept` characters."""
    raw = F.substring(text, 1, kept) if kept else text
    return F.to_json(F.array(F.struct(F.lit("parse_failed").alias("error"), raw.alias("raw"))))


def message_text(messages: Column, *fallbacks: Column) -> Column:
    """Content of the last chat message, else the first fallback text, else ''."""
    return F.coalesce(F.get(messages, F.size(messages) - 1)["content"], *fallbacks, F.lit(""))
