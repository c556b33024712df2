"""Scores of an extraction: STRUCT<name, value BOOLEAN, rationale> columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from razonete.functions.jsonops import is_truthy, number_at, path_get, to_double
from razonete.functions.text import strip
from razonete.sources.dictionary import REQUIRED_KEYS


# Wording of the rationales.
FIELD_RATIONALE = "Extraído: %s | Correto: %s | Delta: %s"
TEXT_RATIONALE = "Extraído: '%s' | Correto: '%s'"
NO_CORRECTION = "Sem correção registrada"
STRUCTURE_OK = "Estrutura OK"
MISSING_KEYS = "Campos ausentes: %s"
BALANCE_RATIONALE = "Ativo: %s | Passivo: %s | Delta: %s%%"
ZERO_ASSETS = "Ativo Total é zero"
NO_OBJECT = "Output não é um objeto"
NO_NUMBER = "Valor não numérico"


def _score(name: Column, value: Column, rationale: Column) -> Column:
    return F.struct(name.alias("name"), value.cast("boolean").alias("value"), rationale.alias("rationale"))


def _plain(number: Column) -> Column:
    return F.replace(F.format_number(number, 2), F.lit(","))


def score_field(extracted: Column, expected: Column, corrected: Column | None = None, tol: float = 0.01) -> Column:
    """Compare an extracted value (as text) with the reviewer's.

    Two numbers, decimal comma allowed, agree within the relative tolerance
    (exactly when the expected one is 0). Otherwise the trimmed, lower-cased
    texts must be equal; a missing value reads 'none'. Where `corrected` is
    false the score is NULL.
    """
    found = to_double(F.replace(extracted, F.lit(","), F.lit(".")))
    wanted = to_double(F.replace(expected, F.lit(","), F.lit(".")))
    numeric = found.isNotNull() & wanted.isNotNull()
    close = F.when(wanted == 0, found == 0).otherwise(F.try_divide(F.abs(found - wanted), F.abs(wanted)) <= tol)
    shown, target = F.coalesce(extracted, F.lit("None")), F.coalesce(expected, F.lit("None"))
    same = F.lower(strip(shown)) == F.lower(strip(target))
    present = F.lit(True) if corrected is None else corrected
    return _score(
        F.when(present & ~numeric, "text_match").otherwise("numeric_accuracy"),
        F.when(present, F.when(numeric, close).otherwise(same)),
        F.when(~present, NO_CORRECTION)
         .when(numeric, F.format_string(FIELD_RATIONALE, _plain(found), _plain(wanted), _plain(F.abs(found - wanted))))
         .otherwise(F.format_string(TEXT_RATIONALE, shown, target)))


def missing_keys(text: Column) -> Column:
    """Required top-level keys a JSON object text does not have, in declared order."""
    return F.array_except(F.array(*[F.lit(k) for k in REQUIRED_KEYS]), F.json_object_keys(text))


def score_structure(text: Column) -> Column:
    """True when a JSON object text carries every required top-level key."""
    missing = missing_keys(text)
    listed = F.format_string(MISSING_KEYS, F.array_join(missing, ", "))
    return _score(
        F.lit("json_structure_valid"),
        F.coalesce(F.size(missing) == 0, F.lit(False)) & missing.isNotNull(),
        F.when(missing.isNull(), NO_OBJECT).when(F.size(missing) == 0, STRUCTURE_OK).otherwise(listed))


def score_balance(value: Column, tol_pct: float = 1.0) -> Column:
    """True when total assets and total liabilities differ by at most `tol_pct` percent.

    NULL when assets are zero or missing, or when either is not a number.
    """
    def amount(path: str) -> Column:
        return F.when(is_truthy(path_get(value, path, "variant")), number_at(value, path)).otherwise(F.lit(0.0))

    assets, liabilities = amount("ativo_total"), amount("passivo_total")
    delta = F.try_divide(F.abs(assets - liabilities), F.abs(assets)) * 100
    known = assets.isNotNull() & liabilities.isNotNull() & (assets != 0)
    return _score(
        F.lit("balanco_equilibrado"),
        F.when(known, delta <= tol_pct),
        F.when(assets == 0, ZERO_ASSETS)
         .when(~F.coalesce(known, F.lit(False)), NO_NUMBER)
         .otherwise(F.format_string(BALANCE_RATIONALE, F.format_number(assets, 2), F.format_number(liabilities, 2),
                                    F.format_number(delta, 2))))
