"""Quality rules: a table of thresholds, compiled into one projection of Spark expressions.

A rule bounds one measure of a text, by itself or as a share (in percent) of
another; shares are compared as whole numbers, so nothing is rounded. Measures:

    n_words, word_chars  words (ended by ASCII white space) and their code points
    n_symbols            characters of `#*$%&|<>`
    n_marks              ASCII punctuation characters, symbols included
    n_stop_words         words of `STOP_WORDS`, in either case, closing punctuation left out
    n_lines              lines with a word, lines ended by \\n
    n_dup_lines          those of them equal to an earlier one
    n_repeat_words       words in runs of `WINDOW` words that occur twice or more in the text

Nothing is shuffled or sent to Python: each text is measured where it is read.
Runs of words are compared by 64-bit hashes, sorted within their text, so the
time for a text of n words grows with n log n, and the memory with n; n runs
have a chance of n² / 2^65 of a false match.

Null texts count as empty, and empty ones have no words: all measures are 0.
Equal texts have equal results, repeated rows stay, other columns pass through;
an empty table gives an empty one. New columns must not clash with those of the
table; see `free_name`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from razonete.functions.jsonops import computed_once
from razonete.llm.common import free_name

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MARKS = r"[!-/:-@\[-`{-~]"
CLOSING = ".,;:!?"

# Frequent words without accents of English, German, French and Spanish.
STOP_WORDS = """
the be to of and that have with a in is it for on was as are this by from
der die das und ein zu den von ist nicht mit im auf dem des
le la les et de un une du que est pour sur au dans en
el los las y por se no para con su lo una
""".split()


class Rule(NamedTuple):
    """`measure` must lie between `least` and `most`: as it is, or in percent of the measure `per`."""

    name: str
    measure: str
    per: str | None = None
    least: int | None = None
    most: int | None = None

    def broken(self) -> Column:
        value, unit = (F.col(self.measure), F.lit(1)) if self.per is None else (100 * F.col(self.measure), F.col(self.per))
        out = F.lit(False)
        if self.least is not None:
            out = out | (value < self.least * unit)
        if self.most is not None:
            out = out | (value > self.most * unit)
        return out


BASE_RULES = [
    Rule("few words", "n_words", least=20),
    Rule("repeated words", "n_repeat_words", "n_words", most=30),
]

RULES = [
    *BASE_RULES,
    Rule("word length", "word_chars", "n_words", least=300, most=1000),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("punctuation", "n_marks", "word_chars", most=20),
    Rule("stop words", "n_stop_words", "n_words", least=2),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=40),
]


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    for blank in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a run of `window` words that occurs more than once."""
    def positions(ordered: Column) -> Column:
        """Where runs with an equal neighbour in the order of their hashes begin."""
        return F.sort_array(F.filter(F.transform(ordered, lambda run, i: F.when(
            F.coalesce(F.get(ordered, i - 1)["hash"] == run["hash"], F.lit(False))
            | F.coalesce(F.get(ordered, i + 1)["hash"] == run["hash"], F.lit(False)), run["at"])), lambda at: at.isNotNull()))

    def covered(at: Column) -> Column:
        """Words of runs that begin there, each counted once."""
        until_next = F.transform(at, lambda a, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - a, F.lit(window))))
        return F.aggregate(until_next, F.lit(0), lambda total, n: total + n)

    def of_hashes(hashes: Column) -> Column:
        runs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            _with(_with(runs, positions), covered))

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(F.size(words) > window, _with(hashes, of_hashes)).otherwise(0)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of each text, as longs."""
    words, lines = free_name(docs, "_words"), free_name(docs, "_lines")
    whole = F.coalesce(text, F.lit(""))
    worded = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(" \t\x0b\f\r")) != "")
    # Both are named more than once below, so the optimizer leaves them in a projection of their own.
    found = docs.select("*", words_of(whole).alias(words), worded.alias(lines))
    stop = F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(CLOSING))).isin(STOP_WORDS)))
    measures = {
        "n_words": F.size(words), "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)), "n_marks": F.regexp_count(whole, F.lit(MARKS)),
        "n_stop_words": stop, "n_lines": F.size(lines), "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(F.col(words)),
    }
    return found.select(*docs.columns, *[value.cast("long").alias(name) for name, value in measures.items()])


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row breaks, in the order of the table."""
    return F.array_compact(F.array(*[F.when(rule.broken(), rule.name) for rule in rules]))


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Add the measures, `broken` (names of the rules a text breaks) and `kept` (it breaks none)."""
    found = computed_once(measure(docs, text), "broken", broken_rules(rules))
    return found.withColumn("kept", F.size("broken") == 0)


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows whose text breaks no rule, as they are; columns may have any names."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = judge(docs.select(row, F.col(f"`{text}`").alias("_text")), rules, "_text")
    return judged.where("kept").select("_row.*")
