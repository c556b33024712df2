"""Labels that are not written as the dictionary writes them, matched by similarity.

Only distinct labels are compared. Labels and names are first brought to a common
form: link words and plural endings go. Then a label names what is within a few
edits of it (`edits`: one for every six characters, three at most). Candidates
come from a q-gram prefix filter: within t edits, at most q·t of a label's grams
change, so of the q·t + 1 rarest grams of both at least one is shared; rarity is
counted over the names. Levenshtein's distance confirms a candidate. Shortened
words (`emprest. e financ.`) are looked up by the first letters of their words,
and confirmed word by word.

The nearest name wins. A label is left unmatched, with a reason, where nothing is
near (`unknown`), where nearest names stand for several fields (`ambiguous`), or
where they name a field only under a section that is not open (`no_section`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from razonete.operators.line_items import read_lines
from razonete.sources.dictionary import ANYWHERE, synonyms_df

Q = 2
MOST_EDITS = 3

# Words that link others in labels.
LINK_WORDS = ["a", "as", "ao", "com", "da", "das", "de", "do", "dos", "e", "em", "o", "os", "p", "para", "por", "sobre"]

# Plural endings and what they become.
PLURALS = [("(oes|aes)$", "ao"), ("ais$", "al"), ("(eis)$", "el"), ("(r|z)es$", "$1"), ("s$", "")]


def words(label: Column) -> Column:
    """The words of a label that count, without marks around them; a dot behind a shortened word stays."""
    found = F.split(F.btrim(F.regexp_replace(label, r"[^\p{L}\p{N}.]+", " ")), " ")
    return F.filter(found, lambda w: ~w.isin("", ".", *LINK_WORDS))


def singular(word: Column) -> Column:
    for ending, one in PLURALS:
        word = F.regexp_replace(word, ending, one)
    return word


def common_form(label: Column) -> Column:
    return F.array_join(F.transform(words(label), lambda w: singular(F.rtrim(w, F.lit(".")))), " ")


def edits(form: Column) -> Column:
    return F.least(F.floor(F.length(form) / 6), F.lit(MOST_EDITS)).cast("int")


def grams(form: Column) -> Column:
    """The q-grams of a text with a blank on either side, repeated ones numbered."""
    padded = F.concat(F.lit(" "), form, F.lit(" "))
    plain = F.transform(F.sequence(F.lit(1), F.length(form) + 2 - Q + 1), lambda i: F.substring(padded, i, F.lit(Q)))
    return F.transform(plain, lambda gram, i: F.concat(gram, F.size(F.filter(F.slice(plain, 1, i), lambda g: g == gram)).cast("string")))


def _rarest(forms: DataFrame, often: DataFrame, n: Column) -> DataFrame:
    """Rows (form, gram): the `n` grams of each form that the fewest names have."""
    rows = forms.select("form", n.alias("_n"), F.explode(grams(F.col("form"))).alias("gram"))
    ranked = rows.join(often, "gram", "left").withColumn(
        "_rank", F.row_number().over(Window.partitionBy("form").orderBy(F.coalesce("often", F.lit(0)), "gram")))
    return ranked.where(F.col("_rank") <= F.col("_n")).select("form", "gram")


def _near(forms: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (form, name, distance): the names within reach of each form."""
    often = names.select(F.explode(grams(F.col("name"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("often"))
    index = _rarest(names.select(F.col("name").alias("form")), often, F.lit(Q * MOST_EDITS + 1)).withColumnRenamed("form", "name")
    pairs = _rarest(forms, often, Q * edits(F.col("form")) + 1).join(index, "gram").select("form", "name").distinct()
    near = pairs.where(F.abs(F.length("form") - F.length("name")) <= edits(F.col("form"))).withColumn("distance", F.levenshtein("form", "name"))
    return near.where(F.col("distance") <= edits(F.col("form")))


def _initials(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda w: F.left(w, F.lit(1))), "")


def _shortened(labels: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (label, name): names whose words a label with shortened words begins."""
    short = labels.where(F.col("label").contains(".")).select("label", words(F.col("label")).alias("_parts")).where(
        F.exists("_parts", lambda w: w.endswith(".")))
    whole = names.select("name", F.split("name", " ").alias("_whole")).withColumn("_key", _initials(F.col("_whole")))
    both = short.withColumn("_key", _initials(F.col("_parts"))).join(whole, "_key")
    fits = F.forall(F.zip_with("_parts", "_whole", lambda part, word: F.when(
        part.endswith("."), word.startswith(F.rtrim(part, F.lit(".")))).otherwise(singular(part) == word)), lambda fit: fit)
    return both.where((F.size("_parts") == F.size("_whole")) & fits).select("label", "name")


def resolve(labels: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Rows (label, section, path, distance, reason, paths) for the distinct rows (label, section) of `labels`.

    `synonyms` has (label, section, path) as `dictionary.synonyms_df` gives them. `paths` holds the fields of the
    nearest names, `path` the only one of them.
    """
    labels = labels.select("label", "section").distinct().withColumn("form", common_form(F.col("label")))
    known = synonyms.select(common_form(F.col("label")).alias("name"), F.col("section").alias("_section"), "path").distinct()
    names = known.select("name").where("name <> ''").distinct()
    near = _near(labels.select("form").where("form <> ''").distinct(), names).join(labels.select("form", "label").distinct(), "form").select("label", "name", "distance")
    short = _shortened(labels.select("label").distinct(), names).withColumn("distance", F.lit(0))
    named = near.union(short).join(known, "name")
    holds = (F.col("_section") == ANYWHERE) | F.col("_section").eqNullSafe(F.col("section"))
    choices = labels.join(named, "label", "left").withColumn("_holds", F.coalesce(holds & F.col("name").isNotNull(), F.lit(False)))
    # At most as many rows for a label as the dictionary has names.
    nearest = choices.groupBy("label", "section").agg(
        F.min(F.when(F.col("_holds"), F.col("distance"))).alias("distance"), F.count("name").alias("_n"),
        F.collect_set(F.when(F.col("_holds"), F.struct("distance", "path"))).alias("_found"))
    paths = F.array_sort(F.array_distinct(F.transform(
        F.filter("_found", lambda f: f["distance"] == F.col("distance")), lambda f: f["path"])))
    nearest = nearest.withColumn("paths", paths)
    reason = F.when(F.col("_n") == 0, "unknown").when(F.size("paths") == 0, "no_section").when(F.size("paths") > 1, "ambiguous")
    return nearest.select("label", "section", F.when(F.size("paths") == 1, F.get("paths", F.lit(0))).alias("path"), "distance",
                          reason.alias("reason"), "paths")


def with_similar(lines: DataFrame, synonyms: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Synonyms for `line_items` with those found for the labels of these lines, and the labels that name nothing.

    The second has (label, section, reason, paths, n_lines).
    """
    synonyms = synonyms_df(lines.sparkSession) if synonyms is None else synonyms
    labels = read_lines(lines).where(F.col("value").isNotNull()).groupBy("label", "section").agg(F.count("*").alias("n_lines"))
    known = synonyms.withColumnsRenamed({"label": "_label", "section": "_section"}).drop("path").distinct()
    holds = (F.col("_section") == ANYWHERE) | F.col("_section").eqNullSafe(F.col("section"))
    unknown = labels.join(known, (F.col("label") == F.col("_label")) & holds, "left_anti")
    found = resolve(unknown, synonyms)
    rejected = found.where("path IS NULL").join(unknown, found["label"].eqNullSafe(unknown["label"]) & found["section"].eqNullSafe(unknown["section"]))
    return (synonyms.select("label", "section", "path").union(found.where("path IS NOT NULL").select("label", "section", "path")),
            rejected.select(found["label"], found["section"], "reason", "paths", "n_lines"))
