"""Named queries: every operator over the supplied tables.

Each takes (spark, folder) and returns a DataFrame. Queries that show a sink or
a stream write below the shared work folder first and read back from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from razonete.functions import jsonops, scoring, text as texts
from razonete.operators import (
    batch_score as calls, elements, evaluate, export, ingest, label_match, line_items as items, metrics, normalize as norm,
    review, runs, statement_text, upsert as merging)
from razonete.operators.joins import join_unique
from razonete.plans import stages
from razonete.schemas import CORRECTIONS, EXTRACTED, REJECTS, STATEMENT_KEY, STATEMENTS
from razonete.session import configure, work_dir
from razonete.sources import derived, dictionary, files, tables
from razonete.sources.bucketed import BucketedStore
from razonete.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def _extracted(spark, folder):
    return derived.extracted_content(spark, folder)


def _statements(spark, folder):
    """Statement rows of all readable answers, with path and pos."""
    return norm.statements_of(norm.records(_extracted(spark, folder)))


def _corrections(spark, folder):
    return merging.latest_corrections(derived.correction_log(spark, folder))


# --- answers to statements ---------------------------------------------------

@query
def normalize_results(spark, folder):
    return _statements(spark, folder).select(
        "document_name", "tipo_entidade", "periodo", "razao_social", "cnpj", "ativo_total", "lucro_liquido")


@query
def normalize_rejects(spark, folder):
    _, rejects = norm.normalize(_extracted(spark, folder))
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


@query
def strip_fences(spark, folder):
    """Every third text fenced as JSON, every third plainly, the rest bare."""
    kind, fence = F.col("doc_id") % 3, jsonops.FENCE
    wrapped = (F.when(kind == 0, F.concat(F.lit(f"{fence}json\n"), "text", F.lit(f"\n{fence}")))
                .when(kind == 1, F.concat(F.lit(f"\n {fence}"), "text", F.lit(f"{fence}\n"))).otherwise(F.col("text")))
    return derived.table(spark, folder, "documents").select("doc_id", jsonops.strip_fences(wrapped).alias("body"))


@query
def unwrap_envelope(spark, folder):
    return norm.answers(_extracted(spark, folder)).select(
        "document_name", "reason", F.array_size(jsonops.as_records(F.col("answer"))).cast("bigint").alias("n_records"))


@query
def path_get(spark, folder):
    props = F.try_parse_json("props")
    return derived.table(spark, folder, "events").select(
        "event_id", jsonops.path_get(props, "k", "bigint").alias("k"), jsonops.path_get(props, "k.deeper").alias("deeper"))


@query
def safe_double(spark, folder):
    record = F.col("record")
    return norm.records(_extracted(spark, folder)).where("reason IS NULL").select(
        "document_name", jsonops.text_at(record, "tipo_entidade").alias("tipo_entidade"),
        jsonops.text_at(record, "identificacao.periodo").alias("periodo"),
        jsonops.safe_double(record, "dre.lucro_liquido").alias("from_text"),
        jsonops.safe_double(record, "razao_social").alias("from_name"),
        jsonops.safe_double(record, "dre.no_such_field").alias("from_nothing"))


@query
def tag_parse_failures(spark, folder):
    return norm.tag_parse_failures(_extracted(spark, folder)).select("document_name", "extracted")


@query
def flatten_statement(spark, folder):
    return norm.flatten_statement(_statements(spark, folder)).drop("extracted_json")


@query
def dedupe_batch(spark, folder):
    """Orders as records of (customer, status, year): the last order of each wins."""
    rows = derived.table(spark, folder, "orders").select(
        derived.numbered("c", "o_custkey").alias("document_name"), F.col("o_orderstatus").alias("tipo_entidade"),
        derived.year_end("o_orderdate").alias("periodo"), F.col("o_totalprice").alias("ativo_total"),
        F.col("o_orderpriority").alias("razao_social"), F.lit("").alias("path"), F.col("o_orderkey").alias("pos"))
    return norm.dedupe_batch(rows)


# --- review ------------------------------------------------------------------

@query
def document_list(spark, folder):
    return review.document_list(_statements(spark, folder))


@query
def document_cards(spark, folder):
    return review.document_cards(review.document_list(_statements(spark, folder), ordered=False))


@query
def document_detail(spark, folder):
    detail = jsonops.computed_once(review.document_detail(_statements(spark, folder)), "record", F.try_parse_json("extracted_json"))
    return detail.select("document_name", "tipo_entidade", "periodo",
                         jsonops.number_at(F.col("record"), "ativo_total").alias("ativo_total"))


@query
def document_by_name(spark, folder):
    """One document's current records out of sorted batches, found by its name without the suffix."""
    root = work_dir(spark, "statements")
    stored = norm.dedupe_batch(_statements(spark, folder)).withColumns(
        {"answer_id": F.lit(None).cast("string"), "processed_at": F.current_timestamp()})
    tables.commit_batch(stored, root, 0, ["document_name"])
    batches = tables.read_batches(spark, root, STATEMENTS)
    name = batches.agg(F.min("document_name")).first()[0].removesuffix(".pdf")
    key = texts.document_key(F.lit(name))
    current = tables.current_rows(batches.where(F.col("document_name") == key), STATEMENT_KEY)
    return review.document_detail(current).select(
        "document_name", "tipo_entidade", "periodo", jsonops.number_at(F.try_parse_json("extracted_json"), "ativo_total").alias("ativo_total"))


@query
def default_record(spark, folder):
    return review.default_record(_statements(spark, folder).select(
        "document_name", "tipo_entidade", "periodo", "razao_social", "ativo_total"))


@query
def record_labels(spark, folder):
    return review.record_labels(_statements(spark, folder))


@query
def document_key(spark, folder):
    name = derived.numbered("d", "doc_id", "")
    given = F.when(F.col("lang") == "en", F.concat(name, F.lit(".pdf"))).otherwise(name)
    return derived.table(spark, folder, "documents").select("doc_id", texts.document_key(given).alias("document_key"))


@query
def statement_combos(spark, folder):
    orders = derived.table(spark, folder, "orders").select(
        derived.numbered("c", "o_custkey").alias("document_name"), F.col("o_orderstatus").alias("tipo_entidade"),
        derived.year_end("o_orderdate").alias("periodo"))
    return review.statement_combos(orders)


@query
def latest_status(spark, folder):
    log = derived.table(spark, folder, "events").select(
        derived.numbered("c", "user_id").alias("document_name"), F.col("event_type").alias("status"), "ts", "event_id")
    documents = derived.table(spark, folder, "customer").select(derived.numbered("c", "c_custkey").alias("document_name"))
    return review.latest_status(documents, log, ["ts", "event_id"]).select("document_name", "status")


# --- corrections -------------------------------------------------------------

@query
def latest_corrections(spark, folder):
    return _corrections(spark, folder).select(
        "document_name", "campo", "valor_correto", "comentario",
        F.date_format("criado_em", "yyyy-MM-dd HH:mm:ss").alias("criado_em"), "seq")


@query
def corrections_after_delete(spark, folder):
    """Entries commented 'free' take their key's correction back."""
    op = F.when(F.col("comentario") == "free", "delete").otherwise("upsert")
    log = derived.correction_log(spark, folder).withColumn("op", op)
    return merging.latest_corrections(log).select("document_name", "campo", "valor_correto", "seq")


def _stored_log(spark, folder):
    """The correction log as review writes it: entries appended to the declared table, some without an `op`."""
    path = work_dir(spark, "log")
    log = derived.correction_log(spark, folder).withColumn("criado_em", F.col("criado_em").cast("timestamp"))
    free = F.col("comentario") == "free"
    for kind, op in ((F.col("comentario").isNull(), None), (free, "delete"), (~free, "upsert")):
        tables.append(merging.correction_entry(log.where(kind), op), path)
    return spark.read.schema(CORRECTIONS).parquet(path)


@query
def correction_workflow(spark, folder):
    """Entries to the log, the log to current corrections, listed by document."""
    current = merging.latest_corrections(_stored_log(spark, folder))
    return current.select("document_name", "campo", "valor_extraido", "valor_correto", "comentario", "seq")


@query
def corrections_by_name(spark, folder):
    log = _stored_log(spark, folder)
    name = log.agg(F.min("document_name")).first()[0]
    return merging.corrections_of(merging.latest_corrections(log.where(F.col("document_name") == name)), name)


@query
def compact_roundtrip(spark, folder):
    """The newer entries are committed first; the newest entry of each key is the current one all the same."""
    root, keys, order = work_dir(spark, "compact"), ["document_name", "campo"], ("criado_em", "seq")
    log = derived.correction_log(spark, folder).select(*keys, "valor_correto", "criado_em", "seq")
    schema = "document_name string, campo string, valor_correto string, criado_em timestamp_ntz, seq bigint"
    late = F.year("criado_em") >= 1995
    for number, part in enumerate((late, ~late)):
        tables.commit_batch(merging.latest(log.where(part), keys, list(order)), f"{root}/store", number, ["document_name"])
    tables.compact(spark, f"{root}/store", f"{root}/compacted", schema, keys, 1, order)
    return tables.read_batches(spark, f"{root}/compacted", schema).select(*keys, "valor_correto", "seq", "batch_id")


@query
def correction_overlay(spark, folder):
    field = [f for f in dictionary.FIELDS if f.path in ("ativo_total", "dre.lucro_liquido")]
    return export.overlay(_statements(spark, folder), _corrections(spark, folder), field).drop("ord")


# --- metrics -----------------------------------------------------------------

@query
def metrics_totals(spark, folder):
    return metrics.metrics_totals(_statements(spark, folder), _corrections(spark, folder))


@query
def metrics_by_field(spark, folder):
    return metrics.metrics_by_field(_corrections(spark, folder))


@query
def metrics_by_type(spark, folder):
    return metrics.metrics_by_type(_corrections(spark, folder))


@query
def metrics_by_document(spark, folder):
    return metrics.metrics_by_document(_statements(spark, folder), _corrections(spark, folder))


@query
def metrics_by_document_distinct(spark, folder):
    return metrics.metrics_by_document_distinct(_statements(spark, folder), _corrections(spark, folder))


# --- exports -----------------------------------------------------------------

@query
def export_long(spark, folder):
    return export.overlay(_statements(spark, folder), _corrections(spark, folder))


@query
def export_wide(spark, folder):
    return export.export_wide(_statements(spark, folder), _corrections(spark, folder))


@query
def export_corrections(spark, folder):
    return export.export_corrections(_corrections(spark, folder))


@query
def export_provenance(spark, folder):
    return export.export_provenance(_statements(spark, folder))


@query
def provenance_by_section(spark, folder):
    return export.provenance_by_section(_statements(spark, folder))


@query
def field_dictionary(spark, folder):
    """The dictionary with the number of current corrections of each field."""
    counts = _corrections(spark, folder).groupBy(F.col("campo").alias("path")).agg(F.count("*").alias("n"))
    return (dictionary.fields_df(spark).join(counts, "path", "left")
            .select("ord", "section", "path", "kind", "is_total", "label", F.coalesce("n", F.lit(0)).alias("n_corrections")))


# --- incremental runs --------------------------------------------------------

def _order_files(spark, folder):
    return derived.table(spark, folder, "orders").select(derived.numbered("/in/o", "o_orderkey").alias("path"))


def _event_files(spark, folder):
    return derived.table(spark, folder, "events").select(derived.numbered("/in/o", "event_id").alias("path"))


@query
def incremental_by_path(spark, folder):
    return ingest.pending(_order_files(spark, folder), _event_files(spark, folder))


@query
def incremental_by_name(spark, folder):
    candidates = ingest.with_document_name(derived.table(spark, folder, "customer").select(
        F.concat(F.lit("/in/"), "c_mktsegment", derived.numbered("/c", "c_custkey")).alias("path")))
    return ingest.pending(candidates, derived.texts(spark, folder), "document_name")


@query
def incremental_bootstrap(spark, folder):
    done = tables.files_or_empty(spark, work_dir(spark, "never-written"), "path string")
    return ingest.pending(_order_files(spark, folder), done)


@query
def ingest_counts(spark, folder):
    return ingest.ingest_counts(_order_files(spark, folder), _event_files(spark, folder))


@query
def name_collisions(spark, folder):
    return ingest.name_collisions(derived.table(spark, folder, "events").select(
        F.concat(F.lit("/"), "event_type", derived.numbered("/u", "user_id")).alias("path")))


def _parsed(spark, folder):
    """Documents as parser output: every tenth failed."""
    elements_ = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("content")))
    failed = F.when(F.col("doc_id") % 10 == 0, "unreadable")
    result = F.to_variant_object(F.struct(F.struct(elements_.alias("elements")).alias("document"),
                                          failed.alias("error_status")))
    return derived.table(spark, folder, "documents").select(derived.numbered("d", "doc_id").alias("path"), result.alias("result"))


@query
def parse_status_split(spark, folder):
    return elements.elements_to_text(_parsed(spark, folder)).select("path", "raw_parsed", "error_status", "reason")


@query
def parse_counts(spark, folder):
    return ingest.parse_counts(elements.elements_to_text(_parsed(spark, folder)))


def _customer_texts(spark, folder):
    """Customers with the text of the document of the same number; '' for those in debt without one."""
    customers = derived.table(spark, folder, "customer").select(
        derived.numbered("c", "c_custkey").alias("document_name"), "c_acctbal")
    found = customers.join(derived.texts(spark, folder), "document_name", "left")
    return found.select("document_name", F.coalesce(
        "document_text", F.when(F.col("c_acctbal") < 0, " \n")).alias("raw_parsed"))


@query
def blank_text_split(spark, folder):
    return ingest.tag_blank(_customer_texts(spark, folder)).select("document_name", "reason")


@query
def run_summary(spark, folder):
    results = _statements(spark, folder).withColumn("batch_id", F.substring("periodo", 1, 4).try_cast("bigint"))
    return runs.run_summary(results, 2000)


@query
def run_errors(spark, folder):
    _, rejects = norm.normalize(_extracted(spark, folder))
    blank = ingest.tag_blank(_customer_texts(spark, folder)).where("reason IS NOT NULL")
    return runs.run_errors(rejects.select("document_name", "reason").unionByName(blank.select("document_name", "reason")))


# --- tables ------------------------------------------------------------------

def _store(spark, schema, keys):
    """An empty bucketed store, a bucket for each shuffle partition."""
    root = work_dir(spark, "bucketed")
    name = "store_" + root.rpartition("-")[2]
    return BucketedStore(spark, name, root, schema, keys, int(spark.conf.get("spark.sql.shuffle.partitions")))


@query
def bucketed_corrections(spark, folder):
    """The correction log in a bucketed store, its newer half committed first and once more."""
    keys, order = ["document_name", "campo"], ("criado_em", "seq")
    log = derived.correction_log(spark, folder).select(*keys, "valor_correto", "criado_em", "seq")
    store = _store(spark, "document_name string, campo string, valor_correto string, criado_em timestamp_ntz, seq bigint", keys)
    late = F.year("criado_em") >= 1995
    for number, part in ((0, late), (1, ~late), (0, late)):
        store.commit(log.where(part), number)
    return store.current(order).select(*keys, "valor_correto", "seq")


@query
def bucketed_upsert(spark, folder):
    """`upsert_results` as two batches of a bucketed store."""
    target, source = _prices(spark, folder)
    store = _store(spark, "order_key bigint, price double", ["order_key"])
    for number, rows in enumerate((target, source)):
        store.commit(rows, number)
    return store.current().select("order_key", "price")


@query
def bucketed_missing(spark, folder):
    """Orders that a bucketed store of closed orders does not have, and how many it has."""
    orders = derived.table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"))
    store = _store(spark, "order_key bigint, status string", ["order_key"])
    store.commit(orders.where("status <> 'P'"), 0)
    found = [rows.withColumn("stored", F.lit(stored)) for rows, stored in ((store.missing(orders), False), (store.known(orders), True))]
    return found[0].union(found[1]).groupBy("status", "stored").agg(F.count("*").alias("n_orders"))


def _prices(spark, folder):
    """Closed orders, and the orders priced from their line items."""
    price = F.col("l_extendedprice").cast(derived.MONEY)
    target = derived.table(spark, folder, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("price"))
    source = derived.table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.sum(price).cast("double").alias("price"))
    return target, source


@query
def upsert_results(spark, folder):
    """Closed orders, repriced from their line items; orders not there yet are added."""
    return merging.upsert(*_prices(spark, folder), ["order_key"])


@query
def append_roundtrip(spark, folder):
    orders = derived.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = work_dir(spark, "append")
    tables.append(orders.where("o_orderstatus = 'F'"), path)
    tables.append(orders.where("o_orderstatus <> 'F'"), path)
    return spark.read.parquet(path)


@query
def overwrite_roundtrip(spark, folder):
    orders = derived.table(spark, folder, "orders")
    path = work_dir(spark, "overwrite")
    tables.overwrite(orders.select("o_orderkey"), path)
    tables.overwrite(orders.select("o_orderkey", "o_orderpriority"), path)
    return spark.read.parquet(path)


# --- scores ------------------------------------------------------------------

@query
def score_field(spark, folder):
    """Order totals against the sum of their line items, written with a decimal comma."""
    total = F.sum(F.col("l_extendedprice").cast(derived.MONEY)).cast("string")
    expected = derived.table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.replace(total, F.lit("."), F.lit(",")).alias("expected"))
    orders = derived.table(spark, folder, "orders").join(expected, "o_orderkey", "left")
    score = scoring.score_field(F.col("o_totalprice").cast(derived.MONEY).cast("string"), F.col("expected"),
                                F.col("expected").isNotNull(), tol=0.5)
    return orders.select("o_orderkey", score.alias("s")).select("o_orderkey", "s.name", "s.value", "s.rationale")


@query
def score_structure(spark, folder):
    return _statements(spark, folder).select(
        "document_name", "tipo_entidade", "periodo", scoring.score_structure(F.col("extracted_json")).alias("s")
    ).select("document_name", "tipo_entidade", "periodo", "s.value", "s.rationale")


@query
def score_structure_whole(spark, folder):
    """Orders as objects with all required keys, without one of them, and as lists."""
    keys = dictionary.REQUIRED_KEYS
    kind = F.col("o_orderkey") % 3

    def object_of(names):
        return F.to_json(F.struct(*[F.col("o_totalprice").alias(k) for k in names]))

    text = F.when(kind == 0, object_of(keys)).when(kind == 1, object_of(keys[1:])).otherwise(F.to_json(F.array("o_totalprice")))
    return derived.table(spark, folder, "orders").select("o_orderkey", scoring.score_structure(text).alias("s")).select(
        "o_orderkey", "s.value", "s.rationale")


@query
def score_field_close(spark, folder):
    """Line totals against the part's price times the quantity, within the usual tolerance."""
    lines = derived.table(spark, folder, "lineitem").join(
        derived.table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    price = (F.col("p_retailprice").cast(derived.MONEY) * F.col("l_quantity").cast("decimal(10,0)")).cast("decimal(18,2)").cast("string")
    score = scoring.score_field(F.col("l_extendedprice").cast(derived.MONEY).cast("string"), price)
    return lines.select("l_orderkey", "l_linenumber", score.alias("s")).select("l_orderkey", "l_linenumber", "s.name", "s.value")


@query
def score_balance(spark, folder):
    parsed = jsonops.computed_once(_statements(spark, folder), "record", F.try_parse_json("extracted_json"))
    return (parsed.select("document_name", "tipo_entidade", "periodo", scoring.score_balance(F.col("record")).alias("s"))
            .select("document_name", "tipo_entidade", "periodo", "s.value", "s.rationale"))


@query
def score_field_all(spark, folder):
    return evaluate.score_corrections(_statements(spark, folder), _corrections(spark, folder)).drop("rationale")


def _evaluation_set(spark, folder):
    return evaluate.evaluation_set(derived.texts(spark, folder), _statements(spark, folder), _corrections(spark, folder))


@query
def evaluation_set(spark, folder):
    record = F.try_parse_json("outputs")
    return _evaluation_set(spark, folder).select(
        "inputs.document_name", "inputs.text", jsonops.number_at(record, "ativo_total").alias("ativo_total"),
        "expectations.campo", "expectations.valor_correto")


@query
def evaluation_metrics(spark, folder):
    return evaluate.evaluation_metrics(evaluate.evaluation_scores(_evaluation_set(spark, folder)))


@query
def tuning_set(spark, folder):
    return evaluate.tuning_set(derived.texts(spark, folder), _corrections(spark, folder)).select(
        "inputs.document_name", "inputs.text", "expectations.expected_response")


@query
def tuning_readiness(spark, folder):
    return evaluate.tuning_readiness(derived.texts(spark, folder), _corrections(spark, folder))


# --- texts -------------------------------------------------------------------

@query
def join_elements(spark, folder):
    return derived.table(spark, folder, "documents").select(
        "doc_id", elements.join_parts(elements.text_elements(F.col("text"))).alias("raw_parsed"))


@query
def page_elements(spark, folder):
    pages = derived.table(spark, folder, "pages").select("page_id", elements.page_elements(F.col("html")).alias("parts"))
    return pages.select("page_id", F.size("parts").cast("bigint").alias("n_elements"),
                        elements.join_parts(F.col("parts")).alias("raw_parsed"),
                        F.regexp_replace(F.array_join("parts", ""), r"\s", "").alias("letters"))


@query
def prompt_rows(spark, folder):
    return elements.prompt_rows(derived.table(spark, folder, "documents"), elements.PROMPT, "text").select("doc_id", "prompt")


@query
def batch_score(spark, folder):
    """A stub that fails or is too slow for some texts and else answers with their first letters."""
    def stub(text: str) -> str:
        if len(text) % 7 == 0:
            raise ValueError("no answer")
        if len(text) % 7 == 1:
            raise TimeoutError("slow")
        return text[:5]

    documents = derived.table(spark, folder, "documents").select("doc_id", "text")
    scored = calls.batch_score(documents, stub, "text", tries=3, backoff=0.0)
    return scored.select("doc_id", "response.result", F.col("response.errorMessage").alias("error_message"),
                         F.col("response.attempts").alias("attempts"))


@query
def calls_in_flight(spark, folder):
    """A stub that hangs for some texts, and for others stands behind a gateway that gives no answer."""
    def stub(text: str) -> str:
        import time

        if len(text) % 97 == 0:
            time.sleep(20)
        if len(text) % 97 == 1:
            error = RuntimeError("bad gateway")
            error.status = 502
            raise error
        return text[:5]

    # However the table was cut into files: about equal numbers of texts for each task.
    documents = derived.table(spark, folder, "documents").select("doc_id", "text").repartition(F.xxhash64("doc_id", "text"))
    scored = calls.batch_score(documents, stub, "text", tries=2, deadline=2.0, in_flight=16)
    return scored.select("doc_id", "response.result", F.col("response.errorMessage").alias("error_message"),
                         F.col("response.attempts").alias("attempts"))


@query
def preview_text(spark, folder):
    return derived.table(spark, folder, "documents").select(
        "doc_id", texts.preview(F.col("text"), 150).alias("preview"), F.length("text").cast("bigint").alias("n_chars"))


@query
def last_message(spark, folder):
    """Every third conversation is given without its messages, as one text or under another name."""
    turns = derived.table(spark, folder, "conversations").groupBy("conv_id").agg(
        F.max_by(F.struct("role", F.col("text").alias("content")), "turn").alias("last"), F.min_by("text", "turn").alias("first"))
    kind = F.col("conv_id") % 6
    messages = F.when(kind % 3 != 0, F.array("last"))
    return turns.select("conv_id", jsonops.message_text(
        messages, F.when(kind == 0, F.col("first")), F.when(kind == 3, F.concat(F.lit("> "), "first"))).alias("text"))


@query
def line_items(spark, folder):
    return items.line_items(derived.statement_lines(spark, folder), derived.line_labels(spark)).withColumn("value", F.col("value").cast("double"))


@query
def line_items_scaled(spark, folder):
    """The same lines, those of even orders printed in thousands with five decimals."""
    return items.line_items(derived.scaled_lines(spark, folder), derived.line_labels(spark)).withColumn("value", F.col("value").cast("double"))


@query
def statement_text_records(spark, folder):
    """Whole texts with two entity types and two years side by side, to records, to statements read field by field."""
    lines = statement_text.statement_lines(derived.statement_texts(spark, folder))
    built = items.assemble_records(items.line_item_cells(lines.where("periodo IS NOT NULL"), derived.line_labels(spark)))
    tagged = norm.records(built.select(F.concat(F.lit("/in/"), "document_name").alias("path"), "extracted"))
    record = F.col("record")
    return tagged.where("reason IS NULL").select(
        "document_name", jsonops.text_at(record, "tipo_entidade").alias("tipo_entidade"),
        jsonops.text_at(record, "identificacao.periodo").alias("periodo"),
        jsonops.safe_double(record, "ativo_circulante.disponibilidades").alias("disponibilidades"),
        jsonops.safe_double(record, "ativo_circulante.estoques").alias("estoques"))


@query
def statement_sheets(spark, folder):
    """Statements with headers of all shapes and labels that repeat from section to section, to fields."""
    lines = statement_text.read_statements(derived.statement_sheets(spark, folder)).where("reason IS NULL")
    return items.line_items(lines).withColumn("value", F.col("value").cast("double"))


@query
def page_statements(spark, folder):
    """The same amounts printed as tables of web pages, from the page to its fields."""
    pages = elements.page_lines(derived.statement_pages(spark, folder))
    texts_ = pages.select("document_name", F.array_join("lines", "\n").alias("raw_parsed"))
    lines = statement_text.read_statements(texts_).where("reason IS NULL")
    return items.line_items(lines).select("document_name", "tipo_entidade", "periodo", "path", F.col("value").cast("double"))


@query
def statement_lines_left_out(spark, folder):
    return statement_text.left_out(derived.statement_sheets(spark, folder))


@query
def similar_labels(spark, folder):
    """What misspelt, plural and shortened labels are found to name."""
    labels = derived.varied_labels(spark, folder).select("label", F.lit(None).cast("string").alias("section")).distinct()
    return label_match.resolve(labels, dictionary.synonyms_df(spark)).select("label", "path", "distance", "reason")


@query
def similar_label_quality(spark, folder):
    """Lines by variant of their label: all, found, found rightly."""
    lines = derived.varied_labels(spark, folder).withColumn("section", F.lit(None).cast("string"))
    found = label_match.resolve(lines, dictionary.synonyms_df(spark)).select("label", F.col("path").alias("found"))
    right = F.sum(F.when(F.col("found") == F.col("path"), F.col("n")).otherwise(0))
    return join_unique(lines, found, "label", "left").groupBy("variant").agg(
        F.sum("n").alias("n_lines"), F.sum(F.when(F.col("found").isNotNull(), F.col("n")).otherwise(0)).alias("n_found"), right.alias("n_right"))


@query
def line_item_provenance(spark, folder):
    return items.line_item_provenance(derived.statement_lines(spark, folder), derived.line_labels(spark))


@query
def assemble_records(spark, folder):
    """Line items and provenance back to JSON, read again field by field."""
    built = items.assemble_records(items.line_item_cells(derived.statement_lines(spark, folder), derived.line_labels(spark)))
    record = F.col("record")
    return built.withColumn("record", F.try_parse_json("extracted")).select(
        "document_name", jsonops.path_get(record, "tipo_entidade").alias("tipo_entidade"),
        jsonops.path_get(record, "identificacao.periodo").alias("periodo"),
        jsonops.number_at(record, "ativo_circulante.disponibilidades").alias("disponibilidades"),
        jsonops.number_at(record, "ativo_circulante.estoques").alias("estoques"),
        jsonops.number_at(record, "ativo_nao_circulante.estoques").alias("estoques_lp"),
        jsonops.number_at(record, "dre.lucro_liquido").alias("lucro_liquido"),
        F.size(F.try_variant_get(record, "$.fontes", "map<string,string>")).cast("bigint").alias("n_fontes"))


@query
def format_money(spark, folder):
    balance = (F.col("o_totalprice").cast(derived.MONEY) - 250000).cast("double")
    return derived.table(spark, folder, "orders").select(
        "o_orderkey", texts.format_money(balance).alias("money"), texts.fixed_two(balance).alias("plain"))


@query
def hash_buckets(spark, folder):
    paths = derived.table(spark, folder, "documents").select(derived.numbered("/in/d", "doc_id").alias("path"))
    return paths.groupBy(ingest.crc_bucket(F.col("path")).alias("bucket")).agg(F.count("*").alias("n"))


# --- files and streams -------------------------------------------------------

def _text_files(spark, folder):
    """The documents as text files, a folder for each language."""
    path = work_dir(spark, "texts")
    derived.table(spark, folder, "documents").select("lang", "text").write.partitionBy("lang").text(path)
    return path


def _as_text(content):
    """Bytes as text, in place: `decode` holds three more copies of a file."""
    return F.validate_utf8(F.col(content).cast("string"))


def _lines_of(contents):
    """A parser that takes the lines of a file as its elements; files may be too large for a VARIANT."""
    lines = F.transform(F.split(_as_text("content"), "\n"), lambda line: F.struct(line.alias("content")))
    return contents.select("path", F.struct(F.struct(lines.alias("elements")).alias("document"), F.lit(None).cast("string").alias("error_status")).alias("result"))


def _by_folder(found):
    content = F.decode("content", "UTF-8")
    return found.groupBy(F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang")).agg(
        F.sum("length").alias("n_bytes"), F.sum(F.octet_length("content")).alias("n_read"),
        F.sum(F.regexp_count(content, F.lit("\n"))).alias("n_lines"))


@query
def spread_by_size(spark, folder):
    """Texts as files of their length, three of them the size of all others together: what the largest of 16 tasks gets."""
    rows = derived.table(spark, folder, "documents").select(derived.numbered("/in/d", "doc_id").alias("path"), F.octet_length("text").cast("bigint").alias("own"))
    total = rows.agg(F.sum("own")).first()[0]
    rows = rows.select("path", F.when(F.col("path").isin("/in/d1.pdf", "/in/d2.pdf", "/in/d3.pdf"), total).otherwise(F.col("own")).alias("length"))
    tasks = ingest.spread_by_size(rows, 16, "length").groupBy(F.spark_partition_id().alias("task")).agg(
        F.sum("length").alias("n_bytes"), F.max("length").alias("largest"), F.count("*").alias("n_files"))
    return tasks.agg(F.sum("n_files").alias("n_files"), F.sum("n_bytes").alias("n_bytes"),
                     F.count_if((F.col("largest") == total) & (F.col("n_files") == 1)).alias("n_alone"),
                     F.count_if((F.col("n_files") > 1) & (F.col("n_bytes") >= 2 * (F.lit(4 * total) / 16 + 1))).alias("n_overfull"))


@query
def scan_files(spark, folder):
    return _by_folder(files.scan_files(spark, _text_files(spark, folder), "*.txt"))


@query
def read_contents(spark, folder):
    """The same files listed first, and opened where the rows are."""
    listed = files.list_files(spark, _text_files(spark, folder), "*.txt")
    return _by_folder(files.with_length(files.read_contents(listed)))


@query
def known_by_content(spark, folder):
    """Texts of each language and source as a file, parsed and asked about; then copies of all files, and changed ones of English.

    The stub gives another answer with every call.
    """
    def stub(prompt: str) -> str:
        import uuid

        return uuid.uuid4().hex

    inbox, folders = work_dir(spark, "inbox"), stages.Folders(work_dir(spark, "stages"))
    documents = derived.table(spark, folder, "documents").select("doc_id", "lang", "source", "text")

    def write(rows, name):
        ordered = rows.repartition("lang", "source").sortWithinPartitions("lang", "source", "doc_id").drop("doc_id")
        ordered.write.partitionBy("lang", "source").text(f"{inbox}/{name}")

    write(documents, "first")
    for more in ([], [("copied", documents), ("changed", documents.where("lang = 'en'").withColumn("text", F.concat("text", F.lit(" again"))))]):
        for name, rows in more:
            write(rows, name)
        stages.parse_stage(spark, inbox, folders, _lines_of, 8, "*.txt")
        stages.extract_stage(spark, folders, stub, 8, tries=1, backoff=0.0)
    stored = spark.read.schema(EXTRACTED).parquet(folders.extracted)
    return stored.groupBy(F.regexp_extract("path", "/(first|copied|changed)/", 1).alias("files")).agg(
        F.count("*").alias("n_files"), F.count_distinct("extracted").alias("n_answers"))


@query
def three_stages(spark, folder):
    """Files to texts, texts to answers, answers to statements and rejects; then once more with changed files beside.

    A file holds the texts of a language and source below a line with both. The stub counts its lines and characters;
    where the lines can be counted by fives it does not answer in JSON, and is asked again with the second run.
    """
    begin = len(elements.PROMPT)

    def stub(prompt: str) -> str:
        import json

        lines = [line for line in prompt[begin:].split("\n") if line]
        answer = {"tipo_entidade": "INDIVIDUAL", "identificacao": {"periodo": "2023-12-31"}, "razao_social": lines[0],
                  "ativo_total": len(lines), "dre": {"lucro_liquido": sum(map(len, lines))}}
        return json.dumps(answer) if len(lines) % 5 else "five by five"

    inbox, folders = work_dir(spark, "inbox"), stages.Folders(work_dir(spark, "stages"))
    documents = derived.table(spark, folder, "documents").select(
        F.col("doc_id").alias("order"), F.concat_ws("/", F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))).alias("name"), "lang", "text")
    # One file for each task, or files of one task in several folders would have one name. The names are written: measured
    # as small, they are sent to the texts, which need not be shuffled to them.
    numbered = documents.select("name", "lang").distinct().withColumn("id", (F.row_number().over(Window.orderBy("name")) - 1).cast("int"))
    tables.overwrite(numbered, f"{inbox}-names")
    names = spark.read.schema(numbered.schema).parquet(f"{inbox}-names")
    n_files = names.count()
    heads = names.select("id", "name", "lang", F.lit(None).cast("bigint").alias("order"), F.lit(0).alias("part"), F.col("name").alias("text"))
    tails = heads.withColumns({"part": F.lit(2), "text": F.lit("again")})
    lines = documents.join(names.select("name", "id"), "name").select("id", "name", "lang", "order", F.lit(1).alias("part"), "text").union(heads)

    def write(rows, name):
        placed = rows.repartitionById(n_files, F.col("id")).sortWithinPartitions("id", "part", "order")
        placed.select("id", "text").write.partitionBy("id").text(f"{inbox}/{name}")

    for batch_id, (name, rows) in enumerate((("first", lines), ("changed", lines.union(tails).where("lang = 'en'")))):
        write(rows, name)
        stages.parse_stage(spark, inbox, folders, _lines_of, 8, "*.txt")
        stages.extract_stage(spark, folders, stub, 8, tries=1, backoff=0.0)
        stages.process_stage(spark, folders, batch_id)
    statements = tables.current_rows(tables.read_batches(spark, folders.statements, STATEMENTS), STATEMENT_KEY)
    rejects = tables.read_batches(spark, folders.rejects, REJECTS)
    of_statements = statements.groupBy(F.col("razao_social").alias("name"), "batch_id", F.col("ativo_total").alias("n_lines"),
                                       F.col("lucro_liquido").alias("n_chars")).agg(F.count("*").alias("n"))
    of_rejects = rejects.groupBy(F.col("reason").alias("name"), "batch_id").agg(F.count("*").alias("n"))
    return of_statements.unionByName(of_rejects, allowMissingColumns=True)


@query
def stream_ingest(spark, folder):
    path, source = work_dir(spark, "ingest"), _text_files(spark, folder)
    jobs.stream_ingest(spark, source, f"{path}/files", f"{path}/checkpoint", "*.txt",
                       ("path", "length", "content")).awaitTermination()
    return _by_folder(spark.read.parquet(f"{path}/files"))


def _order_stream(spark, folder):
    schema = derived.table(spark, folder, "orders").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(folder)


@query
def stream_counts(spark, folder):
    path = work_dir(spark, "counts")
    log = derived.correction_log_of(_order_stream(spark, folder))
    jobs.stream_counts(log, f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    counts = tables.read_batches(spark, f"{path}/counts", "campo string, total bigint")
    return tables.current_rows(counts, ["campo"]).select("campo", "total")


@query
def stream_current_counts(spark, folder):
    """The log arrives in three parts, the newest entries first; entries commented 'free' take a correction back."""
    path = work_dir(spark, "current")
    log = derived.correction_log(spark, folder).withColumn("op", F.when(F.col("comentario") == "free", "delete").otherwise("upsert"))
    year = F.year("criado_em")
    for part in (year >= 1996, year.between(1994, 1995), year < 1994):
        tables.append(log.where(part).select("document_name", "campo", "criado_em", "seq", "op"), f"{path}/log")
        source = spark.readStream.schema("document_name string, campo string, criado_em timestamp_ntz, seq bigint, op string").parquet(f"{path}/log")
        jobs.stream_current_counts(source, f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    return jobs.current_counts(spark, f"{path}/counts")


@query
def stream_upsert(spark, folder):
    path = work_dir(spark, "upsert")
    keys = ["document_name", "campo"]
    log = derived.correction_log_of(_order_stream(spark, folder)).select(*keys, "valor_correto", "criado_em", "seq")
    jobs.stream_upsert(log, f"{path}/store", f"{path}/checkpoint", keys, ("criado_em", "seq")).awaitTermination()
    stored = tables.read_batches(spark, f"{path}/store", "document_name string, campo string, valor_correto string, "
                                 "criado_em timestamp_ntz, seq bigint")
    return tables.current_rows(stored, keys, ("criado_em", "seq")).select(*keys, "valor_correto")


@query
def stream_normalize(spark, folder):
    path = work_dir(spark, "normalize")
    tables.overwrite(_extracted(spark, folder), f"{path}/extracted")
    source = spark.readStream.schema("path string, extracted string").parquet(f"{path}/extracted")
    jobs.stream_normalize(source, f"{path}/store", f"{path}/rejects", f"{path}/checkpoint").awaitTermination()
    stored = tables.read_batches(
        spark, f"{path}/store",
        "document_name string, tipo_entidade string, periodo string, razao_social string, ativo_total double")
    return tables.current_rows(stored, norm.STATEMENT_KEY).drop("batch_id")
