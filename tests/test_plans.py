"""What the plans must and must not hold, and results under hot keys."""

import re

import pytest
from pyspark.sql import functions as F

from razonete import schemas
from razonete.operators import export, ingest, metrics, normalize as norm, review, runs, upsert as merging
from razonete.plans.catalogue import QUERIES
from razonete.sources import derived, tables
from razonete.sources.files import list_files

STREAMS = {"stream_ingest", "stream_counts", "stream_current_counts", "stream_upsert", "stream_normalize"}


def plan_of(df):
    """The formatted plan, without the hints of AQE's later changes."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


# Ordered passes over the lines of a document or the grams of a label, and over groups of files.
ORDERED = {"statement_text_records", "statement_sheets", "page_statements", "statement_lines_left_out", "similar_labels",
           "similar_label_quality", "spread_by_size"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "BatchEvalPython", "MapInPandas", "FlatMapGroups"):
        assert node == "Window" and name in ORDERED or not re.search(rf"\b{node}", plan), node
    assert ("ArrowEvalPython" in plan) == (name in ("batch_score", "calls_in_flight"))


def test_each_answer_is_parsed_once_per_stage(spark, folder):
    plan = plan_of(norm.rejects_of(norm.records(derived.extracted_content(spark, folder))))
    assert plan.count("parseJson(") == 2  # the answer, and the text inside an envelope
    assert "Exchange" not in plan.split("ObjectHashAggregate")[0]  # nothing is shuffled after reading the answers


@pytest.mark.parametrize("name, parses", [("document_detail", 3), ("score_balance", 3), ("score_field_all", 3), ("evaluation_metrics", 3)])
def test_records_are_parsed_once(spark, folder, name, parses):
    # The answer, the text inside an envelope, and the record.
    assert plan_of(QUERIES[name](spark, folder)).count("parseJson(") == parses


def test_run_summary_needs_four_columns(spark, tmp_path):
    root = str(tmp_path / "store")
    tables.commit_batch(spark.createDataFrame([], schemas.STATEMENTS), root, 0)
    results = tables.read_batches(spark, root, schemas.STATEMENTS).select(*schemas.STATEMENT_KEY, "batch_id")
    summary = runs.run_summary(tables.current_rows(results, schemas.STATEMENT_KEY), 0)
    assert "ReadSchema: struct<document_name:string,tipo_entidade:string,periodo:string>" in plan_of(summary)


def test_lists_are_top_k(spark, folder):
    for name in ("metrics_by_field", "metrics_by_document", "metrics_by_document_distinct"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, folder))


def test_dictionary_is_broadcast_and_tables_need_not_be(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        provenance = plan_of(QUERIES["export_provenance"](spark, folder))
        assert provenance.count("BroadcastHashJoin Left") == 1
        wide = plan_of(QUERIES["export_wide"](spark, folder))
        assert "BroadcastHashJoin" not in wide and "SortMergeJoin" in wide
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_what_is_used(spark, folder):
    combos = plan_of(QUERIES["statement_combos"](spark, folder))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in combos
    log = derived.correction_log(spark, folder).where("seq = 7")
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,7)]" in plan_of(log)
    listing = list_files(spark, folder, "*.parquet")
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()


def test_log_is_combined_before_it_is_shuffled(spark, folder):
    plan = plan_of(QUERIES["latest_corrections"](spark, folder))
    assert plan.index("partial_max_by") < plan.index("hashpartitioning") and plan.count("Exchange (") == 1


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 statements, a third of them of one document, and corrections to match."""
    n = F.col("id")
    document = F.when(n % 3 == 0, "hot.pdf").otherwise(F.concat(F.lit("d"), (n % 997).cast("string")))
    statements = spark.range(30_000, numPartitions=6).select(
        document.alias("document_name"), F.lit("A").alias("tipo_entidade"), F.lpad(n.cast("string"), 6, "0").alias("periodo"),
        F.concat(F.lit("n"), (n % 5).cast("string")).alias("razao_social"),
        F.concat(F.lit('{"ativo_total":'), n.cast("string"), F.lit("}")).alias("extracted_json"))
    log = spark.range(30_000, numPartitions=6).select(
        document.alias("document_name"), F.concat(F.lit("f"), (n % 7).cast("string")).alias("campo"),
        n.cast("string").alias("valor_extraido"), n.cast("string").alias("valor_correto"), F.lit("").alias("comentario"),
        F.lit(None).cast("timestamp").alias("criado_em"), n.alias("seq"))
    return statements, log


def test_hot_key_in_the_log(hot):
    _, log = hot
    expected = {}
    for row in log.collect():
        key = (row.document_name, row.campo)
        expected[key] = max(expected.get(key, -1), row.seq)
    found = {(r.document_name, r.campo): r.seq for r in merging.latest_corrections(log).collect()}
    assert found == expected


def test_hot_document_counts(hot):
    statements, log = hot
    corrections = merging.latest_corrections(log)
    joined = (corrections.join(statements, "document_name", "left").groupBy("document_name", "razao_social").count()
              .orderBy(F.col("count").desc(), "document_name", "razao_social").limit(10).collect())
    found = metrics.metrics_by_document(statements, corrections).collect()
    assert [(r.document_name, r.razao_social, r.corrections) for r in found] == [
        (r.document_name, r.razao_social, r["count"]) for r in joined]
    assert review.default_record(statements).count() == statements.select("document_name").distinct().count()


@pytest.fixture
def small_partitions(spark):
    """Shuffle joins only, and partitions split from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_document_is_split_in_the_overlay_join(hot, small_partitions):
    statements, log = hot
    rows, plan = run(export.export_wide(statements, merging.latest_corrections(log), ordered=False).select(
        "document_name", "periodo", "ativo_total", "corrections"))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == 30_000
    assert all(r.ativo_total == float(int(r.periodo)) and r.corrections == 7 for r in rows)


def test_hot_name_is_split_when_selecting_what_is_new(hot, small_partitions):
    statements, log = hot
    rows, plan = run(ingest.pending(statements, log.where("document_name <> 'hot.pdf'"), "document_name"))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == 10_000 and {r.document_name for r in rows} == {"hot.pdf"}


def test_amounts_are_read_once(spark, folder):
    """No filter on the amount reads the line or its scale again."""
    plan = plan_of(QUERIES["line_items_scaled"](spark, folder))
    assert "escala_valores" in plan and not re.search(r"Condition : .*(regexp|translate)", plan)


def test_varied_labels_are_written_for_counts(spark, folder):
    """Line items are counted before labels are written, so few labels are."""
    plan = derived.varied_labels(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and "reverse(" in plan
    assert "reverse(" not in plan[plan.rindex("Aggregate ["):]
