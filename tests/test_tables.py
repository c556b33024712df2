"""Upserts, logs, batch folders and incremental selection."""

import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from razonete import schemas, work_dir
from razonete.operators import ingest, runs, upsert as merging
from razonete.sources import tables

KEYED = "k string, v int"


def keyed(spark, pairs):
    return spark.createDataFrame(sorted(dict(pairs).items()), KEYED)


def contents(df):
    found = [(r.k, r.v) for r in df.select("k", "v").collect()]
    assert len({k for k, _ in found}) == len(found)
    return dict(found)


batches = st.lists(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9), min_size=1, max_size=5), min_size=2, max_size=3)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches)
def test_upserts_behave_like_dict_updates(spark, steps):
    expected, target = dict(steps[0]), keyed(spark, steps[0])
    for step in steps[1:]:
        source = keyed(spark, step)
        once = merging.upsert(target, source, ["k"])
        assert contents(merging.upsert(once, source, ["k"])) == contents(once)
        kept = contents(merging.upsert(target, source, ["k"], force=False))
        assert kept == {**step, **expected}
        expected.update(step)
        target = once
    assert contents(target) == expected


def test_null_keys_match_nothing(spark):
    target = spark.createDataFrame([(None, 1), ("a", 1)], KEYED)
    source = spark.createDataFrame([(None, 2)], KEYED)
    assert sorted(merging.upsert(target, source, ["k"]).collect(), key=str) == [("a", 1), (None, 1), (None, 2)]


def plan_text(df):
    return df._jdf.queryExecution().toString()


def test_batch_folder(spark, tmp_path):
    root = str(tmp_path / "store")
    assert tables.read_batches(spark, root, KEYED).count() == 0
    tables.commit_batch(keyed(spark, {"a": 1, "b": 1}), root, 0)
    tables.commit_batch(keyed(spark, {"b": 9}), root, 1)
    tables.commit_batch(keyed(spark, {"b": 2, "c": 2}), root, 1)  # the retry replaces the first attempt
    current = tables.current_rows(tables.read_batches(spark, root, KEYED), ["k"])
    assert contents(current) == {"a": 1, "b": 2, "c": 2}
    tables.compact(spark, root, f"{root}-2", KEYED, ["k"], 1)
    compacted = tables.read_batches(spark, f"{root}-2", KEYED)
    assert contents(compacted) == {"a": 1, "b": 2, "c": 2}
    tables.commit_batch(keyed(spark, {"a": 3}), f"{root}-2", 2)
    assert contents(tables.current_rows(tables.read_batches(spark, f"{root}-2", KEYED), ["k"]))["a"] == 3


def test_correction_log(spark):
    log = spark.createDataFrame([], schemas.CORRECTIONS)
    given = "document_name string, campo string, valor_correto string, seq int"
    for seq, (campo, value, op) in enumerate([("x", "1", "upsert"), ("x", "2", None), ("y", "1", "upsert"),
                                              ("y", None, "delete"), ("z", None, "delete"), ("z", "3", "upsert")]):
        row = spark.createDataFrame([("d", campo, value, seq)], given)
        log = log.unionByName(merging.correction_entry(row, op))
    assert log.schema.simpleString() == spark.createDataFrame([], schemas.CORRECTIONS).schema.simpleString()
    assert log.where("criado_em IS NULL").count() == 0
    same_time = log.withColumn("criado_em", F.lit(None).cast("timestamp"))
    found = {r.campo: r.valor_correto for r in merging.latest_corrections(same_time).collect()}
    assert found == {"x": "2", "z": "3"}


def test_corrections_on_the_declared_table(spark):
    schemas.ensure_tables(spark, "reviewed")
    for campo, value, op in (("x", "1", "upsert"), ("x", "2", None), ("y", "1", "delete")):
        row = spark.createDataFrame([("d", campo, value)], "document_name string, campo string, valor_correto string")
        merging.correction_entry(row, op).write.insertInto("reviewed.corrections")
    current = merging.latest_corrections(spark.table("reviewed.corrections"))
    assert [(r.campo, r.valor_correto) for r in merging.corrections_of(current, "d").collect()] == [("x", "2")]
    without_seq = spark.table("reviewed.corrections").drop("seq", "op")
    assert merging.latest_corrections(without_seq).count() == 2


def test_compact_keeps_the_newest_by_order(spark, tmp_path):
    root, schema = str(tmp_path / "store"), "k string, v string, seq int"
    for number, row in enumerate([("x", "new", 9), ("x", "old", 1), ("y", "only", 1)]):
        tables.commit_batch(spark.createDataFrame([row], schema), root, number)
    tables.compact(spark, root, f"{root}-2", schema, ["k"], 2, ("seq",))
    for folder in (root, f"{root}-2"):
        current = tables.current_rows(tables.read_batches(spark, folder, schema), ["k"], ("seq",))
        assert {r.k: r.v for r in current.collect()} == {"x": "new", "y": "only"}


def test_readers_see_only_whole_batches(spark, tmp_path):
    root = str(tmp_path / "store")
    tables.commit_batch(keyed(spark, {"a": 1}), root, 0)
    # An attempt that was never listed, as of a job that failed or still writes.
    keyed(spark, {"a": 9}).write.parquet(f"{root}/data/batch_id=0/attempt=half")
    keyed(spark, {"b": 9}).write.parquet(f"{root}/data/batch_id=1/attempt=half")
    assert contents(tables.read_batches(spark, root, KEYED).drop("batch_id")) == {"a": 1}
    assert tables.read_batches(spark, root, KEYED, 1).count() == 0


def test_one_document_is_read_from_sorted_batches(spark, tmp_path):
    root, schema = str(tmp_path / "store"), "document_name string, v bigint"
    rows = spark.range(1000).selectExpr("concat('d', id) AS document_name", "id AS v")
    tables.commit_batch(rows, root, 0, ["document_name"])
    one = tables.read_batches(spark, root, schema).where("document_name = 'd7'")
    assert "PushedFilters: [IsNotNull(document_name), EqualTo(document_name,d7)]" in plan_text(one)
    assert [r.v for r in one.collect()] == [7]


def test_corrections_of_one_document(spark):
    df = spark.sql("""SELECT * FROM VALUES ('d', 'a', '1', '2', 'c', TIMESTAMP '2024-01-02 03:04:05'),
        ('d', 'b', '1', '2', 'c', TIMESTAMP '2024-02-02 03:04:05'), ('e', 'b', '1', '2', 'c', TIMESTAMP '2024-02-02 00:00:00')
        t(document_name, campo, valor_extraido, valor_correto, comentario, criado_em)""")
    found = merging.corrections_of(df, "d").collect()
    assert [(r.campo, r.criado_em) for r in found] == [("b", "2024-02-02 03:04:05"), ("a", "2024-01-02 03:04:05")]


def test_declared_tables_fill_the_time(spark):
    schemas.ensure_tables(spark, "review")
    schemas.ensure_tables(spark, "review")
    spark.sql("INSERT INTO review.corrections (document_name, campo, valor_extraido, valor_correto, comentario) "
              "VALUES ('d', 'c', '1', '2', '')")
    assert spark.table("review.corrections").first().criado_em is not None
    assert tables.table_or_empty(spark, "review.statements", schemas.STATEMENTS).count() == 0
    assert tables.table_or_empty(spark, "review.no_such", KEYED).columns == ["k", "v"]


def test_pending(spark):
    candidates = spark.createDataFrame([("/a/x.pdf",), ("/b/x.pdf",), ("/a/y.pdf",)], "path string")
    done = spark.createDataFrame([("/a/x.pdf",)] * 3, "path string")
    assert {r.path for r in ingest.pending(candidates, done).collect()} == {"/b/x.pdf", "/a/y.pdf"}
    assert ingest.pending(candidates, None).count() == 3
    assert ingest.pending(candidates, candidates).isEmpty()
    named = ingest.with_document_name(candidates)
    assert {r.path for r in ingest.pending(named, ingest.with_document_name(done), "document_name").collect()} == {"/a/y.pdf"}
    counts = ingest.ingest_counts(candidates, done).first()
    assert (counts.total, counts.done, counts.to_process) == (3, 1, 2)
    collision = ingest.name_collisions(candidates).collect()
    assert [(r.document_name, r.n_paths, r.first_path, r.last_path) for r in collision] == [("x.pdf", 2, "/a/x.pdf", "/b/x.pdf")]


def test_spread_uses_all_partitions(spark):
    paths = spark.range(1000).selectExpr("concat('/in/', id, '.pdf') AS path")
    spread = ingest.spread(paths, 16).select(F.spark_partition_id().alias("p")).distinct()
    assert spread.count() == 16


def test_hard_errors_fail_the_run(spark):
    soft = spark.createDataFrame([("d", "no_text"), ("e", "empty_text")], "document_name string, reason string")
    runs.fail_on_hard_errors(runs.run_errors(soft))
    runs.fail_on_hard_errors(runs.run_errors(soft.limit(0)))
    hard = soft.unionByName(spark.createDataFrame([("f", "bad_json")], soft.schema))
    with pytest.raises(runs.HardErrors, match="1 rejects"):
        runs.fail_on_hard_errors(runs.run_errors(hard))


def test_work_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(f"{base}/") and first != second


def test_workers_find_the_package(spark):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert root in spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep)


def test_as_text(spark):
    df = tables.as_text(spark.sql("SELECT 1 AS a, true AS b, CAST(NULL AS INT) AS c"))
    assert df.first().asDict() == {"a": "1", "b": "true", "c": None}


def scanned_rows(df):
    """Rows that the scans of a plan hand on, after it has run."""
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found


def test_a_look_up_reads_the_files_that_have_the_name(spark, tmp_path):
    """Twenty batches that overlap from the least name to the greatest; names too many for a dictionary."""
    schema, rows = "document_name string, n long", 20_000
    for number in range(20):
        names = spark.range(rows).select(F.sha2((F.col("id") * 20 + number).cast("string"), 256).alias("document_name"), F.col("id").alias("n"))
        tables.commit_batch(names.coalesce(1), str(tmp_path), number, ["document_name"])
    wanted = spark.range(1).select(F.sha2(F.lit("2007"), 256)).first()[0]
    stored = tables.read_batches(spark, str(tmp_path), schema)
    found = stored.where(F.col("document_name") == wanted)
    assert [(r.n, r.batch_id) for r in found.collect()] == [(100, 7)]
    assert scanned_rows(found.select("n")) <= 2 * rows < scanned_rows(stored.select("n")) / 5
