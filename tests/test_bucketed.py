"""The bucketed store: results over batches, and plans that leave the stored side where it lies."""

import pytest
from pyspark.sql import functions as F

from razonete.sources.bucketed import BucketedStore

SCHEMA = "k string, part string, v bigint"
KEYS = ["k", "part"]


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def contents(df):
    return {(r.k, r.part): r.v for r in df.collect()}


@pytest.fixture
def store(spark, tmp_path, request):
    name = "bucketed_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    yield BucketedStore(spark, name, str(tmp_path / "store"), SCHEMA, KEYS, 4)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_newest_batch_counts_and_batches_replace_themselves(spark, store):
    assert store.rows().count() == 0 and store.current().count() == 0
    store.commit(keyed(spark, ("a", "x", 1), ("a", "y", 1), ("b", "x", 1)), 0)
    store.commit(keyed(spark, ("a", "x", 2)), 1)
    assert contents(store.current()) == {("a", "x"): 2, ("a", "y"): 1, ("b", "x"): 1}
    store.commit(keyed(spark, ("a", "x", 7)), 0)
    assert contents(store.current()) == {("a", "x"): 2}
    assert contents(store.current(("v",))) == {("a", "x"): 7}


def test_attempts_that_were_not_listed_do_not_count(spark, store):
    store.commit(keyed(spark, ("a", "x", 1)), 0)
    half = keyed(spark, ("a", "x", 9), ("c", "x", 9)).selectExpr("*", "1L", "'half'")
    half.repartition(4, *KEYS).write.insertInto(store.name)
    assert contents(store.current()) == {("a", "x"): 1}


def test_nulls_in_keys_are_kept_and_match_nothing(spark, store):
    store.commit(keyed(spark, (None, "x", 1), (None, "x", 2), ("a", None, 3)), 0)
    assert store.current(("v",)).count() == 2
    candidates = keyed(spark, (None, "x", 0), ("a", None, 0))
    assert store.missing(candidates).count() == 2 and store.known(candidates).count() == 0


def test_repeated_candidates_and_clashing_columns(spark, store):
    store.commit(keyed(spark, ("a", "x", 1)), 0)
    candidates = keyed(spark, ("a", "x", 5), ("a", "x", 5), ("b", "x", 6)).withColumn("batch_id", F.lit("own"))
    assert [tuple(r) for r in store.missing(candidates).collect()] == [("b", "x", 6, "own")]
    assert store.known(candidates).count() == 2


def test_the_table_can_be_declared_anew_over_its_folder(spark, store):
    store.commit(keyed(spark, ("a", "x", 1)), 0)
    spark.sql(f"DROP TABLE {store.name}")
    again = BucketedStore(spark, store.name, store.root, SCHEMA, KEYS, 4)
    assert contents(again.current()) == {("a", "x"): 1}


def test_compaction_keeps_what_is_current(spark, store, tmp_path):
    for number, v in enumerate((1, 5, 3)):
        store.commit(keyed(spark, ("a", "x", v), ("a", str(number), v)), number)
    into = BucketedStore(spark, store.name + "_2", str(tmp_path / "compacted"), SCHEMA, KEYS, 4)
    store.compact(into, 2, ("v",))
    assert contents(into.current()) == contents(store.current(("v",)))
    assert into.rows().count() == 4
    spark.sql(f"DROP TABLE {into.name}")


def test_the_stored_side_is_never_shuffled(spark, store):
    for number in range(3):
        store.commit(spark.range(200).selectExpr("concat('d', id % 7) k", "concat('p', id) part", "id v"), number)
    assert "Exchange" not in plan_of(store.current())
    assert "Exchange" not in plan_of(store.current(("v",)))
    candidates = spark.range(300).selectExpr("concat('d', id % 7) k", "concat('p', id) part")
    for found in (store.missing(candidates), store.known(candidates)):
        plan = plan_of(found)
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
        stored = plan[plan.index("FileScan") - 400:] if plan.index("Range") < plan.index("FileScan") else plan[:plan.index("Range")]
        assert "Exchange" not in stored.rpartition("Range")[2]
    assert store.missing(candidates).count() == 100
    joined = store.current().join(store.rows().groupBy(*KEYS).agg(F.count("*").alias("n")).hint("merge"), KEYS)
    assert "Exchange" not in plan_of(joined) and {r.n for r in joined.collect()} == {3}


def test_a_document_with_most_rows_is_spread(spark, store):
    store.commit(spark.range(4000).selectExpr("'hot' k", "concat('p', id) part", "id v"), 0)
    sizes = [r["n"] for r in store.rows().groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 1500
    tasks = store.current().groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()
    assert len(tasks) == 4 and max(r["n"] for r in tasks) < 1500
