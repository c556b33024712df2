"""Reading and writing tables, and the append-only batch folder behind upserts."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from razonete.operators.upsert import latest


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A catalog table, or no rows of the declared schema before its first write."""
    return spark.table(name) if spark.catalog.tableExists(name) else empty(spark, schema)


def files_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet files below a path, or no rows of the declared schema before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


# How tables of whole texts are written. A text may have many megabytes, and readers take all rows of a row group at
# once, so that sizes are looked at after each row, and not after a hundred; a dictionary, and the least and the greatest
# text in the statistics, would hold texts a second time.
WHOLE_TEXTS = {"compression": "zstd", "parquet.enable.dictionary": "false",
               "parquet.column.statistics.enabled#raw_parsed": "false", "parquet.block.size": 16 << 20,
               "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


def append(df: DataFrame, path: str, **options: object) -> None:
    df.write.mode("append").options(**options).parquet(path)


def overwrite(df: DataFrame, path: str, **options: object) -> None:
    """Replace the files at a path, schema included."""
    df.write.mode("overwrite").options(**options).parquet(path)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the way a result set is handed to a client."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# A batch folder holds batches under their numbers, each attempt to write one in
# a folder of its own, and a list of what was committed. A batch counts from its
# line in that list on, whole or not at all; writing a number again replaces it,
# so a retried job or stream epoch leaves no duplicates. Nothing already written
# is rewritten when a batch arrives: the cost of an upsert is the batch, not the
# table. Readers take the newest row per key. One writer at a time.

COMMITS = "batch_id bigint, attempt string, committed_at timestamp"


def commit_batch(df: DataFrame, root: str, batch_id: int, sort_by: list[str] | None = None) -> None:
    """Write a batch and then list it.

    Sorted by a key, its files can be told apart by their least and greatest key; where batches overlap, by the Bloom
    filter of the key that each file gets, so that a look-up reads the files that have the key.
    """
    spark, attempt = df.sparkSession, uuid.uuid4().hex
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    writer = df.write
    if sort_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{sort_by[0]}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(f"{root}/data/batch_id={batch_id}/attempt={attempt}")
    line = spark.createDataFrame([(batch_id, attempt)], "batch_id bigint, attempt string")
    line.coalesce(1).withColumn("committed_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/commits")


def read_batches(spark: SparkSession, root: str, schema: str, batch_id: int | None = None) -> DataFrame:
    """The rows of all committed batches, or of one, with their batch_id."""
    commits = latest(files_or_empty(spark, f"{root}/commits", COMMITS), ["batch_id"], ["committed_at", "attempt"])
    if batch_id is not None:
        commits = commits.where(F.col("batch_id") == batch_id)
    folders = [f"{root}/data/batch_id={c['batch_id']}/attempt={c['attempt']}" for c in commits.collect()]  # one per batch
    if not folders:
        return empty(spark, f"{schema}, batch_id bigint")
    reader = spark.read.schema(f"{schema}, batch_id bigint").option("basePath", f"{root}/data")
    return reader.parquet(*folders).drop("attempt")


def current_rows(batches: DataFrame, keys: list[str], order: tuple[str, ...] = ()) -> DataFrame:
    """Newest row per key: by the rows' own order where they have one, then by batch."""
    return latest(batches, keys, [*order, "batch_id"])


def compact(spark: SparkSession, root: str, new_root: str, schema: str, keys: list[str], batch_id: int,
            order: tuple[str, ...] = ()) -> None:
    """Write the current rows up to `batch_id` as one batch of a new folder, `order` as readers give it."""
    batches = read_batches(spark, root, schema).where(F.col("batch_id") <= batch_id)
    commit_batch(current_rows(batches, keys, order).drop("batch_id"), new_root, batch_id, keys[:1])
