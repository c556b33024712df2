"""A keyed store in Spark's own bucketed tables.

Rows are kept in as many buckets as were declared, by the hash of their whole key
and sorted by it within a file. So the newest row per key, and joins and anti
joins on the key, read each bucket where it lies: the stored side is never
shuffled, whatever has piled up in it. A document with very many rows is spread
by the rest of its key. Only what is joined to the store moves, to its buckets.

Batches are appended, and listed in a table of commits beside; readers see listed
attempts only, whole or not at all, and a batch written again replaces itself
(as in `tables`). One writer at a time. The table is declared over its folder, so
a session with a catalogue of its own declares it again and reads what is there.

Nulls in a key have a bucket as any other value, and are keys of their own when
the newest rows are taken, but equal no key in joins. A table that was declared
and never written is empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from razonete.operators.upsert import latest
from razonete.sources.tables import COMMITS, files_or_empty

BATCH = "_batch_id"
ATTEMPT = "_attempt"


class BucketedStore:
    """A table `name` with its rows below `root`, by whole keys in `buckets` parts.

    There should be as many buckets as shuffle partitions at least: Spark moves the stored side too where it finds
    too few tasks in it.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, schema: str, keys: list[str], buckets: int):
        self.spark, self.name, self.root, self.keys, self.buckets = spark, name, root, keys, buckets
        key = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, {BATCH} bigint, {ATTEMPT} string) USING parquet "
                  f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{root}/data'")
        self.columns = [c for c in spark.table(name).columns if c not in (BATCH, ATTEMPT)]

    def commit(self, rows: DataFrame, batch_id: int) -> None:
        """Append a batch and then list it. Its rows are sent to their buckets first, so each gets one file."""
        attempt = uuid.uuid4().hex
        ready = rows.select(*self.columns, F.lit(batch_id).cast("bigint").alias(BATCH), F.lit(attempt).alias(ATTEMPT))
        ready.repartition(self.buckets, *self.keys).write.insertInto(self.name)
        line = self.spark.createDataFrame([(batch_id, attempt)], "batch_id bigint, attempt string")
        line.coalesce(1).withColumn("committed_at", F.current_timestamp()).write.mode("append").parquet(f"{self.root}/commits")

    def rows(self) -> DataFrame:
        """The rows of all committed batches, with their batch_id."""
        commits = latest(files_or_empty(self.spark, f"{self.root}/commits", COMMITS), ["batch_id"], ["committed_at", "attempt"])
        listed = [c["attempt"] for c in commits.collect()]  # one per batch
        return self.spark.table(self.name).where(F.col(ATTEMPT).isin(listed)).select(*self.columns, F.col(BATCH).alias("batch_id"))

    def current(self, order: tuple[str, ...] = ()) -> DataFrame:
        """The newest row per key: by the rows' own order where they have one, then by batch."""
        return latest(self.rows(), self.keys, [*order, "batch_id"])

    def missing(self, candidates: DataFrame) -> DataFrame:
        """Candidates whose key is not in the store; those with a null in it are never there."""
        return candidates.join(self._stored_keys(), self.keys, "left_anti")

    def known(self, candidates: DataFrame) -> DataFrame:
        """Candidates whose key is in the store."""
        return candidates.join(self._stored_keys(), self.keys, "left_semi")

    def _stored_keys(self) -> DataFrame:
        # Merged bucket by bucket: a broadcast of the keys would grow with the store.
        return self.rows().select(*self.keys).hint("merge")

    def compact(self, into: BucketedStore, batch_id: int, order: tuple[str, ...] = ()) -> None:
        """Write the current rows up to `batch_id` as one batch of another store."""
        batches = self.rows().where(F.col("batch_id") <= batch_id)
        into.commit(latest(batches, self.keys, [*order, "batch_id"]).drop("batch_id"), batch_id)
