"""The incremental jobs as Structured Streaming queries.

Each takes the checkpoint folder of the query; restarting with the same one
continues where the last run stopped. `availableNow` drains what is there and
ends, the way a scheduled job does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from razonete.operators.normalize import dedupe_batch, records, rejects_of, statements_of
from razonete.operators.upsert import latest
from razonete.schemas import CORRECTION_KEY, STATEMENT_KEY
from razonete.sources.files import PDF, file_stream
from razonete.sources.tables import commit_batch, read_batches


def stream_ingest(spark: SparkSession, root: str, table_path: str, checkpoint: str, glob: str = PDF,
                  columns: tuple[str, ...] = ("path", "content"), max_files: int | None = None) -> StreamingQuery:
    """Append every new file below a folder to a parquet table, exactly once."""
    files = file_stream(spark, root, glob, max_files).select(*columns)
    return (files.writeStream.format("parquet").option("path", table_path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_upsert(source: DataFrame, store: str, checkpoint: str, keys: list[str] = STATEMENT_KEY,
                  order: tuple[str, ...] = ()) -> StreamingQuery:
    """Commit the last row per key of every micro-batch to a batch folder.

    The order columns are stored too, so that `tables.current_rows` finds the
    newest row even if batches arrive out of order; without them a source holds
    a key once per batch and the later batch wins. A batch that is run again
    after a failure replaces its own folder.
    """
    def commit(batch: DataFrame, batch_id: int) -> None:
        commit_batch(latest(batch, keys, list(order)) if order else batch, store, batch_id, keys[:1])

    return (source.writeStream.foreachBatch(commit)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_normalize(extracted: DataFrame, store: str, reject_store: str, checkpoint: str) -> StreamingQuery:
    """Normalise arriving answers; statements and rejects go to their batch folders.

    The tagged records of a batch are written once and both outputs read from
    there, so no answer is parsed twice.
    """
    def commit(batch: DataFrame, batch_id: int) -> None:
        records(batch).drop("record").write.mode("overwrite").parquet(f"{reject_store}_tagged")
        tagged = batch.sparkSession.read.parquet(f"{reject_store}_tagged")
        tagged = tagged.withColumn("record", F.try_parse_json("extracted_json"))
        commit_batch(dedupe_batch(statements_of(tagged)), store, batch_id, ["document_name"])
        commit_batch(rejects_of(tagged), reject_store, batch_id)

    return (extracted.writeStream.foreachBatch(commit)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_counts(corrections: DataFrame, store: str, checkpoint: str, key: str = "campo") -> StreamingQuery:
    """Running count per key; each epoch commits the counts that changed.

    The newest count per key is the current one (`tables.current_rows`).
    """
    counts = corrections.groupBy(key).agg(F.count("*").alias("total"))
    return (counts.writeStream.outputMode("update")
            .foreachBatch(lambda batch, batch_id: commit_batch(batch, store, batch_id))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_current_counts(log: DataFrame, store: str, checkpoint: str, by: str = "campo") -> StreamingQuery:
    """Running count of current corrections, as `metrics.metrics_by_field` counts them in a table.

    The state holds, for each document and field, the newest entry's place in the order of `latest_corrections` and
    whether it stands. An entry that is newer than that gives +1 or -1 where it writes or takes back a correction, and
    nothing where it rewrites one; a late entry changes nothing. Each epoch commits the sums of these steps for every
    value of `by`, and a repeated epoch replaces its own (`current_counts` adds them up).

    The state is a batch folder beside the counts, `{store}_state`: an epoch joins its newest entries to the state of
    the epochs before it and commits the keys that it changes. So a run reads the state once for each epoch, as one
    join, and no executor holds it in memory.
    """
    columns = {name.lower() for name in log.columns}
    at = F.coalesce(F.unix_micros(F.col("criado_em").cast("timestamp")), F.lit(-2**63))
    seq = F.coalesce(F.col("seq").cast("long"), F.lit(0)) if "seq" in columns else F.lit(0)
    stands = ~F.col("op").eqNullSafe("delete") if "op" in columns else F.lit(True)
    entry = F.struct(at.alias("at"), seq.cast("long").alias("seq"), stands.alias("stands"), F.col(by).cast("string").alias("value"))
    entries = log.select(*[F.col(k).cast("string").alias(k) for k in CORRECTION_KEY], entry.alias("_entry"))
    state = "document_name string, campo string, at bigint, seq bigint, stands boolean, value string, step int"

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, F.struct("_entry.at", "_entry.seq")
        newest = batch.groupBy(*CORRECTION_KEY).agg(F.max_by("_entry", place).alias("_entry")).alias("new")
        before = read_batches(spark, f"{store}_state", state).where(F.col("batch_id") < batch_id)
        before = before.groupBy(*CORRECTION_KEY).agg(F.max_by(F.struct("at", "seq", "stands"), "batch_id").alias("_old")).alias("old")
        same = [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in CORRECTION_KEY]
        both = newest.join(before, same[0] & same[1], "left")
        changed = both.where(F.col("_old").isNull() | (place >= F.struct("_old.at", "_old.seq")))
        step = F.col("_entry.stands").cast("int") - F.coalesce(F.col("_old.stands").cast("int"), F.lit(0))
        commit_batch(changed.select(*[f"new.{k}" for k in CORRECTION_KEY], "_entry.*", step.alias("step")), f"{store}_state", batch_id)
        steps = read_batches(spark, f"{store}_state", state, batch_id)
        commit_batch(steps.groupBy(F.col("value").alias(by)).agg(F.sum("step").alias("total")).where("total <> 0"), store, batch_id)

    return (entries.writeStream.foreachBatch(commit)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def current_counts(spark: SparkSession, store: str, by: str = "campo") -> DataFrame:
    """The counts that `stream_current_counts` has committed so far, those of 0 left out."""
    steps = read_batches(spark, store, f"{by} string, total bigint")
    return steps.groupBy(by).agg(F.sum("total").alias("total")).where("total <> 0")
