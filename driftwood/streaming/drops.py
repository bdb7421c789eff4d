"""Incremental formatted-zone load: new drop files as a file stream.

Structured Streaming tracks which drop files were already loaded (in its
checkpoint, under the shared checkpoint folder); each micro-batch runs the
batch operators — key from the file name, keyed dedupe, encoding repair —
and upserts into the stored table.  ``availableNow`` processes everything
that arrived since the last run and stops, so the same job can run on a
schedule.  A lost executor re-runs only its tasks; a failed batch is
re-applied as a whole, which the idempotent upsert makes safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.operators.dedupe import dedupe
from driftwood.plans.jobs import repair_strings
from driftwood.session import scratch_path
from driftwood.sources.files import KEY_DIGITS, key_from_path
from driftwood.sources.sinks import upsert_table


def drop_stream(spark: SparkSession, root: str, schema, key_len: int, key_col: str,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the drop files of ``root`` (one schema)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(f"{root.rstrip('/')}/{'[0-9]' * KEY_DIGITS}*")
    return df.withColumn(key_col, key_from_path(F.col("_metadata.file_path"), key_len))


def load_new_drops(spark: SparkSession, root: str, schema, key_len: int, key_col: str,
                   target: str, keys, checkpoint: str | None = None, fmt: str = "parquet",
                   repair_text: bool = True, partition_by: str | None = None,
                   max_files_per_trigger: int | None = None):
    """Process all drops that arrived since the last run, then stop.

    With ``partition_by`` (a key column, e.g. the period key) the stored
    table is partitioned and each micro-batch rewrites only the partitions
    it touches; ``max_files_per_trigger`` bounds the size of a micro-batch.
    """
    checkpoint = checkpoint or scratch_path(spark, "drops-stream")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # e.g. a batch of only empty part files
            return
        merged = dedupe(batch, keys)
        if repair_text:
            merged = repair_strings(merged)
        upsert_table(batch.sparkSession, target, merged, keys, fmt, partition_by)

    query = (drop_stream(spark, root, schema, key_len, key_col, fmt, max_files_per_trigger)
             .writeStream.foreachBatch(apply)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return checkpoint
