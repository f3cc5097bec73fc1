"""I-08: incremental arrival of landed files into a merged (upserted) table.

The source loaders re-pull a rolling window every day and merge it by key;
here landed files are read with Structured Streaming's file source
(``trigger(availableNow=True)`` processes whatever has arrived, then stops)
and each micro-batch is merged into the partitions that it touches
(:mod:`marginalia.sources.tables`; a batch's id is the version it commits).

A replayed batch (after a failure between the commit and the stream's
checkpoint) finds its version committed and changes nothing; one that failed
before the commit left the older version as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marginalia.sources import tables

#: Hash partitions of a table without a partition of its own.
BUCKETS = 64


def read_latest(spark: SparkSession, target: str, schema: StructType | None = None) -> DataFrame | None:
    """The newest version; an empty frame of ``schema``, or None, if there is none."""
    out = tables.read_table(spark, target)
    return spark.createDataFrame([], schema) if out is None and schema is not None else out


def merge_batch_fn(target: str, keys: list[str], order_cols: list[str] | None = None, part: Column | None = None):
    """The ``foreachBatch`` function: merge one micro-batch into the table's next version."""
    part = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)) if part is None else part

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once for its partitions and once for the merge
        try:
            tables.merge_partitions(batch, target, keys, part, batch_id, order_cols=order_cols)
        finally:
            batch.unpersist()

    return merge


def ingest_stream(spark: SparkSession, source_dir: str, schema: StructType | str, target: str, keys: list[str],
                  checkpoint: str, *, order_cols: list[str] | None = None, fmt: str = "json",
                  max_files_per_trigger: int | None = None, part: Column | None = None) -> None:
    """I-08: process every landed file not seen before, merging each micro-batch into ``target``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    q = (stream.writeStream.foreachBatch(merge_batch_fn(target, keys, order_cols, part))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
