"""STR1: continuous ingest of landed sales files (the streaming form of the upload).

``readStream`` over a landing folder, every field as text -> per micro-batch: the
``sales_records`` projection; rows that type are written, all others go to quarantine
with the values they came with and a reason.  Nothing is imputed or replaced, and a row's
fate depends on that row alone, so the result is the same however files fall into
batches.  Each batch writes to its own ``batch_id=N`` folder with overwrite, so a batch
replayed after a failure (``foreachBatch`` is at-least-once) rewrites the same files
instead of duplicating them.  Counts per batch are written to ``metrics_dir/batch_id=N``.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesforge.functions.schema import UPLOAD_REQUIRED
from salesforge.operators.validate import require_columns
from salesforge.sources.readers import CORRUPT, csv_columns, text_schema
from salesforge.sources.sinks import accepted_records, rejected_records, tag_records


def landing_stream(spark: SparkSession, landing_dir: str, fmt: str = "json",
                   max_files_per_trigger: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """The landed text.  CSV columns are those of the header already in the folder (or
    ``columns``), and a file with another header fails its batch instead of being
    shifted; JSON fields are matched by name."""
    names = columns or (csv_columns(spark, landing_dir) if fmt == "csv" else UPLOAD_REQUIRED)
    require_columns(spark.createDataFrame([], text_schema(names)), UPLOAD_REQUIRED)
    r = spark.readStream.schema(text_schema(names)).format(fmt).option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        r = r.options(header=True, enforceSchema=False)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing_dir)


def process_batch(batch: DataFrame, batch_id: int, table_dir: str, quarantine_dir: str,
                  metrics_dir: str | None = None) -> None:
    """Type one micro-batch and write every output idempotently by batch id."""
    tagged = tag_records(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def write(df: DataFrame, where: str) -> None:
            df.write.mode("overwrite").parquet(os.path.join(where, f"batch_id={batch_id}"))
        if metrics_dir:
            write(tagged.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reason").isNotNull()).alias("rejected"),
                             F.count_if(F.col("typed.quantity").isNull()).alias("quantity_missing"),
                             F.count_if(F.col("typed.date").isNull()).alias("date_missing"),
                             F.count_if(F.col("typed.quantity") <= 0).alias("quantity_non_positive"))
                  .withColumn("batch_id", F.lit(batch_id).cast("bigint")), metrics_dir)
        write(rejected_records(tagged), quarantine_dir)
        write(accepted_records(tagged), table_dir)
    finally:
        tagged.unpersist()


def start_ingest(spark: SparkSession, landing_dir: str, table_dir: str, quarantine_dir: str,
                 checkpoint_location: str, fmt: str = "json", available_now: bool = True,
                 processing_time: str | None = None, max_files_per_trigger: int | None = None,
                 metrics_dir: str | None = None) -> StreamingQuery:
    """Start the ingest query; ``available_now`` drains what has landed and stops."""
    stream = landing_stream(spark, landing_dir, fmt, max_files_per_trigger)
    w = (stream.writeStream.option("checkpointLocation", checkpoint_location)
         .foreachBatch(lambda df, bid: process_batch(df, bid, table_dir, quarantine_dir, metrics_dir)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def batch_metrics(spark: SparkSession, metrics_dir: str) -> DataFrame:
    """Per-batch counts written by ``process_batch`` (one row per batch)."""
    return spark.read.parquet(metrics_dir).orderBy("batch_id")
